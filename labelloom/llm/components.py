"""Connected components of large graphs, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from labelloom.llm.common import stored

ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """`node, component` for every node of `edges (a, b)`; the component is its smallest node.

    Each round ties every node to the smallest neighbour it knows, first upwards (large
    star), then among the smaller ones (small star), until all edges point at their smallest node; the
    number of rounds grows with the logarithm of a component's size. Minima are combined before the
    shuffle; only the joins back meet a large star in one key, and adaptive execution splits those.
    Each round is written to the shared folder.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = stored(edges, "edges")
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        # A node's smaller neighbours, and the node itself, go to the smallest of them.
        small = large.join(floor, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(floor.select("a", F.col("m").alias("b"))).distinct()
        after = stored(small, "edges")
        settled = after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty()
        centred = after.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
        edges = after
        if settled and centred:
            break
    else:
        raise RuntimeError("components did not settle")
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
