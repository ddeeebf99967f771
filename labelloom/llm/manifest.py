"""A Merkle manifest of a dataset: a tree of digests per source, and a tree over the sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.llm.common import stored, table
from labelloom.llm.registry import query
from labelloom.plans.lookup import lookup_join
from labelloom.plans.ranking import number_rows

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: each value as `-` if null, else its UTF-8 byte count, `:`, itself."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        known = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(known, F.lit("-"))

    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def bucket(width: int) -> Column:
    """Which interval of `width` ranks a node lies in; nodes never straddle two."""
    return F.floor(F.col("lo") / F.lit(width)).cast("long").alias("bucket")


# A node that covers all leaves of its tree is the tree's root; there is one.
IS_ROOT, IS_INNER = "hi - lo + 1 = size", "hi - lo + 1 < size"


def inner_levels(leaves: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The inner nodes of all trees, one stored frame per level, the lowest first.

    A node is `tree, size, lo, hi, digest`: it covers the leaf ranks lo to hi of its tree of
    `size` leaves; a leaf covers its own rank. A run of at most `fanout` nodes lies in one
    bucket of the level above, so no group is larger, however many leaves a tree has. The
    nodes of these frames also hold their `kids` (lo, hi, digest), in order.
    """
    tallest = leaves.agg(F.max("size")).first()[0] or 0
    levels, width = [], 1
    while width < tallest:
        width *= fanout
        below = levels[-1] if levels else leaves
        runs = below.filter(IS_INNER).groupBy("tree", "size", bucket(width))
        kids = runs.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        nodes = kids.select(
            "tree",
            "size",
            F.element_at("kids", 1)["lo"].alias("lo"),
            F.element_at("kids", -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.col("kids")["digest"], ""), 256).alias("digest"),
            "kids",
        )
        levels.append(stored(nodes, f"{name}-level"))
    return levels


def siblings(kids: str, lo: str, hi: str) -> Column:
    """The interval of the parent without the node's own: the kids before it and after it."""

    def digests(outside) -> Column:
        return F.array_join(F.transform(F.filter(kids, outside), lambda k: k["digest"]), "")

    return F.struct(
        digests(lambda k: k["hi"] < F.col(lo)).alias("before"),
        digests(lambda k: k["lo"] > F.col(hi)).alias("after"),
    )


NO_PATH = "CAST(array() AS array<struct<before:string,after:string>>)"


def with_paths(
    leaves: DataFrame, levels: list[DataFrame], fanout: int, above: DataFrame | None = None
) -> DataFrame:
    """The leaves with `path`, the siblings before and after on each level up, and `top`, their tree's root.

    Paths come down from the roots, a level at a time. The join is a containment join within
    buckets: a node's interval lies in that of the one parent of its tree in its bucket of the
    parent's width, and a parent has at most `fanout` nodes there, so no key is hot. `above` holds
    the path and root over each tree, by `tree`: where it is given, paths go on to that `root`.
    """

    def started(nodes: DataFrame) -> DataFrame:
        roots = nodes.filter(IS_ROOT).withColumn("top", F.col("digest"))
        if above is None:
            return roots.withColumns({"path": F.expr(NO_PATH), "root": F.col("digest")})
        return roots.join(above.select("tree", "path", "root"), "tree")  # a row per tree on both sides

    def inherited(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
        up = parents.select(
            "tree", bucket(width), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"),
            F.col("kids").alias("siblings"), F.col("path").alias("up_path"), "top", "root",
        )
        inside = (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
        found = nodes.filter(IS_INNER).withColumn("bucket", bucket(width)).join(up, ["tree", "bucket"])
        own = F.array(siblings("siblings", "lo", "hi"))
        path = F.concat(own, F.col("up_path"))
        return found.filter(inside).select(*nodes.columns, path.alias("path"), "top", "root")

    parents = None
    for height in range(len(levels), -1, -1):
        nodes = levels[height - 1] if height else leaves
        reached = started(nodes).select(*nodes.columns, "path", "top", "root")
        if parents is not None:
            reached = reached.unionByName(inherited(nodes, parents, fanout ** (height + 1)))
        parents = reached
    return parents


def folded(path: Column, digest: Column) -> Column:
    """The root that a leaf digest leads to, hashed upward along its path."""
    return F.aggregate(
        path, digest, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256)
    )


def proof_digest(path: Column) -> Column:
    """One digest of all siblings on the path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """The trees over a dataset, in stored frames.

    `leaves` is a row per row of the dataset: `tree, size, lo, hi, digest`, its key and what was
    carried; `levels` are the inner nodes of the sources' trees, `sources` the
    leaves of the tree over them, `upper` that tree's inner nodes.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    upper: list[DataFrame]
    fanout: int

    def nodes(self) -> DataFrame:
        """All nodes with their labels: `tree, level, lo, hi, digest`; `tree` is null in the tree over the sources."""
        columns = ("lo", "hi", "digest")
        own = [
            nodes.select("tree", F.lit(level).alias("level"), *columns)
            for level, nodes in enumerate([self.leaves, *self.levels])
        ]
        over = [
            nodes.select(F.lit(None).cast("string").alias("tree"), F.lit(level).alias("level"), *columns)
            for level, nodes in enumerate([self.sources.drop("tree"), *self.upper])
        ]
        return reduce(DataFrame.unionByName, own + over)

    def proofs(self) -> DataFrame:
        """The leaves with their `path` to the `root` of the whole, and their source's root as `top`."""
        over = with_paths(self.sources, self.upper, self.fanout)
        above = over.select(F.col("name").alias("tree"), "path", "root")
        return with_paths(self.leaves, self.levels, self.fanout, above)


def build_manifest(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    fields: Sequence[str] = FIELDS,
    carry: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> Manifest:
    """Digests of all rows and of runs of `fanout` of them, per source and over the sources.

    The leaves of a source ascend by key, null first; rows of one key by digest, so repeated
    rows are leaves of their own and their order does not matter. Sources ascend bytewise,
    null first. A source with one row has no inner node: its root is the leaf. Nodes are
    labelled with the interval of leaf ranks that they cover. The ranks come from range
    partitions, so a source may hold most rows. An empty table has no nodes. `carry` names
    expressions on `docs` that stay beside the leaves; other columns are ignored.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    kept = [value.alias(name) for name, value in (carry or {}).items()]
    # Digests first: the range cut samples its input, which should not hash the texts twice.
    digests = stored(
        docs.select(
            tree.alias("tree"), F.col(key).alias("key"),
            leaf_digest(*[F.col(f) for f in fields]).alias("digest"), *kept,
        ),
        "leaf-digests",
    )
    ranked = number_rows(digests, ["tree", "key", "digest"], "at")
    spans = ranked.groupBy("tree").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    rank = F.col("at") - F.col("first")
    leaves = lookup_join(ranked, spans, "tree").withColumns({"lo": rank, "hi": rank}).drop("at", "first")
    levels = inner_levels(leaves, fanout, "source")
    roots = [nodes.filter(IS_ROOT).select("tree", "digest") for nodes in (leaves, *levels)]
    named = number_rows(
        reduce(DataFrame.unionByName, roots).withColumnRenamed("tree", "name"), "name", "at"
    )
    total = named.agg(F.count("*")).scalar()
    sources = named.select(
        F.lit("").alias("tree"), "name", "digest", total.alias("size"),
        (F.col("at") - 1).alias("lo"), (F.col("at") - 1).alias("hi"),
    )
    return Manifest(leaves, levels, sources, inner_levels(sources, fanout, "upper"), fanout)


def tampered(text: Column) -> Column:
    """The text with A-Z in lower case: the change that the query tries to pass off."""
    return F.translate(text, UPPER, LOWER)


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _row(text: str) -> str:
    columns = [text if f == "text" else f for f in FIELDS]
    return "sha256(" + " || ".join(_field(c) for c in columns) + ")"


# Bit by bit: a byte is mixed in, then shifted out over eight steps (marked -1).
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384)
                      ELSE crc // 2 END))"""


def _levels(name: str, leaves: str) -> str:
    return f"""{name}(tree, level, pos, digest) AS (
  SELECT tree, 0, pos, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name})
  WHERE n > 1 GROUP BY tree, level, pos // 16
), {name}_top AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS digest FROM {name} GROUP BY tree)"""


def _siblings(name: str, leaves: str, phase: int) -> str:
    return f"""SELECT l.id, {phase} AS phase, n.level, n.pos, n.digest
  FROM {leaves} l JOIN {name}_top t ON t.tree = l.tree JOIN {name} n ON n.tree = l.tree
   AND n.level < t.height AND n.pos // 16 = l.pos // (16 ** (n.level + 1))::BIGINT
   AND n.pos <> l.pos // (16 ** n.level)::BIGINT"""


def _fold(name: str, nodes: str, start: str) -> str:
    return f"""{name}(id, tree, level, pos, digest) AS (
  SELECT id, tree, 0, pos, start FROM {start}
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.pos // 16,
         sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.digest ELSE n.digest END, '' ORDER BY n.pos))
  FROM {name} f JOIN {nodes}_top t ON t.tree = f.tree JOIN {nodes} n
    ON n.tree = f.tree AND n.level = f.level AND n.pos // 16 = f.pos // 16
  WHERE f.level < t.height GROUP BY f.id, f.tree, f.level, f.pos // 16
)"""


SQL = f"""WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_row("text")} AS digest,
         CASE WHEN {_CRC32} % 5 = 0
              THEN {_row(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_row("text")} END AS start
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, digest) AS id,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos
  FROM hashed
), {_levels("nodes", "leaves")}, sources AS (
  SELECT tree AS name, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes_top
), {_levels("upper", "sources")}, placed AS (
  SELECT l.id, l.start, s.tree, s.pos FROM leaves l JOIN sources s ON s.name = l.tree
), path AS (
  {_siblings("nodes", "leaves", 0)}
  UNION ALL
  {_siblings("upper", "placed", 1)}
), proofs AS (
  SELECT id, string_agg(digest, '' ORDER BY phase, level, pos) AS proof FROM path GROUP BY id
), {_fold("inner_fold", "nodes", "leaves")}, inner_root AS (
  SELECT f.id, arg_max(digest, level) AS start FROM inner_fold f GROUP BY f.id
), again AS (
  SELECT p.id, p.tree, p.pos, r.start FROM placed p JOIN inner_root r ON r.id = p.id
), {_fold("outer_fold", "upper", "again")}, outer_root AS (
  SELECT id, arg_max(digest, level) AS digest FROM outer_fold GROUP BY id
)
SELECT l.doc_id, l.digest AS leaf, t.digest AS subroot, u.digest AS root,
       sha256(coalesce(p.proof, '')) AS proof_sha256, o.digest AS folded_root,
       o.digest = u.digest AS verified
FROM leaves l JOIN nodes_top t ON t.tree = l.tree CROSS JOIN upper_top u
JOIN outer_root o ON o.id = l.id LEFT JOIN proofs p ON p.id = l.id"""


@query(SQL)
def op12_interval_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and the root that its leaf, at times tampered with, folds to."""
    docs = table(spark, sf_dir, "documents")
    changed = leaf_digest(*[tampered(F.col(f)) if f == "text" else F.col(f) for f in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    proofs = build_manifest(docs, carry={"changed": F.when(hit, changed)}).proofs()
    root = folded(F.col("path"), F.coalesce("changed", "digest"))
    return proofs.select(
        F.col("key").alias("doc_id"),
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
