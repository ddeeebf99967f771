"""Class weights and resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from labelloom.operators.profile import label_counts, ratio
from labelloom.plans.lookup import literal_table, lookup_join, settle
from labelloom.plans.ranking import mark_first

# Copies of one row written by one task; rows with more are spread over several tasks.
COPIES_PER_TASK = 10_000


def class_weights(df: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    """Inverse-frequency weight rows / (classes * rows of the class) for each listed label.

    A listed label without rows gets 1.0.
    """
    counts = label_counts(df.filter(F.col(label).isNotNull()), label)
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("k"))).scalar()
    weights = (
        counts.filter(F.col("label").isin(*labels))
        .withColumn("__t", totals)
        .select(
            "label", ratio(F.col("__t.rows"), F.col("__t.k") * F.col("n")).alias("__weight")
        )
    )
    listed = literal_table(df.sparkSession, [(name,) for name in labels], "label string")
    return listed.join(weights, "label", "left").select(
        "label", F.coalesce("__weight", F.lit(1.0)).alias("weight")
    )


def weighted_rows(
    df: DataFrame, label: str, weights: DataFrame, into: str = "weight"
) -> DataFrame:
    """Attach the weight of its class to every row; 1.0 for a label without one."""
    by_label = weights.select(F.col("label").alias(label), F.col("weight").alias("__weight"))
    joined = lookup_join(df, by_label, label, "left")
    return joined.select(*df.columns, F.coalesce("__weight", F.lit(1.0)).alias(into))


def undersample(df: DataFrame, key: str, label: str, seed: int | str = 42) -> DataFrame:
    """Cut every class to the size of the smallest, keeping its first rows in hash order."""

    def smallest(sizes: DataFrame) -> DataFrame:
        return sizes.withColumn("quota", sizes.agg(F.min("n")).scalar())

    marked = mark_first(
        df.filter(F.col(label).isNotNull()),
        smallest,
        key=key,
        group=label,
        seed=seed,
        into="__in",
    )
    return marked.filter("__in").drop("__in")


def oversample(
    df: DataFrame, key: str, label: str, seed: int | str = 42, into: str = "copy_no"
) -> DataFrame:
    """Repeat rows until every class has as many as the largest.

    Each row occurs floor(max / n) times, the first max % n rows of the class in hash
    order once more. `into` numbers the copies from 1.
    """
    labelled = df.filter(F.col(label).isNotNull())
    counts = settle(label_counts(labelled, label))
    largest = counts.agg(F.max("n")).scalar()
    plan = counts.select(
        F.col("label").alias(label),
        F.floor(largest / F.col("n")).cast("long").alias("__copies"),
    )

    def remainder(sizes: DataFrame) -> DataFrame:
        return sizes.withColumn("quota", sizes.agg(F.max("n")).scalar() % F.col("n"))

    marked = mark_first(labelled, remainder, key=key, group=label, seed=seed, into="__more")
    counted = lookup_join(marked, plan, label).withColumn(
        "__copies", F.col("__copies") + F.col("__more").cast("long")
    )
    # Numbers 1..copies in blocks, so that one row of a tiny class is not copied by one task.
    # Only the rows of such classes move.
    blocks = counted.withColumn("__block", F.lit(0).cast("long"))
    most = plan.agg(F.max("__copies")).first()[0]
    if most is not None and most >= COPIES_PER_TASK:
        last_block = F.floor((F.col("__copies") - 1) / COPIES_PER_TASK)
        many = counted.filter(F.col("__copies") > COPIES_PER_TASK).withColumn(
            "__block", F.explode(F.sequence(F.lit(0).cast("long"), last_block))
        )
        few = blocks.filter(F.col("__copies") <= COPIES_PER_TASK)
        blocks = few.unionByName(many.repartition(key, "__block"))
    first = F.col("__block") * COPIES_PER_TASK + 1
    last = F.least(first + (COPIES_PER_TASK - 1), F.col("__copies"))
    return blocks.select(*df.columns, F.explode(F.sequence(first, last)).alias(into))
