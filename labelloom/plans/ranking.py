"""Exact ranks without ever sorting one class, or the table, in a single task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from labelloom.functions.order import seeded_hash
from labelloom.plans.lookup import lookup_join, pin_small, settle
from labelloom.plans.scratch import written

HASH_DIGITS = 3
PREFIXES = 65_536  # counts per group and prefix that are kept from the one pass over the rows
SORTED_ROWS = 1_000_000  # of one group that may meet in one sort
PLACE_BITS = 33  # of monotonically_increasing_id: the place within a task


def mark_first(
    df: DataFrame,
    quotas: Callable[[DataFrame], DataFrame],
    *,
    key: str,
    group: str,
    seed: int | str,
    into: str,
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Flag, per group, the first `quota` rows in seeded hash order.

    `quotas` maps the group sizes `(group, n)` to `(group, quota)`. The rows are
    counted per group and hash prefix; the prefix that holds the last wanted row
    follows from a running sum over those counts, and only the rows under that one
    prefix are sorted: 1 in 16**digits of the group, and where that is more than SORTED_ROWS, the
    prefix grows until it is not. What comes back to the rows
    is one cut-off value per group, so flagging them needs no shuffle.
    """
    slim = df.select(group, key, seeded_hash(key, seed).alias("__hash"))

    def counted(digits: int) -> tuple[DataFrame, DataFrame]:
        rows = slim.withColumn("__prefix", F.substring("__hash", 1, digits))
        counts = rows.groupBy(group, "__prefix").agg(F.count("*").alias("__n"))
        return rows, pin_small(counts, PREFIXES) or counts

    # The counts of one pass serve for sizes and edges; they also tell how large a sort would be.
    prefixed, per_prefix = counted(digits)
    largest = per_prefix.agg(F.max("__n")).first()[0] or 0
    if largest > SORTED_ROWS:
        prefixed, per_prefix = counted(digits + math.ceil(math.log(largest / SORTED_ROWS, 16)))
    slim = prefixed
    sizes = per_prefix.groupBy(group).agg(F.sum("__n").alias("n"))

    running = (
        Window.partitionBy(group)
        .orderBy("__prefix")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edges = (
        per_prefix.withColumn("__upto", F.sum("__n").over(running))
        .join(quotas(sizes).select(group, "quota"), group)
        .withColumn("__rest", F.col("quota") - F.col("__upto") + F.col("__n"))
        .filter((F.col("__rest") > 0) & (F.col("__rest") <= F.col("__n")))
        .select(group, F.col("__prefix").alias("__edge"), "__rest")
    )
    in_edge = Window.partitionBy(group).orderBy("__hash", key)
    cuts = (
        lookup_join(slim, edges, group)
        .filter(F.col("__prefix") == F.col("__edge"))
        .withColumn("__rank", F.row_number().over(in_edge))
        .filter(F.col("__rank") == F.col("__rest"))
        .select(group, F.struct("__hash", key).alias("__cut"))
    )
    place = F.struct(seeded_hash(key, seed).alias("__hash"), F.col(key))
    chosen = F.coalesce(place <= F.col("__cut"), F.lit(False))
    columns = [c for c in df.columns if c != into]
    return lookup_join(df, cuts, group, "left").select(*columns, chosen.alias(into))


def number_rows(df: DataFrame, key: str | Sequence[str], into: str = "row_no") -> DataFrame:
    """Attach 1, 2, 3, ... in the order of a unique key of one or more orderable columns.

    Spark cuts the table into key ranges, one per shuffle partition, and sorts each in its own
    task; a row's place is its place in that task plus the sizes of the ranges before it. The
    sorted rows are written once, since a range's bounds are sampled anew each time it is
    computed: sizes and places must come from the same cut. Nulls come first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # This id holds the task's number above the row's place in the task.
    placed = written(ranged.withColumn("__at", F.monotonically_increasing_id()), "row-places")
    placed = placed.withColumn("__part", F.shiftright("__at", PLACE_BITS))
    # One row per range: the window over them is bounded by the setting, not by the data.
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = settle(
        sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__shift"))
    )
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        lookup_join(placed, shifts, "__part")
        .withColumn(into, F.col("__shift") + place + 1)
        .drop("__part", "__shift", "__at")
    )
