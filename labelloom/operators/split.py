"""Exact, seeded, partition-independent splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from labelloom.functions.order import seeded_hash
from labelloom.operators.profile import ratio
from labelloom.plans.lookup import first_rows
from labelloom.plans.ranking import mark_first, number_rows

# Up to this many rows a sample is a top-n; larger ones never pass through one task.
TOP_N_LIMIT = 1_000


def split_quotas(sizes: DataFrame, group: str, test_size: float, rounding: str = "remainder") -> DataFrame:
    """Test rows per class for class sizes `(group, n)`.

    `remainder`: the test set has exactly ceil(test_size * rows) rows; what the
    rounded-down class quotas leave over goes to the largest remainders, ties to the
    smaller label. `floor`: every class quota is rounded down.
    """
    if rounding not in ("remainder", "floor"):
        raise ValueError("rounding is 'remainder' or 'floor'")
    total = sizes.agg(F.sum("n")).scalar()
    if rounding == "floor":
        return sizes.withColumn("quota", F.floor(F.col("n") * F.lit(test_size)).cast("long"))
    wide = "decimal(19,0)"
    n_test = F.ceil(F.col("__total") * F.lit(test_size)).cast("long")
    # Exact integers: 38 digits hold the product of any two row counts.
    share = (
        sizes.withColumn("__total", total)
        .withColumn("__test", n_test)
        .withColumn("__product", F.col("n").cast(wide) * F.col("__test").cast(wide))
        .withColumn("__left", F.col("__product") % F.col("__total").cast(wide))
        .withColumn(
            "__base",
            ((F.col("__product") - F.col("__left")) / F.col("__total").cast(wide)).cast("long"),
        )
    )
    # One row per class from here on.
    by_remainder = Window.orderBy(F.desc("__left"), group)
    spare = F.col("__test") - F.sum("__base").over(Window.partitionBy())
    extra = F.when(F.row_number().over(by_remainder) <= spare, 1).otherwise(0)
    return share.withColumn("quota", F.col("__base") + extra).select(group, "n", "quota")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = 0.2,
    seed: int | str = 42,
    rounding: str = "remainder",
    into: str = "split",
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Attach `train` or `test`, keeping the class shares. Rows without a label are left out."""
    flagged = mark_first(
        df.filter(F.col(label).isNotNull()),
        lambda sizes: split_quotas(sizes, label, test_size, rounding),
        key=key,
        group=label,
        seed=seed,
        into="__held_out",
    )
    side = F.when(F.col("__held_out"), names[1]).otherwise(names[0])
    return flagged.withColumn(into, side).drop("__held_out")


def nested_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = 0.2,
    eval_size: float = 0.125,
    seed: int | str = 42,
    into: str = "split",
) -> DataFrame:
    """Hold out the test rows, then the eval rows from what is left: train, eval, test."""
    outer = stratified_split(df, key, label, test_size, seed, into=into)
    rest = F.when(F.col(into) == "train", F.col(label))
    inner = mark_first(
        outer.withColumn("__label", rest),
        lambda sizes: split_quotas(
            sizes.filter(F.col("__label").isNotNull()), "__label", eval_size
        ),
        key=key,
        group="__label",
        seed=f"{seed}:eval",
        into="__eval",
    )
    side = F.when(F.col("__eval"), "eval").otherwise(F.col(into))
    return inner.withColumn(into, side).drop("__eval", "__label")


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and % per split."""
    counts = df.groupBy(split).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", ratio(F.col("n"), total) * 100)


def split_distribution(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows and % per label within each split."""
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(split))
    return counts.withColumn("pct", ratio(F.col("n"), whole) * 100).filter(
        F.col(label).isNotNull()
    )


def split_comparison(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per label in the whole table, in train and in test, 0 where there are none."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(
            F.count("*").alias("original"),
            F.count_if(F.col(split) == "train").alias("train"),
            F.count_if(F.col(split) == "test").alias("test"),
        )
    )


def stratification_check(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Share of each label in the whole table, in train and in test, and the last two's distance."""
    counts = split_comparison(df, label, split)
    sums = counts.agg(
        F.struct(*[F.sum(c).alias(c) for c in ("original", "train", "test")])
    ).scalar()
    shares = counts.withColumn("__sums", sums).select(
        label,
        *[
            ratio(F.col(c), F.col("__sums").getField(c)).alias(f"{c}_ratio")
            for c in ("original", "train", "test")
        ],
    )
    return shares.withColumn("difference", F.abs(F.col("train_ratio") - F.col("test_ratio")))


def sample_n(df: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer), without replacement."""
    if n <= TOP_N_LIMIT:
        return first_rows(df, key, n, seeded_hash(key, seed))
    quota = lambda sizes: sizes.withColumn("quota", F.least("n", F.lit(n).cast("long")))
    marked = mark_first(
        df.withColumn("__all", F.lit(0)), quota, key=key, group="__all", seed=seed, into="__in"
    )
    return marked.filter("__in").drop("__in", "__all")


def head_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows in key order."""
    return first_rows(df, key, n)


def head_in_order(df: DataFrame, position: str, n: int) -> DataFrame:
    """First n rows by `position`, such as that of a file's rows; every task keeps n rows at most."""
    return df.orderBy(position).limit(n)


def batch_ids(
    df: DataFrame, key: str | Sequence[str], size: int = 16, into: str = "batch_id"
) -> DataFrame:
    """Cut the table, in key order, into batches of `size` rows; the last one may be shorter.

    The key is one or more columns of any orderable type.
    """
    numbered = number_rows(df, key, "__row")
    batch = F.floor((F.col("__row") - 1) / size).cast("long")
    return numbered.withColumn(into, batch).drop("__row")
