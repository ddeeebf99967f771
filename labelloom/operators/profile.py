"""Shape, missing values, class balance and imbalance of a labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labelloom.functions.choose import choose
from labelloom.functions.text import preview
from labelloom.plans.lookup import fetch_by_key

# Thresholds and their wording. The first rule that holds wins.
SHARE_LIMIT = 0.1
RATIO_LEVELS = ((2.0, "significant"), (1.5, "moderate"))
SEVERITY_LEVELS = (
    (3.0, "SEVERE", "Strongly consider resampling techniques"),
    (2.0, "MODERATE", "Consider resampling or class weights"),
    (1.5, "MILD", "Monitor performance, consider class weights"),
)
SEVERITY_ELSE = ("MINIMAL", "Dataset is reasonably balanced")
LOW_REPRESENTATION = 0.5
HIGH_REPRESENTATION = 0.8


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where the whole is zero."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns, and the column names in order."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column its null count and share in %, from one pass over the table."""
    counts = df.agg(
        F.count("*").alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("missing"))
        for i, c in enumerate(columns)
    ]
    return counts.select("__rows", F.inline(F.array(*entries))).select(
        "column", "missing", (ratio(F.col("missing"), F.col("__rows")) * 100).alias("pct")
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and share of the columns that hold nulls."""
    return null_counts(df, df.columns).filter(F.col("missing") > 0)


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label, the null label included."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and % per label, most frequent first; rows without a label stay in the denominator."""
    counts = label_counts(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.filter(F.col("label").isNotNull())
        .select("label", "n", (ratio(F.col("n"), total) * 100).alias("pct"))
        .orderBy(F.desc("n"), "label")
    )


def class_count(df: DataFrame, label: str) -> DataFrame:
    """Number of classes with and without the null label counted as one."""
    named = F.count_if(F.col("label").isNotNull())
    return label_counts(df, label).agg(
        F.count("*").alias("n_classes_with_null"), named.alias("n_classes")
    )


def class_example(df: DataFrame, key: str, text: str, label: str, width: int = 100) -> DataFrame:
    """The first text of each label, in order of first appearance by key.

    The first key per label is a plain hash aggregate; only then are the texts read,
    so no text is ever sorted or shuffled.
    """
    first = (
        df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.min(key).alias(key)).select(key)
    )
    return (
        fetch_by_key(df.select(key, label, text), first, key)
        .select(
            F.upper(label).alias("label"),
            F.col(key).alias("first_key"),
            preview(F.col(text), width).alias("example"),
        )
        .orderBy("first_key")
    )


def class_example_in_order(
    df: DataFrame, position: str, key: str, text: str, label: str, width: int = 100
) -> DataFrame:
    """The first text of each label by `position`, in order of first appearance.

    With the position of a file's rows this is table order, whatever the keys are. Only
    previews are compared, one per label and task.
    """
    first = F.min_by(F.struct(F.col(key).alias("key"), preview(F.col(text), width).alias("shown")), position)
    found = (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(first.alias("first"), F.min(position).alias("at"))
    )
    return found.orderBy("at").select(
        F.upper(label).alias("label"),
        F.col("first.key").alias("first_key"),
        F.col("first.shown").alias("example"),
    )


def class_share_flag(df: DataFrame, label: str, limit: float = SHARE_LIMIT) -> DataFrame:
    """Class shares with under- and over-representation flags (strict comparisons)."""
    flag = (
        F.when(F.col("pct") < limit * 100, "underrepresented")
        .when(F.col("pct") > (1 - limit) * 100, "overrepresented")
        .otherwise("balanced")
    )
    return class_distribution(df, label).withColumn("flag", flag)


def _extremes(df: DataFrame, label: str) -> DataFrame:
    """One row over the class counts: totals, extremes and the classes that hold them."""
    counts = label_counts(df, label)
    total = counts.agg(F.sum("n")).scalar()
    share = ratio(F.col("n"), total)
    named = counts.filter(F.col("label").isNotNull()).select("label", "n", (share * share).alias("sq"))
    return named.agg(
        F.max("n").alias("max_count"),
        F.min("n").alias("min_count"),
        F.min(F.struct((-F.col("n")).alias("n"), "label")).getField("label").alias("most_frequent"),
        F.max(F.struct((-F.col("n")).alias("n"), "label")).getField("label").alias("least_frequent"),
        (1 - F.sum("sq")).alias("gini"),
    ).withColumn("ratio", ratio(F.col("max_count"), F.col("min_count")))


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """Largest over smallest class and its level."""
    level = choose([(F.col("ratio") > limit, name) for limit, name in RATIO_LEVELS], "balanced")
    return _extremes(df, label).select("ratio", level.alias("level"))


def imbalance_metrics(df: DataFrame, label: str) -> DataFrame:
    """Ratio, Gini impurity over all rows, extreme classes and their distance."""
    return _extremes(df, label).select(
        "ratio",
        "gini",
        "most_frequent",
        "max_count",
        "least_frequent",
        "min_count",
        (F.col("max_count") - F.col("min_count")).alias("difference"),
    )


def severity(ratio_column: Column) -> tuple[Column, Column]:
    """Severity name and advice for an imbalance ratio."""
    name = choose([(ratio_column > x, level) for x, level, _ in SEVERITY_LEVELS], SEVERITY_ELSE[0])
    advice = choose([(ratio_column > x, text) for x, _, text in SEVERITY_LEVELS], SEVERITY_ELSE[1])
    return name, advice


def imbalance_severity(df: DataFrame, label: str) -> DataFrame:
    """Ratio with its severity and advice."""
    name, advice = severity(F.col("ratio"))
    return _extremes(df, label).select(
        "ratio", name.alias("severity"), advice.alias("recommendation")
    )


def class_representation(df: DataFrame, label: str) -> DataFrame:
    """Each class against the largest one."""
    counts = class_distribution(df, label)
    largest = counts.agg(F.max("n")).scalar()
    status = (
        F.when(F.col("ratio_to_max") < LOW_REPRESENTATION, "UNDERREPRESENTED")
        .when(F.col("ratio_to_max") > HIGH_REPRESENTATION, "WELL REPRESENTED")
        .otherwise("MODERATELY REPRESENTED")
    )
    return counts.withColumn("ratio_to_max", ratio(F.col("n"), largest)).select(
        "label", "n", "pct", "ratio_to_max", F.log10("n").alias("log10_n"), status.alias("status")
    )


def dataset_summary(df: DataFrame, split: str = "split") -> DataFrame:
    """Long table of total, train and test size and the train/test ratio."""
    sizes = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(split) == "train").alias("train"),
        F.count_if(F.col(split) == "test").alias("test"),
    )
    rows = [
        ("Total Samples", F.col("total").cast("double")),
        ("Training Samples", F.col("train").cast("double")),
        ("Testing Samples", F.col("test").cast("double")),
        ("Train/Test Ratio", ratio(F.col("train"), F.col("test"))),
    ]
    entries = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in rows]
    return sizes.select(F.inline(F.array(*entries)))
