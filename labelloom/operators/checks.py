"""Checks on tables, as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from labelloom.operators.profile import null_counts
from labelloom.plans.lookup import union_all


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required column: whether it exists, and on how many rows it is missing.

    A column that does not exist is missing on every row.
    """
    present = [c for c in required if c in df.columns]
    absent = [F.lit(None).alias(c) for c in required if c not in df.columns]
    return null_counts(df.select(*present, *absent), list(required)).select(
        "column", F.col("column").isin(*present).alias("present"), "missing", "pct"
    )


def run_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One `(check, passed)` row per named aggregate condition, from one pass over the table."""
    results = df.agg(*[F.coalesce(c, F.lit(False)).alias(name) for name, c in checks.items()])
    entries = [
        F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("passed")) for name in checks
    ]
    return results.select(F.inline(F.array(*entries)))


def check_summary(results: Sequence[DataFrame]) -> DataFrame:
    """All check rows, and the tally `passed/total` on each."""
    rows = union_all(list(results))
    tally = rows.agg(
        F.concat_ws(
            "/", F.count_if(F.col("passed")).cast("string"), F.count("*").cast("string")
        )
    ).scalar()
    return rows.withColumn("tally", tally)
