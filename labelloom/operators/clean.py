"""Cleaning and label encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from labelloom.functions.text import strip_unicode
from labelloom.plans.lookup import lookup_join

NULL_TEXT = "nan"


def drop_missing_label(df: DataFrame, label: str) -> DataFrame:
    """Rows that have a label."""
    return df.filter(F.col(label).isNotNull())


def missing_label_report(df: DataFrame, label: str) -> DataFrame:
    """One row: rows before, rows kept and rows removed by `drop_missing_label`."""
    kept = F.count(label)
    return df.agg(
        F.count("*").alias("n_rows"),
        kept.alias("n_kept"),
        (F.count("*") - kept).alias("n_removed"),
    )


def clean_text(
    df: DataFrame, text: str, into: str = "text_clean", null_text: str | None = NULL_TEXT
) -> DataFrame:
    """Strip Unicode whitespace; a null text becomes `null_text`, or stays null if that is None."""
    value = F.col(text).cast("string")
    if null_text is not None:
        value = F.coalesce(value, F.lit(null_text))
    return df.withColumn(into, strip_unicode(value))


def drop_empty_text(df: DataFrame, text: str = "text_clean") -> DataFrame:
    """Rows whose cleaned text is neither null nor empty."""
    return df.filter(F.length(text) > 0)


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels with dense codes from 0.

    The window runs over one row per class.
    """
    distinct = df.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct()
    code = F.row_number().over(Window.orderBy("label")) - 1
    return distinct.select("label", code.cast("int").alias("encoded_value"))


def label_encode(
    df: DataFrame, label: str, index: DataFrame | None = None, into: str = "label_encoded"
) -> DataFrame:
    """Attach the label code to every row whose label is in the index."""
    index = label_index(df, label) if index is None else index
    codes = index.select(F.col("label").alias(label), F.col("encoded_value").alias(into))
    columns = [*[c for c in df.columns if c != into], into]
    return lookup_join(df.drop(into), codes, label).select(*columns)


def label_decode(df: DataFrame, code: str, index: DataFrame, into: str = "label") -> DataFrame:
    """Attach the label of a code to every row."""
    names = index.select(F.col("encoded_value").alias(code), F.col("label").alias(into))
    columns = [*[c for c in df.columns if c != into], into]
    return lookup_join(df.drop(into), names, code).select(*columns)


def prepare(
    df: DataFrame,
    key: str,
    text: str,
    label: str,
    carry: Sequence[str] = (),
    null_text: str | None = NULL_TEXT,
) -> DataFrame:
    """Drop unlabelled rows, clean, drop empty texts, encode; the prepared projection."""
    clean = (
        df.select(key, text, *carry, label)
        .transform(drop_missing_label, label)
        .transform(clean_text, text, null_text=null_text)
        .transform(drop_empty_text)
    )
    return label_encode(clean, label).select(
        key, text, "text_clean", *carry, label, "label_encoded"
    )
