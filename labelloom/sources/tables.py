"""CSV and Parquet tables with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

RAW_SCHEMA = (
    "tweet_id long, created_at timestamp, tweet string, label_true string, "
    "month string, label_pred string"
)
PREPARED_SCHEMA = (
    "tweet_id long, tweet string, tweet_clean string, created_at timestamp, "
    "month string, label_true string, label_encoded int"
)
LABEL_MAPPING_SCHEMA = "label string, encoded_value int"

# Quotes are doubled and texts kept as they are, line breaks and outer blanks included.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def file_reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.options(**CSV_OPTIONS).option("multiLine", True).option("enforceSchema", False)


def header_names(spark: SparkSession, path: str, fields: Sequence[StructField]) -> list[str]:
    """The columns of the header, once it is sure that none of the fields is missing."""
    names = file_reader(spark).csv(path).columns
    missing = [f.name for f in fields if f.name not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}: {names}")
    return names


def text_fields(names: Sequence[str], malformed: str | None) -> tuple[StructType, str]:
    """All columns as text, with one for the raw row where malformed rows are wanted; its name."""
    raw = "__raw"
    columns = [*names, raw] if malformed is not None else names
    return StructType([StructField(name, StringType()) for name in columns]), raw


def typed(
    rows: DataFrame, fields: Sequence[StructField], names: Sequence[str], malformed: str | None, raw: str,
    more: Sequence[Column] = (),
) -> DataFrame:
    """Texts as values of the declared types; `malformed` gets the raw row of those that are not."""
    if malformed is None:
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields], *more)
    values = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields}
    wrong = reduce(
        lambda a, b: a | b,
        [F.col(f"`{name}`").isNotNull() & value.isNull() for name, value in values.items()],
    )
    record = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))
    return rows.select(
        *[value.alias(name) for name, value in values.items()],
        F.coalesce(raw, F.when(wrong, record)).alias(malformed),
        *more,
    )


def csv_scan(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    split: str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Read a header CSV with declared column types, as a named split if a name is given.

    Columns are found by their header name, in any order; others are left out, and a
    missing one is an error, as is a file whose header differs from the first one's. A
    row with too few or too many fields, or with a value that is not of its column's type,
    ends the read, unless `malformed` names a column: it then holds the raw row, null for a good one.

    Quoted line breaks keep a file from being split: `ranges.csv_scan_ranges` reads large
    files in many tasks.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    names = header_names(spark, path, fields)
    texts, raw = text_fields(names, malformed)
    reader = file_reader(spark).schema(texts)
    if malformed is None:
        rows = reader.option("mode", "FAILFAST").csv(path)
    else:
        rows = reader.option("columnNameOfCorruptRecord", raw).csv(path)
    table = typed(rows, fields, names, malformed, raw)
    return table if split is None else table.withColumn("split", F.lit(split))


def csv_sink(df: DataFrame, path: str) -> None:
    """Write a header CSV without an index, replacing what is there."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def splits_sink(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """Write one folder per split."""
    options = CSV_OPTIONS if fmt == "csv" else {}
    df.write.mode("overwrite").partitionBy(split).format(fmt).options(**options).save(path)
