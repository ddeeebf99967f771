"""What the operators share: tables, words, and results written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.plans.scratch import scratch_path

# Fixed value: what separates words, in every operator that counts words.
SPACE = r"[\x20\x09-\x0D]+"

ROW_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back.

    This cuts the lineage at a place all executors can reach: what is lost with an
    executor later is read again, not computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # Small row groups: a task that also feeds Python has little room for buffers.
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no more rows than this reach Python at once, in this session.

    Documents are large; Spark's default of 10,000 rows would be some hundred MB a batch.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def shuffle_parts(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def whole(text: str | Column) -> Column:
    """The text, with null as the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("string"), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to at most `rows` rows each, so that one step stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
