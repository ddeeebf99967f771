"""Arriving CSV files as streams: every file is read, worked on and appended exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from labelloom.functions.labels import label_lenient
from labelloom.operators.clean import NULL_TEXT, clean_text, drop_empty_text, drop_missing_label
from labelloom.operators.labelling import Model, append_predictions
from labelloom.plans.lookup import pin_small
from labelloom.sources.tables import CSV_OPTIONS


def arriving(spark: SparkSession, source: str, schema: str | StructType) -> DataFrame:
    """The rows of arriving files; another header than the schema's, or a malformed row, ends the run."""
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("multiLine", True)
    return reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(source)


def transform_arrivals(
    spark: SparkSession,
    source: str,
    schema: str | StructType,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start a run over the files that arrived since the last one; it ends when they are done.

    `transform` is any row-wise operator, such as prompts, label rules or a labeller: it keeps no state
    between rows, so the stream is map-only and gives the rows of the batch operator.
    """
    return (
        transform(arriving(spark, source, schema))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def label_arrivals(
    spark: SparkSession,
    source: str,
    schema: str | StructType,
    load_model: Callable[[], Model],
    text: str,
    target: str,
    checkpoint: str,
    normalise: Callable[[Column], Column] = label_lenient,
) -> StreamingQuery:
    """`append_predictions` over arriving files."""
    labelled = lambda rows: append_predictions(rows, load_model, text, normalise)
    return transform_arrivals(spark, source, schema, labelled, target, checkpoint)


def prepare_arrivals(
    spark: SparkSession,
    source: str,
    schema: str | StructType,
    mapping: DataFrame,
    key: str,
    text: str,
    label: str,
    target: str,
    checkpoint: str,
    carry: Sequence[str] = (),
    null_text: str | None = NULL_TEXT,
) -> StreamingQuery:
    """`prepare` over arriving files, with the codes of a saved label mapping.

    A batch run derives the codes from all its rows; a stream cannot, so it takes them from `mapping`
    (`label, encoded_value`), the same for all files. Rows with a label that the mapping lacks are kept
    apart, as they were cleaned, without a code. Each micro-batch writes a folder of its own
    and replaces it if it is run again, so no row is lost or doubled. Read the results with
    `prepared_arrivals` and `unseen_arrivals`.
    """
    small = pin_small(mapping)
    codes = (mapping if small is None else F.broadcast(small)).select(
        F.col("label").alias(label), F.col("encoded_value").alias("label_encoded")
    )
    rows = arriving(spark, source, schema).select(key, text, *carry, label)
    clean = drop_missing_label(rows, label).transform(clean_text, text, null_text=null_text)
    coded = drop_empty_text(clean).join(codes, label, "left")
    shown = coded.select(key, text, "text_clean", *carry, label, "label_encoded")
    folder = target.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        parted = batch.withColumn("arrival_seen", F.col("label_encoded").isNotNull())
        parted.write.mode("overwrite").partitionBy("arrival_seen").parquet(f"{folder}/arrival_batch={number}")

    stream = shown.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def prepared_arrivals(spark: SparkSession, target: str) -> DataFrame:
    """The prepared rows of all runs."""
    return spark.read.parquet(target).filter("arrival_seen = 'true'").drop("arrival_seen", "arrival_batch")


def unseen_arrivals(spark: SparkSession, target: str) -> DataFrame:
    """The rows whose label had no code, of all runs."""
    return spark.read.parquet(target).filter("arrival_seen = 'false'").drop(
        "arrival_seen", "arrival_batch", "label_encoded"
    )
