"""Labelling with answers that are kept between runs: a text is put to a model version once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.functions.labels import label_lenient
from labelloom.operators.labelling import Model, raw_responses
from labelloom.plans.lookup import lookup_join
from labelloom.plans.scratch import written

STEPS = 8  # parts of the new texts whose answers are kept as soon as each is done
HOT_ROWS = 100_000  # rows of one text from which its answer is broadcast

ANSWERS = "digest string, raw_response string"


def text_digest(text: str) -> Column:
    """What names a text in the store; a null text is put to the model as the empty one."""
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)


def kept_answers(spark: SparkSession, store: str, version: str) -> DataFrame:
    """The answers that the store holds of this model version: `digest, raw_response`.

    A run that was lost after its answers were written may have left some twice; one of them counts.
    """
    try:
        found = spark.read.schema(ANSWERS).parquet(version_path(store, version))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], ANSWERS)
    return found.groupBy("digest").agg(F.min("raw_response").alias("raw_response"))


def version_path(store: str, version: str) -> str:
    if not version or any(c in version for c in "/\\:*?{}[] \t\n"):
        raise ValueError("a model version is a plain name, as it is part of a path")
    return f"{store.rstrip('/')}/version={version}"


def label_new(
    df: DataFrame, load_model: Callable[[], Model], text: str, store: str, version: str,
    steps: int = STEPS, **options,
) -> DataFrame:
    """Put every text that the store lacks to the model, once; `digest, n` of all texts.

    Only digests are compared and shuffled, combined first; the one row that stands for a new
    text is then found by its place among the rows. The new texts are labelled in `steps`, and
    each step's answers are kept as soon as it is done: a run that fails goes on
    from there the next time. Rows that the model could not answer (`on_error='null'`)
    are not kept and are asked again.
    """
    spark = df.sparkSession
    # Written, so that a row keeps its number in both uses.
    rows = written(
        df.select(F.monotonically_increasing_id().alias("row"), text_digest(text).alias("digest"), F.col(text).alias("asked")),
        "labelling-rows",
    )
    texts = rows.groupBy("digest").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    new = texts.join(kept_answers(spark, store, version), "digest", "left_anti")
    step = F.pmod(F.xxhash64("digest"), F.lit(steps)).cast("int")
    asked = written(
        rows.join(new.select("row"), "row", "left_semi").select("digest", "asked", step.alias("step")),
        "labelling-texts",
    )
    for number in range(steps):
        part = asked.filter(F.col("step") == number).drop("step")
        if part.isEmpty():
            continue
        answered = raw_responses(part, load_model, "asked", **options)
        answered.select("digest", "raw_response").filter(F.col("raw_response").isNotNull()).write.mode(
            "append"
        ).parquet(version_path(store, version))
    return texts.select("digest", "n")


def with_answers(df: DataFrame, texts: DataFrame, answers: DataFrame, text: str, into: str) -> DataFrame:
    """The rows with their texts' answers, null where there is none.

    The answers of texts with very many rows, of which there can be few, are looked up
    without a shuffle of those rows; the others are joined by digest.
    """
    known = texts.join(answers, "digest")
    often = F.col("n") >= HOT_ROWS
    own = F.col("digest").alias("__digest")
    hot = known.filter(often).select(own, F.col("raw_response").alias("__hot"))
    cold = known.filter(~often).select(own.alias("__key"), F.col("raw_response").alias("__cold"))
    marked = lookup_join(df.withColumn("__digest", text_digest(text)), hot, "__digest", "left")
    # Rows that have their answer get a key of their own, so they do not meet in one task.
    alone = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    key = F.when(F.col("__hot").isNotNull(), alone).otherwise(F.col("__digest"))
    joined = marked.withColumn("__key", key).join(cold, "__key", "left")
    return joined.withColumn(into, F.coalesce("__hot", "__cold")).drop("__key", "__hot", "__cold", "__digest")


def batch_label_kept(
    df: DataFrame,
    load_model: Callable[[], Model],
    key: str,
    text: str,
    store: str,
    version: str,
    normalise: Callable[[Column], Column] = label_lenient,
    steps: int = STEPS,
    **options,
) -> DataFrame:
    """`batch_label` whose answers are kept in the folder `store`: key, predicted label, raw response.

    The model sees a text only if the store has no answer of this `version` to it, and
    repeated texts once. The model must answer a text alike whatever its batch. One run at a time may
    write to a version; several versions may lie in one store.
    """
    texts = label_new(df, load_model, text, store, version, steps, **options)
    answers = kept_answers(df.sparkSession, store, version)
    answered = with_answers(df.select(key, text), texts, answers, text, "raw_response")
    return answered.select(key, normalise(F.col("raw_response")).alias("label_pred"), "raw_response")


def append_predictions_kept(
    df: DataFrame,
    load_model: Callable[[], Model],
    text: str,
    store: str,
    version: str,
    normalise: Callable[[Column], Column] = label_lenient,
    into: str = "label_pred",
    steps: int = STEPS,
    **options,
) -> DataFrame:
    """`append_predictions` with the answers kept as in `batch_label_kept`."""
    plain = df.drop(into)
    texts = label_new(plain, load_model, text, store, version, steps, **options)
    answers = kept_answers(df.sparkSession, store, version)
    answered = with_answers(plain, texts, answers, text, "__raw")
    return answered.select(*plain.columns, normalise(F.col("__raw")).alias(into))
