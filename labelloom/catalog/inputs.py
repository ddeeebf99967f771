"""Inputs of the queries: views on the driver tables, in Spark and in SQL.

The driver tables hold neither nulls nor outer whitespace nor stance labels, so those
are derived from the row key, over the whole table, in the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.functions.choose import choose
from labelloom.operators.clean import prepare
from labelloom.plans.spread import spread

# Labels of the stance views.
LANG_TO_STANCE = {"en": "in-favor", "fr": "against"}

# Answers a model might give, dealt out by key modulo their number.
ANSWERS = (
    "in-favor",
    "  against ",
    "Neutral-or-Unclear",
    "Not in-favor, against",
    "FAVOR",
    "unclear",
    "",
    "neutral favor",
    "I am AGAINST it",
    "no idea",
    "neutral",
    "against",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work on their texts."""
    return spread(documents(spark, sf_dir), "doc_id")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as they might arrive: padded, blank and null texts, null labels."""
    key = F.col("doc_id")
    padded = F.concat(F.lit("\t \u3000"), F.col("text"), F.lit("\n\xa0"))
    text = (
        F.when(key % 11 == 0, F.lit(None)).when(key % 10 == 0, "\xa0\t\n ").otherwise(padded)
    )
    lang = F.when(key % 13 != 5, F.col("lang"))
    return documents(spark, sf_dir).select(
        "doc_id", text.alias("text"), lang.alias("lang"), "source", "n_chars"
    )


RAW_DOCUMENTS = """raw_documents AS (
  SELECT doc_id,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              WHEN doc_id % 10 = 0 THEN chr(160) || chr(9) || chr(10) || ' '
              ELSE chr(9) || ' ' || chr(12288) || text || chr(10) || chr(160) END AS text,
         CASE WHEN doc_id % 13 <> 5 THEN lang END AS lang, source, n_chars
  FROM documents)"""

W = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
STRIP = f"regexp_replace(coalesce(text, 'nan'), '^{W}+|{W}+$', '', 'g')"


def prepared_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(
        raw_documents(spark, sf_dir), "doc_id", "text", "lang", carry=["source", "n_chars"]
    )


PREPARED = f"""{RAW_DOCUMENTS}, cleaned AS (
  SELECT *, {STRIP} AS text_clean FROM raw_documents WHERE lang IS NOT NULL
), prepared AS (
  SELECT doc_id, text, text_clean, source, n_chars, lang,
         (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER AS label_encoded
  FROM cleaned WHERE length(text_clean) > 0)"""


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality rating, null for the many that have none."""
    rating = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents(spark, sf_dir).select("doc_id", "lang").join(rating, "doc_id", "left")


RATED = """rated AS (
  SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def by_key(key: str, values: tuple[str, ...]) -> Column:
    """One of the values by key modulo their number."""
    return F.get(
        F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values)).cast("int")
    )


def by_key_sql(key: str, values: tuple[str, ...]) -> str:
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{items}])[({key} % {len(values)} + 1)::INTEGER]"


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A free-text answer per order."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", by_key("o_orderkey", ANSWERS).alias("answer")
    )


ANSWERED = f"""answered AS (
  SELECT o_orderkey, {by_key_sql("o_orderkey", ANSWERS)} AS answer FROM orders)"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a predicted type that is wrong for some keys, once with an unknown label."""
    key = F.col("event_id")
    pred = (
        F.when(key % 5 == 0, "view").when(key % 7 == 3, "other").otherwise(F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("true"), pred.alias("pred"),
        F.col("value").alias("seconds"),
    )


SCORED_EVENTS = """scored AS (
  SELECT event_id, event_type AS "true",
         CASE WHEN event_id % 5 = 0 THEN 'view' WHEN event_id % 7 = 3 THEN 'other'
              ELSE event_type END AS pred, value AS seconds
  FROM events)"""

EVENT_LABELS = ("signup", "error", "click", "view", "purchase", "refund")


def stance_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a stance by language and an answer by key, right for most."""
    stance = choose(
        [(F.col("lang") == lang, label) for lang, label in LANG_TO_STANCE.items()],
        "neutral-or-unclear",
    )
    raw = F.when(F.col("doc_id") % 4 == 1, by_key("doc_id", ANSWERS)).otherwise(
        F.concat(F.lit("Answer: "), F.upper(stance))
    )
    return documents(spark, sf_dir).select(
        "doc_id", "text", "source", stance.alias("true"), raw.alias("raw_response")
    )


LENIENT = """CASE WHEN contains(lower({0}), 'in-favor') THEN 'in-favor'
              WHEN contains(lower({0}), 'against') THEN 'against'
              WHEN contains(lower({0}), 'neutral-or-unclear') THEN 'neutral-or-unclear'
              WHEN contains(lower({0}), 'favor') THEN 'in-favor'
              ELSE 'neutral-or-unclear' END"""
SUBSTRING = """CASE WHEN contains(lower({0}), 'in-favor') THEN 'in-favor'
              WHEN contains(lower({0}), 'against') THEN 'against'
              ELSE 'neutral-or-unclear' END"""

STANCE = f"""stance AS (
  SELECT doc_id, text, source, "true",
         CASE WHEN doc_id % 4 = 1 THEN {by_key_sql("doc_id", ANSWERS)}
              ELSE 'Answer: ' || upper("true") END AS raw_response
  FROM (SELECT *, CASE lang WHEN 'en' THEN 'in-favor' WHEN 'fr' THEN 'against'
                            ELSE 'neutral-or-unclear' END AS "true" FROM documents)
), judged AS (
  SELECT *, {LENIENT.format("raw_response")} AS pred FROM stance)"""


def split_sql(
    source: str, key: str, label: str, size: float, salt: str, name: str, sides: tuple[str, str]
) -> str:
    """CTEs that add an exact stratified split to `source`, as `name`."""
    return f"""{name}_c AS (
  SELECT {label}, count(*) AS n FROM {source} GROUP BY {label}
), {name}_t AS (
  SELECT sum(n)::HUGEINT AS total, ceil(sum(n)::DOUBLE * {size}::DOUBLE)::HUGEINT AS held
  FROM {name}_c
), {name}_f AS (
  SELECT {label}, held, (n * held) // total AS base, (n * held) % total AS rest
  FROM {name}_c, {name}_t
), {name}_q AS (
  SELECT {label}, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label})
                              <= held - sum(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM {name}_f
), {name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{salt}:' || {key}), {key}) AS r
  FROM {source}
), {name} AS (
  SELECT {name}_r.* EXCLUDE (r),
         CASE WHEN r <= quota THEN '{sides[1]}' ELSE '{sides[0]}' END AS split
  FROM {name}_r JOIN {name}_q USING ({label}))"""


SPLIT_ORDERS = split_sql(
    "orders", "o_orderkey", "o_orderpriority", 0.2, "42", "parted", ("train", "test")
)
SPLIT_PREPARED = (
    PREPARED + ", " + split_sql("prepared", "doc_id", "lang", 0.2, "42", "parted", ("train", "test"))
)
