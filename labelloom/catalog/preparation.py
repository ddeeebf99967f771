"""Queries: sources, profiling, cleaning and encoding."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from labelloom.catalog import inputs as i
from labelloom.catalog.registry import query
from labelloom.operators import checks, clean, profile, split
from labelloom.plans.lookup import settle
from labelloom.plans.scratch import scratch_path, written
from labelloom.sources import ranges, tables
from labelloom.streaming import arrivals

SIX = 6


def rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, SIX))
    return df


CSV_ORACLE = f"""WITH {i.RAW_DOCUMENTS}
SELECT doc_id, coalesce(nullif(text, ''), '(null)') AS text, coalesce(lang, '(null)') AS lang,
       source, n_chars FROM raw_documents"""

RAW_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _nulls_shown(df):
    shown = {c: F.coalesce(c, F.lit("(null)")) for c in ("text", "lang")}
    return df.withColumns(shown)


@query(CSV_ORACLE)
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv_scan")
    tables.csv_sink(i.raw_documents(spark, sf_dir), path)
    return _nulls_shown(tables.csv_scan(spark, path, RAW_SCHEMA))


@query(CSV_ORACLE)
def csv_scan_reordered(spark, sf_dir):
    """Columns written in another order, with one more, are found by name."""
    path = scratch_path(spark, "csv_scan_reordered")
    rows = i.raw_documents(spark, sf_dir)
    tables.csv_sink(rows.select(F.lit("x").alias("more"), *reversed(rows.columns)), path)
    return _nulls_shown(tables.csv_scan(spark, path, RAW_SCHEMA))


@contextmanager
def _ranges_of(spark, size):
    """Within it, Spark reads files in byte ranges of this size."""
    name, start = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = {n: spark.conf.get(n) for n in (name, start)}
    spark.conf.set(name, size)
    spark.conf.set(start, "1")
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


@query(CSV_ORACLE)
def csv_scan_ranges(spark, sf_dir):
    """Files with quoted line breaks, each written by one task of the scan and read by many."""
    path = scratch_path(spark, "csv_scan_ranges")
    tables.csv_sink(i.raw_documents(spark, sf_dir), path)
    with _ranges_of(spark, "256k"):
        # Written while the ranges are set, since a scan is cut when it runs.
        return written(_nulls_shown(ranges.csv_scan_ranges(spark, path, RAW_SCHEMA)), "scanned")


def _shuffled_file(spark, sf_dir):
    """Documents in files whose rows are not in key order, with their position in them.

    There are as many files as the scan has tasks, so that none holds more as the table grows.
    """
    path = scratch_path(spark, "shuffled_file")
    documents = i.documents(spark, sf_dir)
    files = max(3, documents.rdd.getNumPartitions())
    rows = documents.withColumn("place", F.md5(F.col("doc_id").cast("string")))
    parts = rows.repartitionByRange(files, "place").sortWithinPartitions("place").drop("place")
    tables.csv_sink(parts, path)
    return ranges.csv_scan_ranges(spark, path, RAW_SCHEMA, position="position")


@query(
    """SELECT upper(lang) AS label, arg_min(doc_id, md5(doc_id::VARCHAR)) AS first_key,
  left(arg_min(text, md5(doc_id::VARCHAR)), 100) || '...' AS example FROM documents GROUP BY lang"""
)
def class_example_in_order(spark, sf_dir):
    """The first text of each label in file order."""
    return profile.class_example_in_order(_shuffled_file(spark, sf_dir), "position", "doc_id", "text", "lang")


@query(
    """SELECT doc_id, text, lang, source, n_chars FROM documents
ORDER BY md5(doc_id::VARCHAR) LIMIT 10"""
)
def head_in_order(spark, sf_dir):
    """The first ten rows in file order."""
    return split.head_in_order(_shuffled_file(spark, sf_dir), "position", 10).drop("position")


@query(
    f"""WITH {i.SPLIT_ORDERS}
SELECT o_orderkey, o_orderpriority, split FROM parted"""
)
def csv_sink(spark, sf_dir):
    from labelloom.operators.split import stratified_split

    path = scratch_path(spark, "csv_sink")
    parted = stratified_split(i.orders(spark, sf_dir), "o_orderkey", "o_orderpriority")
    tables.splits_sink(parted, path, fmt="csv")
    schema = "o_orderkey long, o_orderpriority string"
    sides = [
        tables.csv_scan(spark, f"{path}/split={side}", schema, side) for side in ("train", "test")
    ]
    return sides[0].unionByName(sides[1])


@query(
    """SELECT count(*) AS n_rows, 11::INTEGER AS n_columns,
  'l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, '
  || 'l_tax, l_returnflag, l_linestatus, l_shipdate' AS columns FROM lineitem"""
)
def dataset_shape(spark, sf_dir):
    return profile.dataset_shape(i.table(spark, sf_dir, "lineitem"))


@query(
    f"""WITH {i.RAW_DOCUMENTS}, counted AS (
  SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS "column",
         unnest([count(*) - count(doc_id), count(*) - count(text), count(*) - count(lang),
                 count(*) - count(source), count(*) - count(n_chars)])::BIGINT AS missing,
         count(*) AS total FROM raw_documents)
SELECT "column", missing, round(missing * 100.0::DOUBLE / total, 6) AS pct FROM counted
WHERE missing > 0"""
)
def missing_profile(spark, sf_dir):
    return rounded(profile.missing_profile(i.raw_documents(spark, sf_dir)), "pct")


DISTRIBUTION = """SELECT label, n, round(n * 100.0::DOUBLE / total, 6) AS pct FROM (
  SELECT {0} AS label, count(*) AS n, sum(count(*)) OVER () AS total FROM {1} GROUP BY 1)
WHERE label IS NOT NULL"""


@query(f"WITH {i.RAW_DOCUMENTS} " + DISTRIBUTION.format("lang", "raw_documents"))
def class_distribution(spark, sf_dir):
    return rounded(profile.class_distribution(i.raw_documents(spark, sf_dir), "lang"), "pct")


@query(DISTRIBUTION.format("l_returnflag", "lineitem"))
def class_distribution_lineitem(spark, sf_dir):
    return rounded(
        profile.class_distribution(i.table(spark, sf_dir, "lineitem"), "l_returnflag"), "pct"
    )


@query(
    f"""WITH {i.RAW_DOCUMENTS}
SELECT count(DISTINCT lang) + max((lang IS NULL)::INTEGER)::BIGINT AS n_classes_with_null,
       count(DISTINCT lang) AS n_classes FROM raw_documents"""
)
def class_count(spark, sf_dir):
    return profile.class_count(i.raw_documents(spark, sf_dir), "lang")


@query(
    """SELECT upper(lang) AS label, doc_id AS first_key, left(text, 100) || '...' AS example
FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY lang)"""
)
def class_example(spark, sf_dir):
    return profile.class_example(i.documents(spark, sf_dir), "doc_id", "text", "lang")


@query(
    f"""WITH {i.RATED}, d AS ({DISTRIBUTION.format("quality", "rated")})
SELECT label, n, pct, CASE WHEN pct < 10 THEN 'underrepresented'
                           WHEN pct > 90 THEN 'overrepresented' ELSE 'balanced' END AS flag FROM d"""
)
def class_share_flag(spark, sf_dir):
    return rounded(profile.class_share_flag(i.rated_documents(spark, sf_dir), "quality"), "pct")


RATIO = """WITH c AS (SELECT {0} AS label, count(*) AS n FROM {1} WHERE {0} IS NOT NULL GROUP BY 1)
SELECT round(max(n)::DOUBLE / min(n), 6) AS ratio FROM c"""


@query(
    f"""SELECT ratio, CASE WHEN ratio > 2 THEN 'significant' WHEN ratio > 1.5 THEN 'moderate'
  ELSE 'balanced' END AS level FROM ({RATIO.format("event_type", "events")})"""
)
def imbalance_ratio(spark, sf_dir):
    return rounded(profile.imbalance_ratio(i.table(spark, sf_dir, "events"), "event_type"), "ratio")


@query(
    f"""WITH {i.RAW_DOCUMENTS}, c AS (
  SELECT lang, count(*) AS n, sum(count(*)) OVER () AS total FROM raw_documents GROUP BY 1
), k AS (SELECT * FROM c WHERE lang IS NOT NULL)
SELECT round(max(n)::DOUBLE / min(n), 6) AS ratio,
       round(1 - sum(pow(n::DOUBLE / total, 2)), 6) AS gini,
       (SELECT lang FROM k ORDER BY n DESC, lang LIMIT 1) AS most_frequent, max(n) AS max_count,
       (SELECT lang FROM k ORDER BY n, lang DESC LIMIT 1) AS least_frequent, min(n) AS min_count,
       max(n) - min(n) AS difference FROM k"""
)
def imbalance_metrics(spark, sf_dir):
    return rounded(
        profile.imbalance_metrics(i.raw_documents(spark, sf_dir), "lang"), "ratio", "gini"
    )


@query(
    f"""SELECT ratio, CASE WHEN ratio > 3 THEN 'SEVERE' WHEN ratio > 2 THEN 'MODERATE'
    WHEN ratio > 1.5 THEN 'MILD' ELSE 'MINIMAL' END AS severity,
  CASE WHEN ratio > 3 THEN 'Strongly consider resampling techniques'
       WHEN ratio > 2 THEN 'Consider resampling or class weights'
       WHEN ratio > 1.5 THEN 'Monitor performance, consider class weights'
       ELSE 'Dataset is reasonably balanced' END AS recommendation
FROM ({RATIO.format("lang", "documents")})"""
)
def imbalance_severity(spark, sf_dir):
    return rounded(profile.imbalance_severity(i.documents(spark, sf_dir), "lang"), "ratio")


@query(
    f"""WITH {i.RAW_DOCUMENTS}, d AS ({DISTRIBUTION.format("lang", "raw_documents")}),
r AS (SELECT *, n::DOUBLE / max(n) OVER () AS share FROM d)
SELECT label, n, pct, round(share, 6) AS ratio_to_max, round(log10(n), 6) AS log10_n,
       CASE WHEN share < 0.5 THEN 'UNDERREPRESENTED' WHEN share > 0.8 THEN 'WELL REPRESENTED'
            ELSE 'MODERATELY REPRESENTED' END AS status FROM r"""
)
def class_representation(spark, sf_dir):
    return rounded(
        profile.class_representation(i.raw_documents(spark, sf_dir), "lang"),
        "pct", "ratio_to_max", "log10_n",
    )


@query(
    f"""WITH {i.SPLIT_ORDERS}, s AS (
  SELECT count(*)::DOUBLE AS a, (count(*) FILTER (split = 'train'))::DOUBLE AS b,
         (count(*) FILTER (split = 'test'))::DOUBLE AS c FROM parted)
SELECT unnest(['Total Samples', 'Training Samples', 'Testing Samples', 'Train/Test Ratio']) AS metric,
       round(unnest([a, b, c, b / c]), 6) AS value FROM s"""
)
def dataset_summary(spark, sf_dir):
    from labelloom.operators.split import stratified_split

    parted = stratified_split(i.orders(spark, sf_dir), "o_orderkey", "o_orderpriority")
    return rounded(profile.dataset_summary(parted), "value")


@query(
    f"WITH {i.RAW_DOCUMENTS} SELECT doc_id, lang, source FROM raw_documents WHERE lang IS NOT NULL"
)
def drop_missing_label(spark, sf_dir):
    kept = clean.drop_missing_label(i.raw_documents(spark, sf_dir), "lang")
    return kept.select("doc_id", "lang", "source")


@query(
    f"""WITH {i.RAW_DOCUMENTS} SELECT count(*) AS n_rows, count(lang) AS n_kept,
  count(*) - count(lang) AS n_removed FROM raw_documents"""
)
def drop_missing_label_report(spark, sf_dir):
    return clean.missing_label_report(i.raw_documents(spark, sf_dir), "lang")


@query(f"WITH {i.RAW_DOCUMENTS} SELECT doc_id, {i.STRIP} AS text_clean FROM raw_documents")
def clean_text(spark, sf_dir):
    return clean.clean_text(i.raw_documents(spark, sf_dir), "text").select("doc_id", "text_clean")


@query(
    f"""WITH {i.RAW_DOCUMENTS}
SELECT * FROM (SELECT doc_id, {i.STRIP} AS text_clean FROM raw_documents)
WHERE length(text_clean) > 0"""
)
def drop_empty_text(spark, sf_dir):
    cleaned = clean.clean_text(i.raw_documents(spark, sf_dir), "text")
    return clean.drop_empty_text(cleaned).select("doc_id", "text_clean")


INDEX = """SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS encoded_value
FROM (SELECT DISTINCT {0} AS label FROM {1} WHERE {0} IS NOT NULL)"""


@query(INDEX.format("lang", "documents"))
def label_index(spark, sf_dir):
    return clean.label_index(i.documents(spark, sf_dir), "lang")


@query(
    f"""WITH x AS ({INDEX.format("o_orderpriority", "orders")})
SELECT o_orderkey, o_orderpriority, encoded_value AS label_encoded
FROM orders JOIN x ON o_orderpriority = label"""
)
def label_encode(spark, sf_dir):
    return clean.label_encode(i.orders(spark, sf_dir), "o_orderpriority")


@query("SELECT o_orderkey, o_orderpriority AS label FROM orders")
def label_decode(spark, sf_dir):
    rows = i.orders(spark, sf_dir)
    index = settle(clean.label_index(rows, "o_orderpriority"))
    coded = clean.label_encode(rows, "o_orderpriority", index).drop("o_orderpriority")
    return clean.label_decode(coded, "label_encoded", index).select("o_orderkey", "label")


@query(INDEX.format("o_orderpriority", "orders"))
def label_mapping(spark, sf_dir):
    path = scratch_path(spark, "label_mapping")
    tables.csv_sink(clean.label_index(i.orders(spark, sf_dir), "o_orderpriority"), path)
    return tables.csv_scan(spark, path, tables.LABEL_MAPPING_SCHEMA)


@query(
    f"""WITH {i.PREPARED}
SELECT doc_id, coalesce(text, '(null)') AS text, text_clean, source, n_chars, lang, label_encoded
FROM prepared"""
)
def prepare(spark, sf_dir):
    shown = F.coalesce("text", F.lit("(null)"))
    return i.prepared_documents(spark, sf_dir).withColumn("text", shown)


@query(
    f"""WITH {i.PREPARED}
SELECT doc_id, coalesce(text, '(null)') AS text, text_clean, source, n_chars, lang, label_encoded
FROM prepared"""
)
def prepare_arrivals(spark, sf_dir):
    """Documents that arrive as files, prepared as a stream with the codes of a saved mapping."""
    source, mapping, target, state = (
        scratch_path(spark, f"arrivals-{name}") for name in ("source", "mapping", "target", "state")
    )
    rows = i.raw_documents(spark, sf_dir)
    tables.csv_sink(rows, source)
    tables.csv_sink(clean.label_index(i.documents(spark, sf_dir), "lang"), mapping)
    codes = tables.csv_scan(spark, mapping, tables.LABEL_MAPPING_SCHEMA)
    arrivals.prepare_arrivals(
        spark, source, RAW_SCHEMA, codes, "doc_id", "text", "lang", target, state, ["source", "n_chars"]
    ).awaitTermination()
    return arrivals.prepared_arrivals(spark, target).withColumn("text", F.coalesce("text", F.lit("(null)")))


REQUIRED = ("text", "lang", "label_pred")


@query(
    f"""WITH {i.RAW_DOCUMENTS}, counted AS (
  SELECT unnest(['text', 'lang', 'label_pred']) AS "column",
         unnest([true, true, false]) AS present,
         unnest([count(*) - count(text), count(*) - count(lang), count(*)])::BIGINT AS missing,
         count(*) AS total FROM raw_documents)
SELECT "column", present, missing, round(missing * 100.0::DOUBLE / total, 6) AS pct FROM counted"""
)
def required_columns(spark, sf_dir):
    return rounded(checks.required_columns(i.raw_documents(spark, sf_dir), REQUIRED), "pct")
