"""Queries: splits, samples, weights and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog import inputs as i
from labelloom.catalog.preparation import rounded
from labelloom.catalog.registry import query
from labelloom.operators import resample, split

KEY, LABEL = "o_orderkey", "o_orderpriority"


def _parted(spark, sf_dir):
    return split.stratified_split(i.orders(spark, sf_dir), KEY, LABEL)


@query(f"WITH {i.SPLIT_PREPARED} SELECT doc_id, lang, split FROM parted")
def stratified_split(spark, sf_dir):
    parted = split.stratified_split(i.prepared_documents(spark, sf_dir), "doc_id", "lang")
    return parted.select("doc_id", "lang", "split")


@query(
    "WITH "
    + i.split_sql("orders", KEY, LABEL, 0.3, "123", "parted", ("train", "test"))
    + f" SELECT {KEY}, {LABEL}, split FROM parted"
)
def stratified_split_70_30(spark, sf_dir):
    return split.stratified_split(i.orders(spark, sf_dir), KEY, LABEL, 0.3, 123)


TURNS = "turns AS (SELECT conv_id || ':' || turn AS key, role FROM conversations)"


@query(
    f"WITH {TURNS}, {i.split_sql('turns', 'key', 'role', 0.1, '42', 'parted', ('train', 'val'))}"
    " SELECT key, role, split FROM parted"
)
def stratified_split_90_10(spark, sf_dir):
    """Rows with a composite key."""
    key = F.concat_ws(":", "conv_id", "turn")
    turns = i.table(spark, sf_dir, "conversations").select(key.alias("key"), "role")
    return split.stratified_split(turns, "key", "role", 0.1, 42, names=("train", "val"))


@query(
    f"""WITH sized AS (
  SELECT {KEY}, {LABEL}, row_number() OVER (PARTITION BY {LABEL} ORDER BY md5('42:' || {KEY}), {KEY}) AS r,
         count(*) OVER (PARTITION BY {LABEL}) AS n FROM orders)
SELECT {KEY}, {LABEL}, CASE WHEN r <= floor(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM sized"""
)
def stratified_split_floor(spark, sf_dir):
    return split.stratified_split(i.orders(spark, sf_dir), KEY, LABEL, rounding="floor")


@query(
    f"""WITH {i.SPLIT_ORDERS},
rest AS (SELECT {KEY}, {LABEL} FROM parted WHERE split = 'train'),
{i.split_sql("rest", KEY, LABEL, 0.125, "42:eval", "inner_", ("train", "eval"))}
SELECT {KEY}, {LABEL}, split FROM inner_
UNION ALL SELECT {KEY}, {LABEL}, split FROM parted WHERE split = 'test'"""
)
def nested_split(spark, sf_dir):
    return split.nested_split(i.orders(spark, sf_dir), KEY, LABEL)


@query(
    f"""WITH {i.SPLIT_ORDERS}
SELECT split, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct
FROM parted GROUP BY split"""
)
def split_sizes(spark, sf_dir):
    return rounded(split.split_sizes(_parted(spark, sf_dir)), "pct")


@query(
    f"""WITH {i.SPLIT_ORDERS}
SELECT split, {LABEL}, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 6) AS pct
FROM parted GROUP BY split, {LABEL}"""
)
def split_distribution(spark, sf_dir):
    return rounded(split.split_distribution(_parted(spark, sf_dir), LABEL), "pct")


CHECK = """, s AS (
  SELECT {0}, count(*) AS o, count(*) FILTER (split = 'train') AS a,
         count(*) FILTER (split = 'test') AS b FROM parted GROUP BY {0}
), q AS (
  SELECT {0}, o::DOUBLE / sum(o) OVER () AS x, a::DOUBLE / sum(a) OVER () AS y,
         b::DOUBLE / sum(b) OVER () AS z FROM s)
SELECT {0}, round(x, 6) AS original_ratio, round(y, 6) AS train_ratio,
       round(z, 6) AS test_ratio, round(abs(y - z), 6) AS difference FROM q"""


@query("WITH " + i.SPLIT_PREPARED + CHECK.format("lang"))
def stratification_check(spark, sf_dir):
    parted = split.stratified_split(i.prepared_documents(spark, sf_dir), "doc_id", "lang")
    return rounded(
        split.stratification_check(parted, "lang"),
        "original_ratio", "train_ratio", "test_ratio", "difference",
    )


@query(
    f"""WITH {i.SPLIT_ORDERS}
SELECT {LABEL}, count(*) AS original, count(*) FILTER (split = 'train') AS train,
       count(*) FILTER (split = 'test') AS test FROM parted GROUP BY {LABEL}"""
)
def split_comparison(spark, sf_dir):
    return split.split_comparison(_parted(spark, sf_dir), LABEL)


WEIGHTED_LABELS = ("en", "fr", "de", "es", "it")
WEIGHTS = """c AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY 1),
w AS (SELECT label, (SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n) AS weight FROM c)"""


@query(
    f"""WITH {WEIGHTS}
SELECT label, round(coalesce(weight, 1.0), 6) AS weight
FROM (SELECT unnest(['en', 'fr', 'de', 'es', 'it']) AS label) LEFT JOIN w USING (label)"""
)
def class_weights(spark, sf_dir):
    weights = resample.class_weights(i.documents(spark, sf_dir), "lang", WEIGHTED_LABELS)
    return rounded(weights, "weight")


@query(
    f"""WITH {WEIGHTS}
SELECT doc_id, lang, round(weight, 6) AS weight FROM documents JOIN w ON lang = label"""
)
def weighted_rows(spark, sf_dir):
    rows = i.documents(spark, sf_dir).select("doc_id", "lang")
    weights = resample.class_weights(rows, "lang", WEIGHTED_LABELS)
    return rounded(resample.weighted_rows(rows, "lang", weights), "weight")


RANKED = """ranked AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS r,
         count(*) OVER (PARTITION BY lang) AS n FROM documents
), sized AS (SELECT *, max(n) OVER () AS top, min(n) OVER () AS low FROM ranked)"""


@query(
    f"""WITH {RANKED}
SELECT doc_id, lang,
       unnest(range(1, (top // n + CASE WHEN r <= top % n THEN 1 ELSE 0 END + 1)::BIGINT)) AS copy_no
FROM sized"""
)
def oversample(spark, sf_dir):
    rows = i.documents(spark, sf_dir).select("doc_id", "lang")
    return resample.oversample(rows, "doc_id", "lang")


@query(f"WITH {RANKED} SELECT doc_id, lang FROM sized WHERE r <= low")
def undersample(spark, sf_dir):
    rows = i.documents(spark, sf_dir).select("doc_id", "lang")
    return resample.undersample(rows, "doc_id", "lang")


@query(
    "SELECT doc_id, text, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100"
)
def sample_n(spark, sf_dir):
    return split.sample_n(i.documents(spark, sf_dir).select("doc_id", "text", "lang"), "doc_id", 100)


@query("SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 10")
def head_n(spark, sf_dir):
    return split.head_n(i.documents(spark, sf_dir).select("doc_id", "text", "lang"), "doc_id", 10)


@query("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5000")
def head_n_5000(spark, sf_dir):
    """Only keys go through the top-n; the rows are fetched by them."""
    return split.head_n(i.orders(spark, sf_dir), "o_orderkey", 5000)


@query(
    """SELECT conv_id, turn, role, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 16 AS batch_id
FROM conversations"""
)
def batch_ids_composite(spark, sf_dir):
    rows = i.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return split.batch_ids(rows, ["conv_id", "turn"], 16)


@query(
    f"""SELECT {KEY}, {LABEL}, (row_number() OVER (ORDER BY {KEY}) - 1) // 16 AS batch_id
FROM orders"""
)
def batch_ids(spark, sf_dir):
    return split.batch_ids(i.orders(spark, sf_dir), KEY, 16)
