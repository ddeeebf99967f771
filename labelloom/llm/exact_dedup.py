"""Exact deduplication by full content, safe for very large groups of copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.llm.common import SPACE, stored, table, whole
from labelloom.llm.registry import query

SALTS = 16

Digest = Callable[[Column], Column]


def normalised(text: str | Column) -> Column:
    """The text with each run of white space as one space; null is the empty text."""
    return F.regexp_replace(whole(text), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Digest = sha256
) -> DataFrame:
    """One row per distinct text: `digest, keep_id, group_size`, in the shared folder.

    Three combining steps, and each groups by digest *and* full text, so a shared digest
    never merges two texts. Every task first combines its own rows (the partial
    aggregate); what is left of one text then meets by salt, where the salt is the
    task's number, so a text that fills a third of the table arrives as one row per
    task, spread over SALTS groups; last, the at most SALTS winners of a text meet.
    `keep_id` is the smallest key of the text.
    """
    content = normalised(text)
    rows = docs.select(
        F.col(key).alias("id"),
        content.alias("content"),
        digest(content).alias("digest"),
        F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"),
    )
    by_salt = rows.groupBy("digest", "salt", "content").agg(
        F.min("id").alias("id"), F.count("*").alias("n")
    )
    by_text = by_salt.groupBy("digest", "content").agg(
        F.min("id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    return stored(by_text.select("digest", "keep_id", "group_size"), "exact-winners")


def addressed(
    docs: DataFrame, key: str, text: str, digest: Digest
) -> tuple[DataFrame, DataFrame, Digest]:
    """Winners, rows as `id, address`, and the function that makes an address of a text.

    A text is addressed by its digest, which is exact once the winners, combined on full
    content, show no digest twice. Where one does, the text itself is the address.
    """
    winners = exact_groups(docs, key, text, digest)
    shared = winners.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1")
    address = digest
    if not shared.isEmpty():
        address = lambda content: content
        winners = (
            docs.select(F.col(key).alias("id"), normalised(text).alias("digest"))
            .groupBy("digest")
            .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        )
    rows = docs.select(F.col(key).alias("id"), address(normalised(text)).alias("address"))
    return winners.withColumnRenamed("digest", "address"), rows, address


def mark_exact(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Digest = sha256
) -> DataFrame:
    """One row per row of `docs`: `key, keep_id, group_size, kept, text_sha256`.

    Texts are equal when identical after `normalised`. The row with the smallest key
    stays; of repeated rows (same key and text) one stays. A null key sorts last: such
    a row stays only where its text has no row with a key, and then `keep_id` is null.
    An empty table gives no rows; other columns are ignored.
    """
    winners, rows, address = addressed(docs, key, text, digest)
    copies = rows.groupBy("id", "address").agg(F.count("*").alias("copies"))
    single = winners.filter("group_size = 1").select(
        F.col("keep_id").alias("id"), "keep_id", "group_size", "address", F.lit(1).alias("copy")
    )
    # A large group meets its winner in SALTS places.
    salted = winners.filter("group_size > 1").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    several = (
        copies.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        .join(salted, ["address", "salt"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("id", "keep_id", "group_size", "address", "copy")
    )
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    sha = F.col("address") if address is sha256 else F.sha2("address", 256)
    return single.unionByName(several).select(
        F.col("id").alias(key), "keep_id", "group_size", kept.alias("kept"),
        sha.alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay under the rules of `mark_exact`, with all their columns.

    Of repeated rows the smallest by all columns stays.
    """
    winners, rows, address = addressed(docs, key, text, sha256)
    stay = winners.select(F.col("keep_id").alias("__keep"), F.col("address").alias("__stay"))
    full = docs.withColumn("__address", address(normalised(text)))
    # Both columns are join keys, so the rows of a large group spread over all tasks.
    same = F.col(key).eqNullSafe(F.col("__keep")) & (F.col("__address") == F.col("__stay"))
    left = full.join(stay, same, "left_semi")
    repeated = rows.groupBy("id", "address").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return left.drop("__address")
    row = F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("row")
    return left.groupBy(F.col("__address")).agg(row).select("row.*")


@query(
    sql=r"""
    WITH t AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
        FROM documents
    ), g AS (
        SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size
        FROM t
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM g
    """
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest doc_id of its text and the size of its group."""
    return mark_exact(table(spark, sf_dir, "documents"))
