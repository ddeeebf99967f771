"""Training pairs, corpus vocabulary and fixed-length id sequences."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from labelloom.functions.prompts import render_prompt
from labelloom.functions.sequences import EOS_ID, FIRST_FREE_ID, PAD_ID, UNK_ID, pad, truncate
from labelloom.functions.text import word_key, words
from labelloom.operators.frequent import frequent_candidates
from labelloom.plans.lookup import lookup_join, pull_small, salted_join

DICTIONARY_SLOTS = 4096
DICTIONARY_WORDS = 100_000


def training_pairs(
    df: DataFrame, key: str, text: str, label: str, template: str = "instruction"
) -> DataFrame:
    """Prompt and target text per row."""
    return df.select(
        key, render_prompt(F.col(text), template).alias("text"), F.col(label).alias("label_text")
    )


def vocabulary(df: DataFrame, text: str, size: int = 8_000, summary: int | None = None) -> DataFrame:
    """The `size` most frequent tokens with ids by frequency rank, ties by token.

    Ids start above the reserved pad, end and unknown ids. With `summary` each task first sends at
    most that many tokens, and only those that may be among the most frequent are counted and
    shuffled, with the same result; where the summaries leave it open, all are counted.
    """
    tokens = df.select(F.explode(words(F.col(text))).alias("token"))
    found = frequent_candidates(tokens, size, summary) if summary else None
    if found is not None and found.exact:
        counts = found.terms.withColumnRenamed("term", "token")
    else:
        if found is not None:
            tokens = lookup_join(tokens, found.terms.select(F.col("term").alias("token")), "token")
        counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    # At most `size` rows reach the ranking window.
    top = counts.orderBy(F.desc("n"), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.select("token", "n", (rank + (FIRST_FREE_ID - 1)).alias("id"))


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(DICTIONARY_SLOTS)).cast("int")


def dictionary(vocab: DataFrame) -> Column | None:
    """The vocabulary as a constant, or None where it has more than DICTIONARY_WORDS words.

    The constant is an array of small maps addressed by word hash, so a lookup takes
    constant time.
    """
    key = word_key(F.col("token"))
    table = pull_small(
        vocab.select(key.alias("word"), "id", _slot(key).alias("slot")), DICTIONARY_WORDS
    )
    if table is None:
        return None
    slots: list[dict[str, int]] = [{} for _ in range(DICTIONARY_SLOTS)]
    for row in table.to_pylist():
        slots[row["slot"]][row["word"]] = row["id"]
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string,int>>")


def look_up(tokens: Column, constant: Column) -> Column:
    """Ids of a token array from a `dictionary`; the unknown id for other words."""

    def one(token: Column) -> Column:
        word = word_key(token)
        return F.coalesce(
            F.try_element_at(F.get(constant, _slot(word)), word), F.lit(UNK_ID)
        )

    return F.transform(tokens, one)


def with_ids(
    df: DataFrame, vocab: DataFrame, key: str, text: str, max_length: int, into: str,
    constant: Column | None = None,
) -> DataFrame:
    """Attach the token ids with the end id, at most `max_length` in all; null for a null text.

    Within the dictionary limit this is map-only. A larger vocabulary is joined: a row
    yields at most `max_length` tokens, and hot tokens are salted.
    """
    kept = truncate(words(F.col(text)), max_length - 1)
    constant = dictionary(vocab) if constant is None else constant
    end = F.array(F.lit(EOS_ID))
    if constant is not None:
        return df.withColumn(into, F.concat(look_up(kept, constant), end))
    tokens = df.select(key, F.posexplode(kept).alias("__place", "token"))
    known = F.coalesce("id", F.lit(UNK_ID)).alias("id")
    ids = (
        salted_join(tokens, vocab.select("token", "id"), "token", "left")
        .groupBy(key)
        .agg(F.collect_list(F.struct("__place", known)).alias("__ids"))
    )
    ordered = F.transform(F.array_sort("__ids"), lambda pair: pair.getField("id"))
    nothing = F.array().cast("array<int>")
    return (
        df.join(ids, key, "left")
        .withColumn(into, F.when(F.col(text).isNotNull(), F.concat(F.coalesce(ordered, nothing), end)))
        .drop("__ids")
    )


def encode_sequence(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    text: str,
    target: str,
    max_length: int = 256,
    max_target_length: int = 16,
) -> DataFrame:
    """Text and target as id arrays of fixed length: cut, closed by the end id, padded."""
    constant = dictionary(vocab)  # one pass over the corpus for both columns
    rows = df.select(key, text, target)
    rows = with_ids(rows, vocab, key, text, max_length, "input_ids", constant)
    rows = with_ids(rows, vocab, key, target, max_target_length, "labels", constant)
    return rows.select(
        key,
        pad(F.col("input_ids"), F.lit(max_length)).alias("input_ids"),
        pad(F.col("labels"), F.lit(max_target_length)).alias("labels"),
    )


def truncate_sequence(
    df: DataFrame, vocab: DataFrame, key: str, text: str, max_length: int = 512
) -> DataFrame:
    """Text as an id array of at most `max_length`, without padding."""
    rows = with_ids(df.select(key, text), vocab, key, text, max_length, "input_ids")
    return rows.select(key, "input_ids")


def batch_pad(df: DataFrame, ids: str, batch: str = "batch_id") -> DataFrame:
    """Pad each id array to the longest in its batch."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return df.withColumn("__length", longest).withColumn(
        ids, pad(F.col(ids), F.col("__length"))
    ).drop("__length")


def decode_sequence(df: DataFrame, vocab: DataFrame, key: str, ids: str) -> DataFrame:
    """Ids back to text: reserved ids left out, tokens joined by a blank; null for null ids.

    Map-only within the dictionary limit, a salted join beyond it.
    """
    free = F.filter(F.col(ids), lambda i: ~i.isin(PAD_ID, EOS_ID, UNK_ID))
    table = pull_small(vocab.select("token", "id"), DICTIONARY_WORDS)
    if table is not None:
        by_id = {row["id"]: row["token"] for row in table.to_pylist()}
        tokens = [by_id.get(i) for i in range(max(by_id, default=UNK_ID) + 1)]
        lookup = F.from_json(F.lit(json.dumps(tokens)), "array<string>")
        return df.select(
            key, F.array_join(F.transform(free, lambda i: F.get(lookup, i)), " ").alias("text")
        )
    places = df.select(key, F.posexplode(free).alias("__place", "id"))
    found = (
        salted_join(places, vocab.select("token", "id"), "id")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("__place", "token"))).alias("__words"))
    )
    text = F.array_join(F.transform("__words", lambda pair: pair.getField("token")), " ")
    return df.select(key, ids).join(found, key, "left").select(
        key, F.when(F.col(ids).isNotNull(), F.coalesce(text, F.lit(""))).alias("text")
    )
