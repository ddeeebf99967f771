"""TF-IDF in long form: one row per document and term."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window, functions as F

from labelloom.functions.text import STOP_WORDS, content_words, word_key
from labelloom.operators.frequent import frequent_candidates
from labelloom.plans.lookup import lookup_join, pull_small, settle

# Terms up to which they are a constant of the plan; more are joined, with the same result.
VECTOR_TERMS = 20_000


def tokenize_words(
    df: DataFrame, key: str, text: str, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Content words per row, in text order."""
    return df.select(key, content_words(F.col(text), stop_words).alias("tokens"))


def term_statistics(
    df: DataFrame,
    text: str,
    max_features: int = 5_000,
    stop_words: Sequence[str] = STOP_WORDS,
    summary: int | None = None,
) -> DataFrame:
    """The `max_features` most frequent terms: index, total count, document frequency, idf.

    Each document sends its tokens once as occurrences and once as distinct terms, so
    both counts come from one aggregate over terms, combined before the shuffle. With `summary`
    only terms that may be among the most frequent are counted, as `vocabulary` does.
    """
    tokens = df.select(content_words(F.col(text), stop_words).alias("tokens"))
    both = tokens.select(
        F.posexplode(F.array("tokens", F.array_distinct("tokens"))).alias("kind", "terms")
    )
    each = both.select("kind", F.explode("terms").alias("term"))
    if summary:
        found = frequent_candidates(tokens.select(F.explode("tokens")), max_features, summary)
        if found is not None and not found.exact:
            each = lookup_join(each, found.terms.select("term"), "term")
    counts = (
        each.groupBy("term")
        .agg(F.count_if(F.col("kind") == 0).alias("n"), F.count_if(F.col("kind") == 1).alias("df"))
    )
    # At most `max_features` rows reach the ranking window.
    top = counts.orderBy(F.desc("n"), "term").limit(max_features)
    documents = df.agg(F.count("*")).scalar()
    idf = F.log((1.0 + documents) / (1.0 + F.col("df"))) + 1.0
    index = F.row_number().over(Window.orderBy(F.desc("n"), "term")) - 1
    return top.select("term", index.alias("term_index"), "n", "df", idf.alias("idf"))


def with_tokens(df: DataFrame, text: str, stop_words: Sequence[str]) -> DataFrame:
    """Attach the content words, very long ones as digests; a null text has none."""
    tokens = F.transform(content_words(F.col(text), stop_words), word_key)
    return df.withColumn("__tokens", F.coalesce(tokens, F.array().cast("array<string>")))


def tfidf_vectors(terms: Sequence[str], idf: Sequence[float]) -> PipelineModel:
    """Tokens to count vectors and L2-normalised tf x idf vectors over fixed terms."""
    stages: list[Transformer] = [
        CountVectorizerModel.from_vocabulary(list(terms), inputCol="__tokens", outputCol="__tf"),
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="__tf", outputCol="__tfidf"),
        Normalizer(p=2.0, inputCol="__tfidf", outputCol="features"),
    ]
    return PipelineModel(stages)


def tfidf(
    df: DataFrame,
    terms: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """L2-normalised tf x idf weights over the given terms.

    A null text has no terms. Up to VECTOR_TERMS terms this is map-only: each row is
    counted, weighted and normalised as a sparse vector, whose non-zero parts are listed. With more
    terms the tokens are counted by an aggregate.
    """
    terms = settle(terms)
    table = pull_small(
        terms.select("term_index", "term", "idf", word_key(F.col("term")).alias("word")),
        VECTOR_TERMS,
    )
    if table is None:
        return _tfidf_by_document(df, terms, key, text, stop_words)
    table = table.sort_by("term_index")
    vectors = tfidf_vectors(table.column("word").to_pylist(), table.column("idf").to_pylist())
    names = F.from_json(F.lit(json.dumps(table.column("term").to_pylist())), "array<string>")
    # Both vectors are sparse over the same terms; an idf is never zero.
    counts, weights = F.unwrap_udt("__tf"), F.unwrap_udt("features")
    cells = F.arrays_zip(
        counts["indices"].alias("place"), counts["values"].alias("tf"), weights["values"].alias("weight")
    )
    return (
        vectors.transform(with_tokens(df.select(key, text), text, stop_words))
        .select(key, F.explode(cells).alias("__cell"))
        .select(
            key,
            F.get(names, F.col("__cell.place")).alias("term"),
            F.col("__cell.tf").cast("long").alias("tf"),
            F.col("__cell.weight").alias("weight"),
        )
    )


def _tfidf_by_document(
    df: DataFrame, terms: DataFrame, key: str, text: str, stop_words: Sequence[str]
) -> DataFrame:
    """Counting by document and term, combined before the shuffle."""
    tokens = df.select(key, F.explode(content_words(F.col(text), stop_words)).alias("term"))
    counts = (
        lookup_join(tokens, terms.select("term", "idf"), "term")
        .groupBy(key, "term", "idf")
        .agg(F.count("*").alias("tf"))
    )
    raw = counts.withColumn("__raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("__raw") * F.col("__raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", (F.col("__raw") / norm).alias("weight"))
