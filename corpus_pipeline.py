"""From raw documents to packed training sequences, in five stages.

Each stage takes `(spark, docs, sf_dir)` and works on all that its predecessor kept; all but the
last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelloom.llm import exact_dedup, jaccard, packing, pii, quality
from labelloom.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.filter("keep").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return jaccard.drop_near(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; `n_chars` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences."""
    encoder = packing.word_bpe(spark, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_documents(docs, encoder)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("personal data", without_personal_data),
    ("packing", packed),
]

# The classifier and the packing are beyond SQL. Tests hold exact dedup, similarity join and
# personal data against plain Python; which documents the classifier keeps is not verified.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each result written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
