"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from labelloom.functions.prompts import render_prompt
from labelloom.operators import clean, features, labelling, metrics, resample, sequences, split
from labelloom.plans import scratch
from labelloom.plans.scratch import scratch_path

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(DOCUMENTS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def map_only(df):
    text = plan(df)
    return "Exchange hashpartitioning" not in text and "Exchange SinglePartition" not in text


def test_rows_are_never_shuffled(spark, documents):
    vocab = sequences.vocabulary(documents, "text", 500)
    terms = features.term_statistics(documents, "text", 500)
    weights = resample.class_weights(documents, "lang", ["en", "fr"])
    plans = {
        "prepare": clean.prepare(documents, "doc_id", "text", "lang"),
        "stratified_split": split.stratified_split(documents, "doc_id", "lang"),
        "nested_split": split.nested_split(documents, "doc_id", "lang"),
        "undersample": resample.undersample(documents, "doc_id", "lang"),
        "oversample": resample.oversample(documents, "doc_id", "lang"),
        "weighted_rows": resample.weighted_rows(documents, "lang", weights),
        "encode": sequences.encode_sequence(documents, vocab, "doc_id", "text", "lang"),
        "tfidf": features.tfidf(documents, terms, "doc_id", "text"),
        "labels": labelling.append_predictions(documents, labelling.KeywordModel, "text"),
        "prompts": documents.select(render_prompt(F.col("text"))),
    }
    assert [name for name, df in plans.items() if not map_only(df)] == []


def test_scores_read_two_columns_and_shuffle_counts(documents):
    counts = metrics.confusion_counts(documents, "lang", "source")
    text = plan(metrics.class_prf(counts))
    assert "ReadSchema: struct<lang:string,source:string>" in text
    assert "partial_count" in text and "Join" not in text


def test_no_cross_joins(spark):
    import __spark_entry__ as contract

    known = contract.queries()
    for name in ("classification_report", "imbalance_metrics", "confusion_matrix", "class_weights"):
        text = plan(known[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "cleared")
    spark.range(3).write.parquet(path)
    scratch.clear(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
