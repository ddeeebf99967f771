"""The pipeline's stages on a small corpus, each against its own definition."""

import cases
import pytest

import corpus_pipeline as pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages_are_named():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "personal data", "packing",
    ]


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1])
def test_columns_stay(spark, name, stage):
    for docs in (cases.frame(spark), cases.empty(spark)):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert out.count() <= docs.count()


def test_run(spark):
    pieces = pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r[0] for r in pieces.select("doc_id").distinct().collect()}
    known = {r[0] for r in docs.select("doc_id").collect()}
    assert kept and kept < known
    # All ids of every document that is left are there once.
    sums = pieces.groupBy("doc_id", "doc_tokens").sum("length").collect()
    assert len(sums) == len(kept) and all(r["doc_tokens"] == r["sum(length)"] for r in sums)
