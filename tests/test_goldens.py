"""Published figures of a known three-class dataset."""

import pytest
from pyspark.sql import functions as F

from labelloom.operators import clean, metrics, profile, resample, split

SIZES = {"in-favor": 2907, "against": 1804, "neutral-or-unclear": 1040}


@pytest.fixture(scope="module")
def rows(spark):
    parts = [
        spark.range(n).select(F.concat(F.lit(label + ":"), "id").alias("key"), F.lit(label).alias("label"))
        for label, n in SIZES.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).cache()


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_distribution(rows):
    shares = as_dict(profile.class_distribution(rows, "label"), "label", "pct")
    assert {k: round(v, 2) for k, v in shares.items()} == {
        "in-favor": 50.55, "against": 31.37, "neutral-or-unclear": 18.08,
    }


def test_label_codes(rows):
    codes = as_dict(clean.label_index(rows, "label"), "label", "encoded_value")
    assert codes == {"against": 0, "in-favor": 1, "neutral-or-unclear": 2}


def test_split_sizes(rows):
    parted = split.stratified_split(rows, "key", "label", 0.2, 42)
    sizes = {(r.label, r.split): r.n for r in split.split_distribution(parted, "label").collect()}
    assert sizes == {
        ("in-favor", "test"): 582, ("against", "test"): 361, ("neutral-or-unclear", "test"): 208,
        ("in-favor", "train"): 2325, ("against", "train"): 1443, ("neutral-or-unclear", "train"): 832,
    }
    train = parted.filter("split = 'train'").drop("split")
    nested = split.nested_split(train, "key", "label", 0.2, 0.125)
    assert as_dict(split.split_sizes(nested), "split", "n") == {"train": 3220, "eval": 460, "test": 920}


def test_floor_split_then_oversample(rows):
    parted = split.stratified_split(rows, "key", "label", 0.2, 42, rounding="floor")
    sizes = as_dict(split.split_sizes(parted), "split", "n")
    assert sizes["test"] == 1149
    train = parted.filter("split = 'train'")
    assert resample.oversample(train, "key", "label").count() == 3 * 2326


def test_imbalance(rows):
    row = profile.imbalance_metrics(rows, "label").first()
    assert (round(row.ratio, 4), round(row.gini, 4)) == (2.7952, 0.6134)
    assert (row.most_frequent, row.least_frequent) == ("in-favor", "neutral-or-unclear")
    assert profile.imbalance_severity(rows, "label").first().severity == "MODERATE"


def test_weights(rows):
    weights = resample.class_weights(rows, "label", [*SIZES, "absent"])
    assert {k: round(v, 4) for k, v in as_dict(weights, "label", "weight").items()} == {
        "in-favor": 0.6594, "against": 1.0626, "neutral-or-unclear": 1.8433, "absent": 1.0,
    }


def test_averages(spark):
    scores = spark.createDataFrame(
        [("in-favor", 0.6953, 582), ("against", 0.5320, 361), ("neutral-or-unclear", 0.2125, 208)],
        "label string, f1 double, support long",
    )
    row = scores.agg(metrics.macro("f1").alias("m"), metrics.weighted("f1").alias("w")).first()
    assert (round(row.m, 4), round(row.w, 4)) == (0.4799, 0.5568)


def test_perfect_predictions_score_one(spark):
    pairs = spark.createDataFrame([(x, x) for x in SIZES], "true string, pred string")
    counts = metrics.confusion_counts(pairs, "true", "pred")
    assert {r.value for r in metrics.training_metrics(counts).collect()} == {1.0}


def test_empty_table_scores_null(spark):
    counts = metrics.confusion_counts(
        spark.createDataFrame([], "true string, pred string"), "true", "pred"
    )
    assert metrics.accuracy(counts).first().accuracy is None
