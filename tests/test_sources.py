"""Files: what is written comes back."""

import pytest
from pyspark.sql import functions as F

from labelloom.operators.labelling import KeywordModel
from labelloom.sources import reports, tables
from labelloom.functions.prompts import render_prompt
from labelloom.operators import clean
from labelloom.streaming.arrivals import (
    label_arrivals, prepare_arrivals, prepared_arrivals, transform_arrivals, unseen_arrivals,
)

TEXTS = [
    'plain', 'comma, "quoted" and \\ slash', 'two\nlines', 'dos\r\nlines', '  outer blanks  ',
    "nan", "null", '""', "#hash", "tab\there",
]


def test_csv_round_trip(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, "")]
    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)
    tables.csv_sink(df, str(tmp_path / "t"))
    back = tables.csv_scan(spark, str(tmp_path / "t"), "id long, t string", "test")
    got = {r.id: r.t for r in back.collect()}
    assert got == {**dict(enumerate(TEXTS)), 100: None, 101: None}
    assert {r.split for r in back.collect()} == {"test"}


def test_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "label string, id long, more string").coalesce(
        1
    ).write.options(**tables.CSV_OPTIONS).csv(path)
    got = tables.csv_scan(spark, path, "id long, label string")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="no column absent"):
        tables.csv_scan(spark, path, "id long, absent string")


@pytest.mark.parametrize("row", ["zz,b", "3,c,extra", "4"])
def test_malformed_rows_are_refused_or_reported(spark, tmp_path, row):
    (tmp_path / "t.csv").write_text(f"id,label\n1,a\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed|cast"):
        tables.csv_scan(spark, str(tmp_path), "id long, label string").collect()
    got = tables.csv_scan(spark, str(tmp_path), "id long, label string", malformed="raw").collect()
    assert [(r.id, r.label) for r in got if r.raw is None] == [(1, "a")]
    assert [r.raw for r in got if r.raw is not None] == [row]


def test_last_metric_line_counts(spark, tmp_path):
    for run, score in (("a", "0.5000"), ("b", "0.7500")):
        (tmp_path / run).mkdir()
        (tmp_path / run / "report.txt").write_text(
            f"TITLE\n\nAccuracy: 0.1000\nF1 Score (Macro): {score}\nF1 Score (Weighted): 0.9\n"
            f"Accuracy: {score}\n"
        )
    lines = reports.report_lines(spark, str(tmp_path))
    assert lines.count() == 12
    got = sorted((r.metric, r.value) for r in reports.report_parse(lines).collect())
    assert got == [("accuracy", 0.5), ("accuracy", 0.75), ("f1_macro", 0.5), ("f1_macro", 0.75)]


def test_arriving_files_are_labelled_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id long, tweet string"

    def arrive(rows):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").options(**tables.CSV_OPTIONS).csv(source)
        label_arrivals(spark, source, schema, KeywordModel, "tweet", target, checkpoint).awaitTermination()
        return {r.id: r.label_pred for r in spark.read.parquet(target).collect()}

    assert arrive([(1, "I refuse the vaccine"), (2, "hello\nthere")]) == {
        1: "against", 2: "neutral-or-unclear",
    }
    assert arrive([(3, "the vaccine is safe")])[3] == "in-favor"
    assert spark.read.parquet(target).count() == 3


def test_arriving_files_are_prepared_as_a_batch_is(spark, tmp_path):
    """The batch operator's rows; a label without a code goes to the side, and nothing twice."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id long, t string, label string, more string"
    mapping = spark.createDataFrame([("a", 0), ("b", 1)], "label string, encoded_value int")
    batches = [
        [(1, " x\n", "a", "m"), (2, None, "b", "m"), (3, "\u3000 ", "a", "m"), (4, "y", None, "m")],
        [(5, "z, \"q\"", "c", "m"), (6, "w", "b", None)],
    ]

    def arrive(rows):
        if rows:
            df = spark.createDataFrame(rows, schema).coalesce(1)
            df.write.mode("append").options(**tables.CSV_OPTIONS).csv(source)
        run = prepare_arrivals(spark, source, schema, mapping, "id", "t", "label", target, state, ["more"])
        run.awaitTermination()

    for rows in [*batches, []]:
        arrive(rows)
    everything = spark.createDataFrame(sum(batches, []), schema)
    want = clean.prepare(everything.filter("label <> 'c'"), "id", "t", "label", carry=["more"])
    got = prepared_arrivals(spark, target)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [tuple(r) for r in unseen_arrivals(spark, target).collect()] == [(5, 'z, "q"', 'z, "q"', "m", "c")]


def test_row_wise_operators_run_on_a_stream(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(1, "a\nb"), (2, "{tweet}"), (3, "c")]
    df = spark.createDataFrame(rows, "id long, t string")
    tables.csv_sink(df, source)
    prompts = lambda part: part.select("id", render_prompt(F.col("t"), "instruction").alias("p"))
    transform_arrivals(spark, source, "id long, t string", prompts, target, state).awaitTermination()
    got = spark.read.parquet(target).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, prompts(df).collect()))
