"""Scores of a labeller, all derived from one aggregate over (true, predicted)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from labelloom.functions.choose import choose
from labelloom.functions.labels import STANCES
from labelloom.functions.text import preview
from labelloom.operators.clean import label_decode
from labelloom.operators.profile import ratio
from labelloom.plans.lookup import first_rows, literal_table, pull_small, settle, union_all

WIDE_LABELS = 1_000  # labels that may become columns
CELL_LABELS = 50_000  # labels whose pairs may be listed
CELL_BLOCKS = 32


def is_correct(true: str, pred: str) -> Column:
    """True where both labels are present and equal."""
    return F.coalesce(F.col(true) == F.col(pred), F.lit(False))


def confusion_counts(
    df: DataFrame, true: str, pred: str, seconds: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per pair of true and predicted label, and per run with `by`.

    With `seconds` also their sum and the number of rows that have them.
    """
    sums = [F.count("*").alias("n")]
    if seconds is not None:
        sums += [F.sum(seconds).alias("seconds"), F.count(seconds).alias("timed")]
    pair = (F.col(true).alias("true"), F.col(pred).alias("pred"))
    return df.groupBy(*by, *pair).agg(*sums)


def listed(spark: SparkSession, labels: Sequence[str], name: str = "label") -> DataFrame:
    return literal_table(spark, [(label,) for label in labels], f"{name} string")


def confusion_matrix(counts: DataFrame, labels: Sequence[str] = STANCES) -> DataFrame:
    """One row per listed true label, one column per listed predicted label."""
    cells = [
        F.coalesce(F.sum(F.when(F.col("pred") == label, F.col("n"))), F.lit(0)).alias(label)
        for label in labels
    ]
    found = counts.filter(F.col("true").isin(*labels)).groupBy("true").agg(*cells)
    rows = listed(counts.sparkSession, labels, "true")
    return rows.join(found, "true", "left").select(
        "true", *[F.coalesce(F.col(f"`{label}`"), F.lit(0)).alias(label) for label in labels]
    )


def confusion_grid(counts: DataFrame) -> DataFrame:
    """The observed pairs in long form; pairs that never occur are left out."""
    known = F.col("true").isNotNull() & F.col("pred").isNotNull()
    return counts.filter(known).select("true", "pred", "n").orderBy("true", "pred")


def observed_labels(counts: DataFrame) -> DataFrame:
    """All labels seen as true or predicted: `label`."""
    both = counts.select(F.explode(F.array("true", "pred")).alias("label")).distinct()
    return both.filter("label IS NOT NULL")


def observed_matrix(counts: DataFrame, limit: int = WIDE_LABELS) -> DataFrame:
    """The square matrix over all observed labels, zeros included.

    Labels become columns, so more than `limit` of them are an error: `confusion_grid` lists
    the pairs that occur, and `confusion_cells` all pairs, whatever the number of labels.
    """
    counts = settle(counts)
    table = pull_small(observed_labels(counts), limit)
    if table is None:
        raise ValueError(f"more than {limit} labels do not make a matrix; see confusion_cells")
    return confusion_matrix(counts, sorted(table.column("label").to_pylist()))


def confusion_cells(
    counts: DataFrame, limit: int = CELL_LABELS, blocks: int = CELL_BLOCKS
) -> DataFrame:
    """All pairs of observed labels in long form, zeros included: `true, pred, n`.

    This is the matrix itself, the square of the number of labels, which is checked against
    `limit`. Its zeros are made block by block: labels are dealt into `blocks` by hash, and each pair of
    blocks meets in a task of its own, so no task holds all labels.
    """
    counts = settle(counts)
    labels = observed_labels(counts)
    if labels.count() > limit:
        raise ValueError(f"the pairs of more than {limit} labels are too many; see confusion_grid")
    block = F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = labels.select(F.col("label").alias("true"), block.alias("a")).withColumn("b", every)
    columns = labels.select(F.col("label").alias("pred"), block.alias("b")).withColumn("a", every)
    zeros = rows.join(columns, ["a", "b"]).select("true", "pred", F.lit(0).cast("long").alias("n"))
    seen = counts.filter("true IS NOT NULL AND pred IS NOT NULL").select("true", "pred", "n")
    return zeros.unionByName(seen).groupBy("true", "pred").agg(F.sum("n").alias("n"))


def _correct() -> Column:
    return F.sum(F.when(is_correct("true", "pred"), F.col("n")).otherwise(0))


def accuracy(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose labels agree; null for an empty table."""
    return counts.groupBy(*by).agg(ratio(_correct(), F.sum("n")).alias("accuracy"))


def class_prf(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label seen as true or predicted; 0 where undefined.

    Every pair count is handed to its true and to its predicted label, so one small
    aggregate replaces the joins of hits, true rows and predicted rows.
    """
    zero = F.lit(0).cast("long")
    hit = F.when(is_correct("true", "pred"), F.col("n")).otherwise(zero)
    as_true = F.struct(
        F.col("true").alias("label"), F.col("n").alias("t"), zero.alias("p"), hit.alias("h")
    )
    as_pred = F.struct(
        F.col("pred").alias("label"), zero.alias("t"), F.col("n").alias("p"), zero.alias("h")
    )
    sums = (
        counts.select(*by, F.inline(F.array(as_true, as_pred)))
        .filter(F.col("label").isNotNull())
        .groupBy(*by, "label")
        .agg(F.sum("t").alias("t"), F.sum("p").alias("p"), F.sum("h").alias("h"))
    )

    def guarded(part: Column, whole: Column) -> Column:
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    return sums.select(
        *by,
        "label",
        guarded(F.col("h"), F.col("p")).alias("precision"),
        guarded(F.col("h"), F.col("t")).alias("recall"),
        guarded(2 * F.col("h"), F.col("t") + F.col("p")).alias("f1"),
        F.col("t").alias("support"),
    )


def f1_per_class(counts: DataFrame, labels: Sequence[str] = STANCES) -> DataFrame:
    """F1 of each listed label, 0 for one that never occurs."""
    found = class_prf(counts).select("label", "f1")
    return (
        listed(counts.sparkSession, labels)
        .join(found, "label", "left")
        .select("label", F.coalesce("f1", F.lit(0.0)).alias("f1"))
    )


def macro(column: str) -> Column:
    """Plain mean over labels."""
    return F.avg(column)


def weighted(column: str) -> Column:
    """Mean over labels weighted by support."""
    return ratio(F.sum(F.col(column) * F.col("support")), F.sum("support"))


def f1_macro(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean F1 over the observed labels."""
    return class_prf(counts, by).groupBy(*by).agg(macro("f1").alias("f1_macro"))


def f1_weighted(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean F1 over the observed labels, weighted by support."""
    return class_prf(counts, by).groupBy(*by).agg(weighted("f1").alias("f1_weighted"))


def classification_report(counts: DataFrame, digits: int | None = None) -> DataFrame:
    """Per-label rows, then accuracy, macro avg and weighted avg."""
    counts = settle(counts)
    scores = ("precision", "recall", "f1")
    rows = class_prf(counts)
    rows_total = F.sum("support").alias("support")
    parts = [rows.withColumn("block", F.lit(0))]
    for block, (name, mean) in enumerate((("macro avg", macro), ("weighted avg", weighted)), 2):
        parts.append(
            rows.agg(*[mean(s).alias(s) for s in scores], rows_total).select(
                F.lit(name).alias("label"), *scores, "support", F.lit(block).alias("block")
            )
        )
    nothing = F.lit(None).cast("double")
    parts.append(
        counts.agg(ratio(_correct(), F.sum("n")).alias("f1"), F.sum("n").alias("support")).select(
            F.lit("accuracy").alias("label"),
            nothing.alias("precision"),
            nothing.alias("recall"),
            "f1",
            "support",
            F.lit(1).alias("block"),
        )
    )
    report = union_all(parts)
    if digits is not None:
        for score in scores:
            report = report.withColumn(score, F.round(score, digits))
    return report.orderBy("block", "label")


def metrics_bundle(counts: DataFrame, labels: Sequence[str] = STANCES) -> DataFrame:
    """Accuracy, macro and weighted F1, per-class F1 and, with seconds, their mean and total."""
    counts = settle(counts)
    overall = class_prf(counts).agg(
        macro("f1").alias("f1_macro"), weighted("f1").alias("f1_weighted")
    )
    totals = [ratio(_correct(), F.sum("n")).alias("accuracy")]
    names = ["accuracy"]
    if "seconds" in counts.columns:
        totals += [
            ratio(F.sum("seconds"), F.sum("timed")).alias("avg_processing_time"),
            F.sum("seconds").alias("total_processing_time"),
        ]
        names += ["avg_processing_time", "total_processing_time"]

    def long_form(row: DataFrame, columns: Sequence[str]) -> DataFrame:
        entries = [
            F.struct(
                F.lit(c).alias("metric"), F.lit("").alias("label"), F.col(c).alias("value")
            )
            for c in columns
        ]
        return row.select(F.inline(F.array(*entries)))

    per_class = f1_per_class(counts, labels).select(
        F.lit("f1").alias("metric"), "label", F.col("f1").alias("value")
    )
    return union_all(
        [
            long_form(counts.agg(*totals), names),
            long_form(overall, ["f1_macro", "f1_weighted"]),
            per_class,
        ]
    )


def training_metrics(counts: DataFrame) -> DataFrame:
    """The trio reported while training."""
    counts = settle(counts)
    found = {"accuracy": "eval_accuracy", "f1_macro": "eval_macro_f1", "f1_weighted": "eval_weighted_f1"}
    name = choose([(F.col("metric") == metric, alias) for metric, alias in found.items()])
    return (
        metrics_bundle(counts, ())
        .filter(F.col("metric").isin(*found))
        .select(name.alias("metric"), "value")
    )


def latency_summary(df: DataFrame, seconds: str) -> DataFrame:
    """Mean and total of a seconds column."""
    return df.agg(
        F.avg(seconds).alias("avg_processing_time"), F.sum(seconds).alias("total_processing_time")
    )


def outcome_counts(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Number of correct and incorrect rows."""
    right = is_correct(true, pred)
    return df.agg(F.count_if(right).alias("correct"), F.count_if(~right).alias("incorrect"))


def outcome_examples(
    df: DataFrame,
    key: str,
    text: str,
    true: str,
    pred: str,
    raw: str,
    num_samples: int = 10,
) -> DataFrame:
    """The first num_samples // 2 correct and as many incorrect rows, with a text preview.

    Two narrow top-n plans: each task keeps only its own first keys.
    """
    k = num_samples // 2
    right = is_correct(true, pred)
    ordinal = F.row_number().over(Window.orderBy(key))
    parts = [
        first_rows(df.filter(condition), key, k).select(
            F.lit(outcome).alias("outcome"),
            ordinal.alias("ordinal"),
            key,
            preview(F.col(text)).alias("example"),
            F.col(true).alias("true_label"),
            F.col(pred).alias("pred_label"),
            F.col(raw).alias("raw_response"),
        )
        for outcome, condition in (("correct", right), ("incorrect", ~right))
    ]
    return union_all(parts)


def prediction_review(
    df: DataFrame,
    index: DataFrame,
    key: str,
    text: str,
    true_code: str,
    pred_code: str,
    n: int = 10,
) -> DataFrame:
    """The first n rows with a tick or cross, decoded labels and a text preview."""
    top = first_rows(df.select(key, text, true_code, pred_code), key, n)
    named = label_decode(
        label_decode(top, true_code, index, "true_label"), pred_code, index, "pred_label"
    )
    mark = F.when(F.col(true_code) == F.col(pred_code), "✓").otherwise("✗")
    return named.select(
        F.row_number().over(Window.orderBy(key)).alias("ordinal"),
        key,
        mark.alias("mark"),
        "true_label",
        "pred_label",
        preview(F.col(text)).alias("example"),
    )


def baseline_delta(baseline: DataFrame, bundle: DataFrame) -> DataFrame:
    """Baseline, current value and signed difference of accuracy and macro F1.

    `baseline` has `(metric, value)`, plus any columns naming the run.
    """
    current = bundle.filter(F.col("metric").isin("accuracy", "f1_macro")).select(
        "metric", F.col("value").alias("current")
    )
    return baseline.join(F.broadcast(current), "metric").select(
        *[c for c in baseline.columns if c != "value"],
        F.col("value").alias("baseline"),
        "current",
        (F.col("current") - F.col("value")).alias("difference"),
    )
