"""Metric reports as text, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from labelloom.functions.choose import choose
from labelloom.functions.text import fixed_point
from labelloom.operators.metrics import classification_report, metrics_bundle
from labelloom.plans.lookup import literal_table, settle, union_all

# The wording of the metric lines, with unit and decimals.
METRIC_LINES = (
    ("accuracy", "Accuracy: ", 4, ""),
    ("f1_macro", "F1 Score (Macro): ", 4, ""),
    ("f1_weighted", "F1 Score (Weighted): ", 4, ""),
    ("avg_processing_time", "Average Processing Time: ", 2, " seconds"),
    ("total_processing_time", "Total Processing Time: ", 2, " seconds"),
)
# The wording of the preparation report, as published.
PREPARATION_TITLE = "DATASET PREPARATION SUMMARY REPORT"
PREPARATION_REST = (
    "",
    "Data Quality:",
    "- Missing values handled: Yes",
    "- Empty tweets removed: Yes",
    "- Labels encoded: Yes",
    "- Stratified split: Yes (maintains class balance)",
    "",
    "Output Files:",
    "- train_data.csv: Training dataset",
    "- test_data.csv: Test dataset  ",
    "- label_mapping.csv: Label encoding mapping",
    "- dataset_analysis.png: Visualization of distributions",
    "",
    "Preprocessing Steps:",
    "1. Loaded original CSV file",
    "2. Removed rows with missing labels",
    "3. Cleaned tweet text (removed leading/trailing whitespace)",
    "4. Removed empty tweets",
    "5. Encoded categorical labels",
    "6. Performed stratified train/test split (80/20)",
    "7. Verified class balance maintained in both splits",
    "8. Saved processed datasets",
    "",
    "The dataset is now ready for training and testing with proper class balance maintained.",
)
READ_BACK = (("accuracy", "Accuracy:"), ("f1_macro", "F1 Score (Macro):"))


def evaluation_report(
    counts: DataFrame, labels: Sequence[str], title: str, model: str, device: str = "spark"
) -> DataFrame:
    """The lines `(line_no, line)` of an evaluation report."""
    counts = settle(counts)
    spark = counts.sparkSession
    bundle = settle(metrics_bundle(counts, labels))
    report = settle(classification_report(counts))

    def fixed(lines: Sequence[str], block: int) -> DataFrame:
        rows = [(block, i, line) for i, line in enumerate(lines)]
        return literal_table(spark, rows, "block int, place int, line string")

    def placed(df: DataFrame, block: int, place: Column, line: Column) -> DataFrame:
        return df.select(
            F.lit(block).alias("block"), place.cast("int").alias("place"), line.alias("line")
        )

    total = counts.agg(F.sum("n").alias("n"))
    places, shown = [], []
    for i, (metric, text, digits, unit) in enumerate(METRIC_LINES):
        is_metric = F.col("metric") == metric
        value = fixed_point(F.col("value"), digits)
        places.append((is_metric, i))
        shown.append((is_metric, F.concat(F.lit(text), value, F.lit(unit))))
    class_place = F.array_position(F.array(*[F.lit(label) for label in labels]), F.col("label"))
    per_class = F.concat(F.lit("  "), "label", F.lit(": "), fixed_point(F.col("value"), 4))

    width = max(len("weighted avg"), *[len(label) for label in labels])
    scores = [
        F.lpad(F.coalesce(fixed_point(F.col(c), 2), F.lit("")), 10, " ")
        for c in ("precision", "recall", "f1")
    ]
    row = F.concat(
        F.lpad("label", width, " "), F.lit(" "), *scores, F.lpad(F.col("support").cast("string"), 10, " ")
    )
    heads = "".join(name.rjust(10) for name in ("precision", "recall", "f1-score", "support"))
    order = F.row_number().over(Window.orderBy("block", "label"))
    named = bundle.filter(F.col("metric") != "f1")
    parts = [
        fixed([title, "=" * 50, "", f"Model: {model}", f"Device: {device}"], 0),
        placed(total, 1, F.lit(0), F.concat(F.lit("Total samples: "), F.col("n").cast("string"))),
        fixed([""], 2),
        placed(named, 3, choose(places), choose(shown)),
        fixed(["", "Per-class F1 Scores:"], 4),
        placed(bundle.filter(F.col("metric") == "f1"), 5, class_place, per_class),
        fixed(["", "Detailed Classification Report:", " " * (width + 1) + heads, ""], 6),
        placed(report.filter(F.col("block") == 0), 7, order, row),
        fixed([""], 8),
        placed(report.filter(F.col("block") > 0), 9, order, row),
    ]
    # A few lines per class: the numbering window is bounded by the number of classes.
    numbered = F.row_number().over(Window.orderBy("block", "place"))
    return union_all(parts).select(numbered.alias("line_no"), "line")


def preparation_report(
    counts: DataFrame, sizes: DataFrame, source: str, n_columns: int, rest: Sequence[str] = PREPARATION_REST
) -> DataFrame:
    """The lines `(line_no, line)` of a data preparation report.

    `counts` is a class distribution, `sizes` the split sizes of the prepared table. The
    split ratio and `rest` are worded as for a split of 80 to 20.
    """
    counts, sizes = settle(counts), settle(sizes)
    spark = counts.sparkSession

    def fixed(lines: Sequence[str], block: int) -> DataFrame:
        rows = [(block, i, line) for i, line in enumerate(lines)]
        return literal_table(spark, rows, "block int, place int, line string")

    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    texts = [
        F.concat(F.lit("- Total samples: "), F.col("n").cast("string")),
        F.lit(f"- Features: {n_columns}"),
        F.concat(F.lit("- Classes: "), F.col("k").cast("string")),
    ]
    about = totals.select(
        F.lit(1).alias("block"), F.posexplode(F.array(*texts)).alias("place", "line")
    )
    classes = counts.select(
        F.lit(3).alias("block"),
        F.row_number().over(Window.orderBy(F.desc("n"), "label")).alias("place"),
        F.concat(
            F.lit("- "), "label", F.lit(": "), F.col("n").cast("string"), F.lit(" samples ("),
            fixed_point(F.col("pct"), 2), F.lit("%)"),
        ).alias("line"),
    )
    splits = sizes.select(
        F.lit(5).alias("block"),
        F.when(F.col("split") == "train", 0).otherwise(1).alias("place"),
        F.concat(
            F.lit("- "), F.initcap("split"), F.lit(" samples: "), F.col("n").cast("string"),
            F.lit(" ("), fixed_point(F.col("pct"), 1), F.lit("%)"),
        ).alias("line"),
    )
    title = PREPARATION_TITLE
    parts = [
        fixed([title, "=" * len(title), "", "Dataset Information:", f"- Original file: {source}"], 0),
        about,
        fixed(["", "Class Distribution:"], 2),
        classes,
        fixed(["", "Train/Test Split:"], 4),
        splits,
        fixed(["- Split ratio: 80% train / 20% test", *rest], 6),
    ]
    numbered = F.row_number().over(Window.orderBy("block", "place"))
    return union_all(parts).select(numbered.alias("line_no"), "line")


def report_sink(lines: DataFrame, path: str) -> None:
    """Write `(line_no, line)` as one text file; with a `run` column, one folder per run."""
    if "run" in lines.columns:
        ordered = lines.repartition("run").sortWithinPartitions("run", "line_no")
        ordered.select("run", "line").write.mode("overwrite").partitionBy("run").text(path)
    else:
        ordered = lines.coalesce(1).sortWithinPartitions("line_no")
        ordered.select("line").write.mode("overwrite").text(path)


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of every report under a folder: `(file, line_no, line)`.

    Reports are a few lines each; they are read whole so that line order is certain.
    """
    files = (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )
    body = F.regexp_replace("value", r"\n\z", "")
    return files.select("file", F.posexplode(F.split(body, "\n")).alias("line_no", "line"))


def report_parse(lines: DataFrame, by: str = "file") -> DataFrame:
    """Accuracy and macro F1 per report; where a metric occurs twice, the last line counts."""
    metric = choose([(F.col("line").contains(mark), name) for name, mark in READ_BACK])
    value = F.expr("try_cast(trim(split_part(line, ':', 2)) AS double)")
    return (
        lines.select(by, "line_no", metric.alias("metric"), value.alias("value"))
        .filter(F.col("metric").isNotNull())
        .groupBy(by, "metric")
        .agg(F.max_by("value", "line_no").alias("value"))
    )
