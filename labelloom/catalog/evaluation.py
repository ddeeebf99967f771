"""Queries: scores, examples, reports and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog import inputs as i
from labelloom.catalog.preparation import rounded
from labelloom.catalog.registry import query
from labelloom.catalog.texts import (
    AGAINST, FAVOR, GATE, any_sql, load_keyword_model, prompt_sql,
)
from labelloom.functions.labels import STANCES, label_lenient
from labelloom.operators import checks, clean, metrics
from labelloom.operators.evaluation import score_labeller
from labelloom.plans.lookup import settle
from labelloom.plans.scratch import scratch_path
from labelloom.plans.spread import spread
from labelloom.sources import reports

SCORES = ("precision", "recall", "f1")


def _counts(spark, sf_dir):
    return metrics.confusion_counts(i.scored_events(spark, sf_dir), "true", "pred", "seconds")


def _judged(spark, sf_dir):
    pred = label_lenient(F.col("raw_response")).alias("pred")
    return i.stance_documents(spark, sf_dir).select("*", pred)


def _judged_counts(spark, sf_dir):
    return metrics.confusion_counts(_judged(spark, sf_dir), "true", "pred")


def prf_sql(source: str, name: str, by: str = "") -> str:
    """CTE with precision, recall, F1 and support per label of a `(true, pred)` table."""
    keys = f"{by}, " if by else ""
    return f"""{name}_labels AS (
  SELECT {keys}"true" AS label FROM {source} UNION SELECT {keys}pred FROM {source}
), {name}_s AS (
  SELECT {keys}label,
         (SELECT count(*) FROM {source} s WHERE s."true" = l.label {f"AND s.{by} = l.{by}" if by else ""}) AS t,
         (SELECT count(*) FROM {source} s WHERE s.pred = l.label {f"AND s.{by} = l.{by}" if by else ""}) AS p,
         (SELECT count(*) FROM {source} s WHERE s."true" = l.label AND s.pred = l.label
            {f"AND s.{by} = l.{by}" if by else ""}) AS h
  FROM {name}_labels l
), {name} AS (
  SELECT {keys}label, CASE WHEN p = 0 THEN 0 ELSE h::DOUBLE / p END AS precision,
         CASE WHEN t = 0 THEN 0 ELSE h::DOUBLE / t END AS recall,
         CASE WHEN t + p = 0 THEN 0 ELSE 2.0::DOUBLE * h / (t + p) END AS f1, t AS support
  FROM {name}_s)"""


EVENTS_PRF = f"{i.SCORED_EVENTS}, {prf_sql('scored', 'prf')}"
JUDGED_PRF = f"{i.STANCE}, {prf_sql('judged', 'prf')}"


@query(
    f"""WITH {i.SCORED_EVENTS}
SELECT "true", pred, count(*) AS n, round(sum(seconds), 6) AS seconds, count(seconds) AS timed
FROM scored GROUP BY 1, 2"""
)
def confusion_counts(spark, sf_dir):
    return rounded(_counts(spark, sf_dir), "seconds")


@query(
    f"""WITH {i.SCORED_EVENTS}, l AS (SELECT unnest({list(i.EVENT_LABELS)}) AS label)
SELECT label AS "true", """
    + ", ".join(
        f"count(*) FILTER (pred = '{label}' AND \"true\" IS NOT NULL) AS {label}"
        for label in i.EVENT_LABELS
    )
    + """ FROM l LEFT JOIN scored ON "true" = label GROUP BY label"""
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_counts(spark, sf_dir), i.EVENT_LABELS)


@query(
    f"""WITH {i.SCORED_EVENTS} SELECT "true", pred, count(*) AS n FROM scored GROUP BY 1, 2"""
)
def confusion_grid(spark, sf_dir):
    return metrics.confusion_grid(_counts(spark, sf_dir))


# The event types, and the label that only predictions have.
OBSERVED = ("click", "error", "other", "purchase", "signup", "view")


@query(
    f"""WITH {i.SCORED_EVENTS}, l AS (SELECT unnest({list(OBSERVED)}) AS label)
SELECT label AS "true", """
    + ", ".join(
        f"count(*) FILTER (pred = '{label}' AND \"true\" IS NOT NULL) AS {label}" for label in OBSERVED
    )
    + """ FROM l LEFT JOIN scored ON "true" = label GROUP BY label"""
)
def observed_matrix(spark, sf_dir):
    """The square matrix over the labels that occur, whatever they are."""
    return metrics.observed_matrix(_counts(spark, sf_dir))


@query(
    f"""WITH {i.SCORED_EVENTS}, l AS (
  SELECT unnest([{', '.join(f"'{x}'" for x in OBSERVED)}]) AS label
)
SELECT a.label AS "true", b.label AS pred, count(event_id) AS n
FROM l a CROSS JOIN l b LEFT JOIN scored s ON s."true" = a.label AND s.pred = b.label GROUP BY ALL"""
)
def confusion_cells(spark, sf_dir):
    """The same matrix in long form."""
    return metrics.confusion_cells(_counts(spark, sf_dir))


TIMED = """timed AS (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS seconds FROM events)"""


@query(
    f"""WITH {TIMED} SELECT round(avg(seconds), 6) AS mean_of_bundle, round(avg(seconds), 6) AS mean_of_summary,
  round(sum(seconds), 6) AS total FROM timed"""
)
def latency_with_nulls(spark, sf_dir):
    """Rows without seconds count in neither mean."""
    seconds = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    label = F.col("event_type")
    rows = i.table(spark, sf_dir, "events").select(
        label.alias("true"), label.alias("pred"), seconds.alias("seconds")
    )
    bundle = metrics.metrics_bundle(metrics.confusion_counts(rows, "true", "pred", "seconds"), ())
    mean = bundle.filter("metric = 'avg_processing_time'").agg(F.max("value")).scalar()
    summary = metrics.latency_summary(rows, "seconds").select(
        mean.alias("mean_of_bundle"), F.col("avg_processing_time").alias("mean_of_summary"),
        F.col("total_processing_time").alias("total"),
    )
    return rounded(summary, "mean_of_bundle", "mean_of_summary", "total")


@query(
    f"""WITH {i.SCORED_EVENTS}
SELECT round(avg(("true" = pred)::INTEGER), 6) AS accuracy FROM scored"""
)
def accuracy(spark, sf_dir):
    return rounded(metrics.accuracy(_counts(spark, sf_dir)), "accuracy")


PRF = "label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support"


@query(f"WITH {EVENTS_PRF} SELECT {PRF} FROM prf")
def class_prf(spark, sf_dir):
    return rounded(metrics.class_prf(_counts(spark, sf_dir)), *SCORES)


LISTED = f"(SELECT unnest({list(i.EVENT_LABELS)}) AS label)"


@query(
    f"""WITH {EVENTS_PRF}
SELECT label, round(coalesce(f1, 0), 6) AS f1 FROM {LISTED} LEFT JOIN prf USING (label)"""
)
def f1_per_class(spark, sf_dir):
    return rounded(metrics.f1_per_class(_counts(spark, sf_dir), i.EVENT_LABELS), "f1")


@query(f"WITH {EVENTS_PRF} SELECT round(avg(f1), 6) AS f1_macro FROM prf")
def f1_macro(spark, sf_dir):
    return rounded(metrics.f1_macro(_counts(spark, sf_dir)), "f1_macro")


@query(
    f"WITH {EVENTS_PRF} SELECT round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM prf"
)
def f1_weighted(spark, sf_dir):
    return rounded(metrics.f1_weighted(_counts(spark, sf_dir)), "f1_weighted")


def report_sql(source: str) -> str:
    """All rows of a classification report over `prf`, unrounded."""
    return f"""SELECT label, precision, recall, f1, support, 0 AS block FROM prf
UNION ALL SELECT 'accuracy', NULL, NULL, avg(("true" = pred)::INTEGER), count(*), 1 FROM {source}
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT, 2 FROM prf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT, 3
FROM prf"""


@query(
    f"""WITH {EVENTS_PRF}
SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       support, block FROM ({report_sql("scored")})"""
)
def classification_report(spark, sf_dir):
    return metrics.classification_report(_counts(spark, sf_dir), digits=4)


def bundle_sql(source: str, labels: tuple[str, ...], seconds: bool) -> str:
    parts = [
        f"""SELECT 'accuracy' AS metric, '' AS label, avg(("true" = pred)::INTEGER) AS value FROM {source}""",
        "SELECT 'f1_macro', '', avg(f1) FROM prf",
        "SELECT 'f1_weighted', '', sum(f1 * support) / sum(support) FROM prf",
        f"""SELECT 'f1', label, coalesce(f1, 0)
FROM (SELECT unnest({list(labels)}) AS label) LEFT JOIN prf USING (label)""",
    ]
    if seconds:
        parts += [
            f"SELECT 'avg_processing_time', '', avg(seconds) FROM {source}",
            f"SELECT 'total_processing_time', '', sum(seconds) FROM {source}",
        ]
    return "\nUNION ALL ".join(parts)


@query(
    f"""WITH {EVENTS_PRF}
SELECT metric, label, round(value, 6) AS value FROM ({bundle_sql("scored", i.EVENT_LABELS, True)})"""
)
def metrics_bundle(spark, sf_dir):
    return rounded(metrics.metrics_bundle(_counts(spark, sf_dir), i.EVENT_LABELS), "value")


@query(
    f"""WITH {JUDGED_PRF}
SELECT CASE metric WHEN 'accuracy' THEN 'eval_accuracy' WHEN 'f1_macro' THEN 'eval_macro_f1'
            ELSE 'eval_weighted_f1' END AS metric, round(value, 6) AS value
FROM ({bundle_sql("judged", STANCES, False)}) WHERE metric <> 'f1'"""
)
def training_metrics(spark, sf_dir):
    return rounded(metrics.training_metrics(_judged_counts(spark, sf_dir)), "value")


def answer_sql(text: str) -> str:
    return f"""CASE WHEN {any_sql(GATE, text)} AND {any_sql(AGAINST, text)} THEN 'against'
            WHEN {any_sql(GATE, text)} AND {any_sql(FAVOR, text)} THEN 'in-favor'
            ELSE 'neutral-or-unclear' END"""


@query(
    f"""WITH {i.STANCE}, answered AS (
  SELECT "true", {answer_sql(prompt_sql("zero_shot"))} AS pred FROM judged),
{prf_sql("answered", "prf")}
SELECT metric, label, round(value, 6) AS value FROM ({bundle_sql("answered", STANCES, False)})"""
)
def evaluate_labeller_prompted(spark, sf_dir):
    """The same labeller on the rendered prompt, whose words it takes for the text's."""
    rows = spread(i.stance_documents(spark, sf_dir).drop("raw_response"), "doc_id")
    scored = score_labeller(rows, load_keyword_model, "doc_id", "text", "true", "zero_shot")
    counts = metrics.confusion_counts(scored, "true", "label_pred")
    return rounded(metrics.metrics_bundle(counts), "value")


@query(
    f"""WITH {i.STANCE}, answered AS (
  SELECT doc_id, "true", {answer_sql("text")} AS label_pred FROM judged
  ORDER BY md5('42:' || doc_id), doc_id LIMIT 50)
SELECT doc_id, "true", label_pred, label_pred AS raw_response FROM answered"""
)
def score_labeller_sample(spark, sf_dir):
    """Fifty sampled rows, end to end."""
    rows = i.stance_documents(spark, sf_dir).drop("raw_response")
    return score_labeller(
        rows, load_keyword_model, "doc_id", "text", "true", sample_size=50
    ).drop("text")


@query(
    f"""WITH {i.STANCE}, answered AS (SELECT "true", {answer_sql("text")} AS pred FROM judged),
{prf_sql("answered", "prf")}
SELECT metric, label, round(value, 6) AS value FROM ({bundle_sql("answered", STANCES, False)})"""
)
def evaluate_labeller(spark, sf_dir):
    rows = spread(i.stance_documents(spark, sf_dir).drop("raw_response"), "doc_id")
    scored = score_labeller(rows, load_keyword_model, "doc_id", "text", "true")
    counts = metrics.confusion_counts(scored, "true", "label_pred")
    return rounded(metrics.metrics_bundle(counts), "value")


@query(
    """SELECT round(avg(value), 6) AS avg_processing_time,
  round(sum(value), 6) AS total_processing_time FROM events"""
)
def latency_summary(spark, sf_dir):
    summary = metrics.latency_summary(i.table(spark, sf_dir, "events"), "value")
    return rounded(summary, "avg_processing_time", "total_processing_time")


@query(
    f"""WITH {i.SCORED_EVENTS}
SELECT count(*) FILTER ("true" = pred) AS correct, count(*) FILTER ("true" <> pred) AS incorrect
FROM scored"""
)
def outcome_counts(spark, sf_dir):
    return metrics.outcome_counts(i.scored_events(spark, sf_dir), "true", "pred")


@query(
    f"""WITH {i.STANCE}, o AS (
  SELECT *, CASE WHEN "true" = pred THEN 'correct' ELSE 'incorrect' END AS outcome FROM judged
), r AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY doc_id) AS k FROM o)
SELECT outcome, k::INTEGER AS ordinal, doc_id, left(text, 100) || '...' AS example,
       "true" AS true_label, pred AS pred_label, raw_response FROM r WHERE k <= 5"""
)
def outcome_examples(spark, sf_dir):
    return metrics.outcome_examples(
        _judged(spark, sf_dir), "doc_id", "text", "true", "pred", "raw_response", 10
    )


@query(
    f"""WITH {i.STANCE}
SELECT row_number() OVER (ORDER BY doc_id)::INTEGER AS ordinal, doc_id,
       CASE WHEN "true" = pred THEN '✓' ELSE '✗' END AS mark, "true" AS true_label,
       pred AS pred_label, left(text, 100) || '...' AS example
FROM judged ORDER BY doc_id LIMIT 10"""
)
def prediction_review(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    index = settle(clean.label_index(judged, "true"))
    coded = clean.label_encode(judged, "true", index, "true_code")
    coded = clean.label_encode(coded, "pred", index, "pred_code")
    return metrics.prediction_review(coded, index, "doc_id", "text", "true_code", "pred_code")


# The report of one evaluation, line by line.
REPORT_LINES = f"""WITH {JUDGED_PRF}, bundle AS ({bundle_sql("judged", STANCES, False)}),
report AS ({report_sql("judged")}), lines AS (
SELECT 0 AS b, unnest([1, 2, 3, 4, 5]) AS p,
       unnest(['EVALUATION RESULTS', repeat('=', 50), '', 'Model: rules', 'Device: spark']) AS line
UNION ALL SELECT 1, 0, 'Total samples: ' || count(*) FROM judged
UNION ALL SELECT 2, 0, ''
UNION ALL SELECT 3, CASE metric WHEN 'accuracy' THEN 0 WHEN 'f1_macro' THEN 1 ELSE 2 END,
  CASE metric WHEN 'accuracy' THEN 'Accuracy: ' WHEN 'f1_macro' THEN 'F1 Score (Macro): '
              ELSE 'F1 Score (Weighted): ' END || printf('%.4f', round(value, 4))
  FROM bundle WHERE metric <> 'f1'
UNION ALL SELECT 4, unnest([0, 1]), unnest(['', 'Per-class F1 Scores:'])
UNION ALL SELECT 5, list_position({list(STANCES)}, label),
  '  ' || label || ': ' || printf('%.4f', round(value, 4)) FROM bundle WHERE metric = 'f1'
UNION ALL SELECT 6, unnest([0, 1, 2, 3]), unnest(['', 'Detailed Classification Report:',
  repeat(' ', 19) || ' precision    recall  f1-score   support', ''])
UNION ALL SELECT CASE WHEN block = 0 THEN 7 ELSE 9 END, row_number() OVER (ORDER BY block, label),
  lpad(label, 18, ' ') || ' ' || lpad(coalesce(printf('%.2f', round(precision, 2)), ''), 10, ' ')
  || lpad(coalesce(printf('%.2f', round(recall, 2)), ''), 10, ' ')
  || lpad(printf('%.2f', round(f1, 2)), 10, ' ') || lpad(support::VARCHAR, 10, ' ') FROM report
UNION ALL SELECT 8, 0, '')
SELECT (row_number() OVER (ORDER BY b, p) - 1)::INTEGER AS line_no, line FROM lines"""


@query(REPORT_LINES)
def report_sink(spark, sf_dir):
    lines = reports.evaluation_report(
        _judged_counts(spark, sf_dir), STANCES, "EVALUATION RESULTS", "rules"
    )
    path = scratch_path(spark, "report_sink")
    reports.report_sink(lines, path)
    return reports.report_lines(spark, path).select("line_no", "line")


REST_LINES = ("- Split ratio: 80% train / 20% test", *reports.PREPARATION_REST)


@query(
    f"""WITH {i.SPLIT_PREPARED}, c AS (
  SELECT lang, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct
  FROM prepared GROUP BY lang
), s AS (
  SELECT split, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct
  FROM parted GROUP BY split
), lines AS (
SELECT 0 AS b, unnest([0, 1, 2, 3, 4]) AS p, unnest(['DATASET PREPARATION SUMMARY REPORT',
  repeat('=', 34), '', 'Dataset Information:', '- Original file: documents']) AS line
UNION ALL SELECT 1, unnest([0, 1, 2]), unnest(['- Total samples: ' || sum(n), '- Features: 8',
  '- Classes: ' || count(*)]) FROM c
UNION ALL SELECT 2, unnest([0, 1]), unnest(['', 'Class Distribution:'])
UNION ALL SELECT 3, row_number() OVER (ORDER BY n DESC, lang),
  '- ' || lang || ': ' || n || ' samples (' || printf('%.2f', round(pct, 2)) || '%)' FROM c
UNION ALL SELECT 4, unnest([0, 1]), unnest(['', 'Train/Test Split:'])
UNION ALL SELECT 5, CASE split WHEN 'train' THEN 0 ELSE 1 END,
  '- ' || CASE split WHEN 'train' THEN 'Train' ELSE 'Test' END || ' samples: ' || n || ' ('
  || printf('%.1f', round(pct, 1)) || '%)' FROM s
UNION ALL SELECT 6, unnest(range({len(REST_LINES)})), unnest({list(REST_LINES)}))
SELECT row_number() OVER (ORDER BY b, p)::INTEGER AS line_no, line FROM lines"""
)
def preparation_report(spark, sf_dir):
    from labelloom.operators import profile, split

    parted = split.stratified_split(i.prepared_documents(spark, sf_dir), "doc_id", "lang")
    return reports.preparation_report(
        profile.class_distribution(parted, "lang"),
        split.split_sizes(parted),
        "documents",
        len(parted.columns),
    )


def _run_reports(spark, sf_dir):
    """One report per source of the documents, written and found again on disk."""
    counts = metrics.confusion_counts(_judged(spark, sf_dir), "true", "pred", by=["source"])
    scores = metrics.accuracy(counts, ["source"]).join(metrics.f1_macro(counts, ["source"]), "source")

    def metric(name: str, column: str):
        return F.concat(F.lit(name), F.format_string("%.4f", F.round(column, 4)))

    lines = [
        F.lit("EVALUATION RESULTS"),
        F.lit("Accuracy: 0.0000"),
        metric("F1 Score (Macro): ", "f1_macro"),
        metric("Accuracy: ", "accuracy"),
    ]
    report = scores.select(
        F.col("source").alias("run"), F.posexplode(F.array(*lines)).alias("line_no", "line")
    )
    path = scratch_path(spark, "report_parse")
    reports.report_sink(report, path)
    run = F.regexp_extract("file", "run=([^/]+)", 1)
    return reports.report_parse(reports.report_lines(spark, path).withColumn("run", run), "run")


RUNS = f"""{i.STANCE}, {prf_sql("judged", "run_prf", "source")}, runs AS (
  SELECT source AS run, 'accuracy' AS metric, round(avg(("true" = pred)::INTEGER), 4) AS value
  FROM judged GROUP BY source
  UNION ALL SELECT source, 'f1_macro', round(avg(f1), 4) FROM run_prf GROUP BY source)"""


@query(f"WITH {RUNS} SELECT run, metric, round(value, 6) AS value FROM runs")
def report_parse(spark, sf_dir):
    return rounded(_run_reports(spark, sf_dir), "value")


@query(
    f"""WITH {RUNS}, {prf_sql("judged", "prf")}, bundle AS ({bundle_sql("judged", STANCES, False)})
SELECT run, metric, r.value AS baseline, round(b.value, 6) AS current,
       round(b.value - r.value, 6) AS difference
FROM runs r JOIN bundle b USING (metric)"""
)
def baseline_delta(spark, sf_dir):
    bundle = metrics.metrics_bundle(_judged_counts(spark, sf_dir))
    delta = metrics.baseline_delta(_run_reports(spark, sf_dir), bundle)
    return rounded(delta, "current", "difference")


@query(
    """WITH checks AS (
  SELECT unnest(['rows', 'no null text', 'no short text', 'unique key', 'has text', 'has label_pred']) AS "check",
         unnest([count(*) > 0, count(*) = count(text), min(length(text)) >= 10,
                 count(*) = count(DISTINCT doc_id), true, false]) AS passed FROM documents)
SELECT "check", passed, (SELECT count(*) FILTER (passed) || '/' || count(*) FROM checks) AS tally
FROM checks"""
)
def check_summary(spark, sf_dir):
    rows = i.documents(spark, sf_dir)
    on_table = checks.run_checks(
        rows,
        {
            "rows": F.count("*") > 0,
            "no null text": F.count("*") == F.count("text"),
            "no short text": F.min(F.length("text")) >= 10,
            "unique key": F.count("*") == F.count_distinct("doc_id"),
        },
    )
    present = checks.required_columns(rows, ["text", "label_pred"]).select(
        F.concat(F.lit("has "), "column").alias("check"), F.col("present").alias("passed")
    )
    return checks.check_summary([on_table, present])
