"""Column expressions on literal rows."""

import pytest
from pyspark.sql import functions as F

from labelloom.functions import labels, prompts, sequences, text

ANSWERS = [
    ("in-favor", "in-favor", "in-favor", "in-favor"),
    ("  against ", "against", "against", "against"),
    ("In-Favor", "in-favor", "in-favor", "neutral-or-unclear"),
    ("against, not in-favor", "in-favor", "in-favor", "neutral-or-unclear"),
    ("neutral-or-unclear against", "against", "against", "neutral-or-unclear"),
    ("favor", "in-favor", "neutral-or-unclear", "neutral-or-unclear"),
    ("neutral favor", "in-favor", "neutral-or-unclear", "neutral-or-unclear"),
    ("unclear", "neutral-or-unclear", "neutral-or-unclear", "neutral-or-unclear"),
    ("", "neutral-or-unclear", "neutral-or-unclear", "neutral-or-unclear"),
]


def test_answer_rules(spark):
    rows = spark.createDataFrame(ANSWERS, "answer string, a string, b string, c string")
    got = rows.select(
        "answer",
        labels.label_lenient(F.col("answer")),
        labels.label_substring(F.col("answer")),
        labels.label_strict(F.col("answer")),
    )
    assert [tuple(r) for r in got.collect()] == ANSWERS


def test_keyword_rule(spark):
    cases = {
        "I refuse the vaccine": "against",
        "the vaccine is unsafe": "in-favor",
        "vaccine news today": "neutral-or-unclear",
        "you should go": "neutral-or-unclear",
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    got = rows.select("t", labels.keyword_label(F.col("t")).alias("label")).collect()
    assert {r.t: r.label for r in got} == cases


def test_strip_equals_python(spark):
    samples = [f"{chr(c)}a b{chr(c)}" for c in range(0x3001) if chr(c).isspace()]
    samples += ["​ab​", "\t\n", "", " 　x"]
    rows = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in rows.select(text.strip_unicode(F.col("t"))).collect()]
    assert got == [s.strip() for s in samples]


def test_prompt_leaves_braces_in_the_text_alone(spark):
    row = spark.createDataFrame([("a {tweet} {x}",)], "t string")
    got = row.select(prompts.render_prompt(F.col("t"), "<{tweet}>")).first()[0]
    assert got == "<a {tweet} {x}>"
    with pytest.raises(ValueError):
        prompts.render_prompt(F.col("t"), "no slot")


def test_pad_truncate_and_mask(spark):
    row = spark.createDataFrame([([5, -100, 7],)], "ids array<int>")
    got = row.select(
        sequences.pad(F.col("ids"), F.lit(5)),
        sequences.pad(F.col("ids"), F.lit(2)),
        sequences.truncate(F.col("ids"), 2),
        sequences.restore_mask(F.col("ids")),
    ).first()
    assert list(got) == [[5, -100, 7, 0, 0], [5, -100, 7], [5, -100], [5, 0, 7]]


def test_fixed_point(spark):
    row = spark.createDataFrame([(0.5, None)], "a double, b double")
    got = row.select(text.fixed_point(F.col("a"), 2), text.fixed_point(F.col("b"), 2)).first()
    assert tuple(got) == ("0.50", None)


def test_stop_words_are_the_library_s(spark):
    from pyspark.ml.feature import StopWordsRemover

    from labelloom.functions.text import STOP_WORDS

    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
