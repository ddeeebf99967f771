"""Sequences, labelling, TF-IDF and the classifier on small fixtures."""

import math
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import classifier, features, labelling, sequences

TEXTS = [
    (1, "Good vaccine, good people", "a"),
    (2, "bad bad weather and people", "b"),
    (3, "Weather is good; Vaccine works", "a"),
    (4, "people dislike bad weather", "b"),
    (5, "cloudy sky tonight", "c"),
    (6, "sky and cloudy weather", "c"),
]
NULLS = [(7, None, "a"), (8, "", "b")]
STOP = ("and", "is")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "key long, text string, label string").cache()


def tokens(text):
    return [t for t in re.findall(r"\w\w+", text.lower()) if t not in STOP]


def dense(terms):
    n = len(TEXTS)
    df = Counter(t for _, text, _ in TEXTS for t in set(tokens(text)))
    rows = []
    for _, text, _ in TEXTS:
        count = Counter(tokens(text))
        row = np.array([count[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in terms])
        rows.append(row / np.linalg.norm(row))
    return np.array(rows)


@pytest.mark.parametrize("limit", [100, 1])
def test_tfidf(monkeypatch, texts, limit):
    """The same as vectors and, beyond the limit, by document."""
    monkeypatch.setattr(features, "VECTOR_TERMS", limit)
    terms = features.term_statistics(texts, "text", 100, STOP)
    order = [r.term for r in terms.orderBy("term_index").collect()]
    counts = Counter(t for _, text, _ in TEXTS for t in tokens(text))
    assert order == sorted(counts, key=lambda t: (-counts[t], t))
    got = {(r.key, r.term): r.weight for r in features.tfidf(texts, terms, "key", "text", STOP).collect()}
    for row, (key, text, _) in zip(dense(order), TEXTS):
        for term, weight in zip(order, row):
            assert got.get((key, term), 0.0) == pytest.approx(weight)


def test_classifier_is_at_the_optimum(texts):
    """At the minimum of summed loss + |w|^2 / 2C the gradient vanishes."""
    c = 2.0
    weighted = texts.withColumn("w", F.when(F.col("label") == "c", 3.0).otherwise(1.0))
    fitted = classifier.fit_classifier(weighted, "text", "label", "w", 100, STOP, c=c, tol=1e-10)
    x = dense(fitted.terms)
    names = [r.label for r in fitted.labels.orderBy("encoded_value").collect()]
    y = np.array([[r[2] == name for name in names] for r in TEXTS], dtype=float)
    w = np.array([3.0 if r[2] == "c" else 1.0 for r in TEXTS])[:, None]
    beta = fitted.model.coefficientMatrix.toArray()
    score = x @ beta.T + fitted.model.interceptVector.toArray()
    p = np.exp(score) / np.exp(score).sum(axis=1, keepdims=True)
    assert np.abs((w * (p - y)).T @ x + beta / c).max() < 1e-3
    assert np.abs((w * (p - y)).sum(axis=0)).max() < 1e-3
    got = classifier.predict_classifier(fitted, texts, "text")
    assert got.filter("label <> label_pred").isEmpty()
    assert classifier.coefficients(fitted, texts.sparkSession).count() == 3 * (len(fitted.terms) + 1)


@pytest.mark.parametrize("words", [100, 2])
def test_encode_and_decode(monkeypatch, texts, words):
    """The same with the vocabulary as a constant and, beyond the limit, as a join."""
    monkeypatch.setattr(sequences, "DICTIONARY_WORDS", words)
    vocab = sequences.vocabulary(texts, "text", 6)
    ids = {r.token: r.id for r in vocab.collect()}
    assert sorted(ids.values()) == [3, 4, 5, 6, 7, 8]
    encoded = sequences.encode_sequence(texts, vocab, "key", "text", "label", 5, 3).cache()
    for row, (_, text, _) in zip(encoded.orderBy("key").collect(), TEXTS):
        known = [ids.get(t, 2) for t in re.findall(r"\w+", text.lower())][:4] + [1]
        assert row.input_ids == known + [0] * (5 - len(known))
        assert row.labels == [2, 1, 0]
    decoded = sequences.decode_sequence(encoded, vocab, "key", "input_ids").orderBy("key")
    for row, (_, text, _) in zip(decoded.collect(), TEXTS):
        assert row.text == " ".join(t for t in re.findall(r"\w+", text.lower())[:4] if t in ids)


def test_very_long_words(spark):
    long_words = ["x" * 3000, "x" * 3000 + "y"]
    rows = spark.createDataFrame(
        [(0, f"{long_words[0]} ab", "a"), (1, f"{long_words[1]} cd", "b"), (2, "", "a")],
        "key long, text string, label string",
    )
    vocab = sequences.vocabulary(rows, "text", 10)
    ids = {r.token: r.id for r in vocab.collect()}
    assert len(set(ids.values())) == 4
    encoded = sequences.truncate_sequence(rows, vocab, "key", "text", 10)
    got = {r.key: r.input_ids for r in encoded.collect()}
    assert got == {0: [ids[long_words[0]], ids["ab"], 1], 1: [ids[long_words[1]], ids["cd"], 1], 2: [1]}
    decoded = sequences.decode_sequence(encoded, vocab, "key", "input_ids")
    assert {r.key: r.text for r in decoded.collect()} == {r.key: r.text for r in rows.collect()}
    terms = features.term_statistics(rows, "text", 10, ())
    weights = features.tfidf(rows, terms, "key", "text", ()).collect()
    assert {(r.key, r.term) for r in weights} == {
        (0, long_words[0]), (0, "ab"), (1, long_words[1]), (1, "cd"),
    }
    fitted = classifier.fit_classifier(rows, "text", "label", None, 10, ())
    listed = classifier.coefficients(fitted, spark).select("term").distinct().collect()
    assert {r.term for r in listed} == {"", *long_words, "ab", "cd"}
    got = classifier.predict_classifier(fitted, rows, "text").filter("key < 2")
    assert got.filter("label <> label_pred").isEmpty()


@pytest.mark.parametrize("limit", [100, 1])
def test_null_texts(spark, monkeypatch, limit):
    """One result on both paths: no terms, null ids, null text."""
    monkeypatch.setattr(features, "VECTOR_TERMS", limit)
    monkeypatch.setattr(sequences, "DICTIONARY_WORDS", limit)
    rows = spark.createDataFrame(TEXTS + NULLS, "key long, text string, label string")
    terms = features.term_statistics(rows, "text", 50, STOP)
    weights = features.tfidf(rows, terms, "key", "text", STOP)
    assert {r.key for r in weights.collect()} == set(range(1, 7))
    vocab = sequences.vocabulary(rows, "text", 50)
    cut = sequences.truncate_sequence(rows, vocab, "key", "text", 6)
    ids = {r.key: r.input_ids for r in cut.collect()}
    assert ids[7] is None and ids[8] == [1] and ids[5][-1] == 1
    encoded = sequences.encode_sequence(rows, vocab, "key", "text", "label", 6, 3)
    assert {r.key: r.input_ids for r in encoded.collect()}[7] is None
    decoded = {r.key: r.text for r in sequences.decode_sequence(cut, vocab, "key", "input_ids").collect()}
    assert decoded[7] is None and decoded[8] == "" and decoded[5] == "cloudy sky tonight"


def test_classifier_takes_null_texts_and_labels(spark):
    rows = spark.createDataFrame([*TEXTS, *NULLS, (9, "sky", None)], "key long, text string, label string")
    fitted = classifier.fit_classifier(rows, "text", "label", None, 100, STOP)
    assert classifier.predict_classifier(fitted, rows, "text").count() == 9
    found = classifier.gradients(fitted, rows, "text", "label")
    assert {r.label: r.gradient_ok for r in found.collect()} == {"a": True, "b": True, "c": True}
    cut = classifier.fit_classifier(rows, "text", "label", None, 100, STOP, max_iter=1)
    assert not classifier.gradients(cut, rows, "text", "label").filter("gradient_ok").count() == 3


def test_tfidf_lists_only_terms_that_occur(texts):
    """The rows after the explode are the non-zero terms, not documents times vocabulary."""
    terms = features.term_statistics(texts, "text", 100, STOP)
    listed = features.tfidf(texts, terms, "key", "text", STOP)
    assert "Filter (__cell" not in listed._jdf.queryExecution().executedPlan().toString()
    assert listed.count() == sum(len(set(tokens(t))) for _, t, _ in TEXTS)


def fragile():
    """A model that fails on any batch with the word `bad`."""

    class Fragile:
        def predict(self, texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("bad text")
            return ["In-Favor, surely" for _ in texts]

    return Fragile


def test_labelling_keeps_columns_and_survives_errors(texts):
    got = labelling.append_predictions(texts, fragile(), "text", batch_size=4, on_error="null")
    assert got.columns == ["key", "text", "label", "label_pred"]
    raw = labelling.batch_label(texts, fragile(), "key", "text", batch_size=4, on_error="null")
    answers = {r.key: (r.label_pred, r.raw_response) for r in raw.collect()}
    assert answers[1] == ("in-favor", "In-Favor, surely")
    assert answers[2] == ("neutral-or-unclear", None)
    with pytest.raises(Exception, match="bad text"):
        labelling.batch_label(texts, fragile(), "key", "text").collect()


def test_keyword_model_equals_the_expression(spark):
    from labelloom.functions.labels import keyword_label

    rows = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["I refuse the vaccine", "Vaccine is SAFE", "vaccine", "safe"])],
        "key long, text string",
    )
    by_model = labelling.batch_label(rows, labelling.KeywordModel, "key", "text")
    by_rule = rows.select("key", keyword_label(F.col("text")).alias("label_pred"))
    assert by_model.select("key", "label_pred").exceptAll(by_rule).isEmpty()


def miscounting():
    """A model with one answer too few for two texts and one too many for one."""

    class Miscounts:
        def predict(self, texts):
            return ["a"] if len(texts) == 2 else ["b", "c"]

    return Miscounts


def midway():
    """A model that fails in the middle of a batch, after the first answer."""

    class Midway:
        def predict(self, texts):
            for text in texts:
                if "bad" in text:
                    raise RuntimeError("bad text")
                yield text

    return Midway


@pytest.mark.parametrize("size", [1, 2])
def test_miscounted_answers_never_move(texts, size):
    rows = texts.coalesce(1)
    with pytest.raises(Exception, match="answers to"):
        labelling.batch_label(rows, miscounting(), "key", "text", batch_size=size).collect()
    got = labelling.batch_label(rows, miscounting(), "key", "text", batch_size=size, on_error="null")
    assert {r.raw_response for r in got.collect()} == {None}


def test_failure_midway_keeps_answers_in_place(texts):
    got = labelling.batch_label(
        texts.coalesce(1), midway(), "key", "text", batch_size=3, on_error="null"
    ).collect()
    known = {key: text for key, text, _ in TEXTS}
    assert {r.key: r.raw_response for r in got} == {
        key: None if "bad" in text else text for key, text in known.items()
    }


def test_prompt_words_cannot_decide_a_label(spark):
    from labelloom.operators.evaluation import score_labeller

    texts = {1: "vaccine is safe", 2: "the weather today", 3: "get vaccinated, it is important"}
    rows = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "key long, text string, label string")
    scored = score_labeller(rows, labelling.KeywordModel, "key", "text", "label")
    model = labelling.KeywordModel()
    assert {r.key: r.raw_response for r in scored.collect()} == {k: model.answer(t) for k, t in texts.items()}


def test_sampled_scores_keep_their_text(texts):
    from labelloom.operators.evaluation import score_labeller

    scored = score_labeller(texts, labelling.KeywordModel, "key", "text", "label", sample_size=3)
    rows = scored.collect()
    known = {key: (text, label) for key, text, label in TEXTS}
    assert len(rows) == 3 and all(known[r.key] == (r.text, r.label) for r in rows)


def test_predictions_have_the_largest_score(spark, texts):
    """Also for texts without terms; a model whose labels are swapped is found out."""
    more = texts.unionByName(spark.createDataFrame(NULLS, "key long, text string, label string"))
    fitted = classifier.fit_classifier(texts, "text", "label", max_features=100, stop_words=STOP)
    statistics = features.term_statistics(texts, "text", 100, STOP)
    got = classifier.agreement(fitted, more, "key", "text", statistics).collect()
    assert {r.key for r in got} == {1, 2, 3, 4, 5, 6, 7, 8} and all(r.agreed for r in got)
    codes = {"a": 1, "b": 2, "c": 0}
    names = spark.createDataFrame(list(codes.items()), "label string, encoded_value int")
    swapped = replace(fitted, labels=names)
    wrong = classifier.predict_classifier(swapped, texts, "text").filter("label <> label_pred")
    assert wrong.count() > 0
