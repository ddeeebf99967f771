"""Multinomial logistic regression over TF-IDF vectors."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from labelloom.functions.text import STOP_WORDS, word_key
from labelloom.operators.clean import label_decode, label_encode, label_index
from labelloom.operators.features import term_statistics, tfidf, tfidf_vectors, with_tokens
from labelloom.plans.lookup import literal_table, lookup_join, pull_small, settle
from labelloom.plans.scratch import written


DIGEST_LENGTH = 33
ROWS_PER_TASK = 4_000  # of the trainer: some milliseconds of work a step


@dataclass
class TextClassifier:
    """A fitted model with the terms and labels it was fitted on."""

    terms: list[str]  # very long ones as digests
    words: DataFrame  # the word of each term
    labels: DataFrame
    vectors: PipelineModel
    model: LogisticRegressionModel
    stop_words: Sequence[str]

    def features(self, df: DataFrame, text: str) -> DataFrame:
        return self.vectors.transform(with_tokens(df, text, self.stop_words))


def fit_classifier(
    train: DataFrame,
    text: str,
    label: str,
    weight: str | None = None,
    max_features: int = 5_000,
    stop_words: Sequence[str] = STOP_WORDS,
    c: float = 1.0,
    max_iter: int = 1_000,
    tol: float = 1e-6,
) -> TextClassifier:
    """Fit with an L2 penalty of strength 1/c on the summed loss, intercepts free."""
    statistics = term_statistics(train, text, max_features, stop_words)
    # A model's terms and weights live on the driver: `max_features` short keys.
    terms = pull_small(
        statistics.select(word_key(F.col("term")).alias("term"), "term_index", "idf"), max_features
    ).sort_by("term_index")
    vectors = tfidf_vectors(terms.column("term").to_pylist(), terms.column("idf").to_pylist())
    labels = settle(label_index(train, label))
    vectorised = vectors.transform(with_tokens(train, text, stop_words))
    coded = label_encode(vectorised, label, labels, "__code")
    columns = [F.col("__code").cast("double").alias("__code"), "features"]
    if weight is not None:
        columns.append(F.col(weight).cast("double").alias("__weight"))
    # The summed loss weighs every row by its weight, as the penalty has to. Unlabelled rows
    # have no code and take no part.
    weighed = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    total = train.filter(F.col(label).isNotNull()).agg(F.sum(weighed)).first()[0]
    learner = LogisticRegression(
        family="multinomial",
        labelCol="__code",
        featuresCol="features",
        maxIter=max_iter,
        regParam=1.0 / (c * total),
        elasticNetParam=0.0,
        standardization=False,
        tol=tol,
    )
    if weight is not None:
        learner = learner.setWeightCol("__weight")
    # The texts are turned into vectors once, by all tasks; the trainer, which runs a job per step,
    # then reads the vectors in tasks that are worth their overhead and keeps them in blocks.
    points = written(coded.select(*columns).filter("__code IS NOT NULL"), "training-vectors")
    tasks = max(math.ceil(points.count() / ROWS_PER_TASK), 1)
    model = learner.fit(points.coalesce(tasks))
    names = terms.column("term").to_pylist()
    words = statistics.select(word_key(F.col("term")).alias("term"), F.col("term").alias("word"))
    return TextClassifier(names, words, labels, vectors, model, stop_words)


def gradients(
    fitted: TextClassifier, df: DataFrame, text: str, label: str, weight: str | None = None,
    c: float = 1.0, tolerance: float = 1e-3,
) -> DataFrame:
    """Per label, the largest partial derivative of the mean objective at the fitted weights.

    The objective is strictly convex but for the intercepts, so the fit is the optimum where all
    vanish: `label, largest, gradient_ok`. It is computed from the data alone, as sums over rows.
    """
    beta = fitted.model.coefficientMatrix.toArray()
    rows = fitted.features(df, text)
    coded = label_encode(rows, label, fitted.labels, "__code").filter("__code IS NOT NULL")
    scored = fitted.model.transform(coded)
    weighed = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    parts = F.unwrap_udt("features")
    miss = F.get(vector_to_array("probability"), F.col("k")) - (F.col("__code") == F.col("k")).cast("int")
    per_label = scored.select(
        weighed.alias("w"), "probability", "__code", parts.alias("x"),
        F.explode(F.sequence(F.lit(0), F.lit(len(beta) - 1))).alias("k"),
    ).select("k", (miss * F.col("w")).alias("miss"), "x")
    # An intercept is a weight of a feature that is always one, without a penalty.
    cells = F.concat(
        F.transform(
            F.arrays_zip("x.indices", "x.values"),
            lambda cell: F.struct(cell["indices"].alias("i"), cell["values"].alias("v")),
        ),
        F.array(F.struct(F.lit(-1).alias("i"), F.lit(1.0).alias("v"))),
    )
    sums = (
        per_label.select("k", "miss", F.inline(cells))
        .groupBy("k", "i")
        .agg(F.sum(F.col("miss") * F.col("v")).alias("loss"))
    )
    weights = F.from_json(F.lit(json.dumps(beta.tolist())), "array<array<double>>")
    penalty = F.when(F.col("i") >= 0, F.get(F.get(weights, F.col("k")), F.col("i")) / c).otherwise(0.0)
    total = coded.agg(F.sum(weighed)).scalar()
    largest = sums.groupBy("k").agg(F.max(F.abs(F.col("loss") + penalty)).alias("sum"))
    largest = largest.select("k", (F.col("sum") / total).alias("largest"))
    named = label_decode(largest, "k", fitted.labels)
    return named.select("label", "largest", (F.col("largest") < tolerance).alias("gradient_ok"))


def coefficients(fitted: TextClassifier, spark) -> DataFrame:
    """The model as a table: one weight per label and term; the empty term is the intercept."""
    matrix = fitted.model.coefficientMatrix.toArray()
    intercepts = fitted.model.interceptVector.toArray()
    rows = [
        (code, term, float(value))
        for code in range(matrix.shape[0])
        for term, value in zip(["", *fitted.terms], [intercepts[code], *matrix[code]])
    ]
    table = literal_table(spark, rows, "encoded_value int, term string, coefficient double")
    if any(len(term) == DIGEST_LENGTH and term.startswith("#") for term in fitted.terms):
        table = table.join(fitted.words, "term", "left").select(
            "encoded_value", F.coalesce("word", "term").alias("term"), "coefficient"
        )
    return label_decode(table, "encoded_value", fitted.labels).select(
        "label", "term", "coefficient"
    )


def predict_classifier(
    fitted: TextClassifier, df: DataFrame, text: str, into: str = "label_pred"
) -> DataFrame:
    """The input rows with the predicted label."""
    scored = fitted.model.transform(fitted.features(df, text))
    coded = scored.select(*df.columns, F.col("prediction").cast("int").alias("__code"))
    return label_decode(coded, "__code", fitted.labels, into).select(*df.columns, into)


def agreement(
    fitted: TextClassifier, df: DataFrame, key: str, text: str, statistics: DataFrame, tolerance: float = 1e-6
) -> DataFrame:
    """Per row, whether the predicted label has the largest score: `key, agreed`.

    The scores are sums of term weights times the model's coefficients, joined in long form, so they owe
    nothing to the vectors that the model reads. Scores closer than `tolerance` count as equal.
    """
    weights = coefficients(fitted, df.sparkSession)
    own = tfidf(df, statistics, key, text, fitted.stop_words).select(key, "term", "weight")
    constant = df.select(key, F.lit("").alias("term"), F.lit(1.0).alias("weight"))
    by_term = weights.groupBy("term").agg(F.collect_list(F.struct("label", "coefficient")).alias("labels"))
    parts = lookup_join(own.unionByName(constant), by_term, "term").select(key, "weight", F.inline("labels"))
    scores = parts.groupBy(key, "label").agg(F.sum(F.col("weight") * F.col("coefficient")).alias("score"))
    predicted = predict_classifier(fitted, df, text, "__predicted").select(key, "__predicted")
    mine = F.max(F.when(F.col("label") == F.col("__predicted"), F.col("score")))
    judged = scores.join(predicted, key).groupBy(key).agg((mine >= F.max("score") - tolerance).alias("agreed"))
    return judged.select(key, F.coalesce("agreed", F.lit(False)).alias("agreed"))
