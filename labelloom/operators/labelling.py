"""Labelling whole tables with a pluggable model."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from labelloom.functions.labels import (
    AGAINST_WORDS,
    DEFAULT_STANCE,
    FAVOR_WORDS,
    GATE_WORDS,
    STANCES,
    label_lenient,
)

BATCH_SIZE = 16

# The labelling code travels with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Model(Protocol):
    """Answers a batch of texts with one raw response each."""

    def predict(self, texts: list[str]) -> list[str]: ...


class KeywordModel:
    """The keyword rule as a batch model."""

    def __init__(
        self,
        gate: Sequence[str] = GATE_WORDS,
        against: Sequence[str] = AGAINST_WORDS,
        favor: Sequence[str] = FAVOR_WORDS,
        labels: Sequence[str] = STANCES,
        default: str = DEFAULT_STANCE,
    ):
        self.gate = tuple(gate)
        self.answers = ((tuple(against), labels[1]), (tuple(favor), labels[0]))
        self.default = default

    def answer(self, text: str) -> str:
        low = text.lower()
        if any(word in low for word in self.gate):
            for needles, label in self.answers:
                if any(word in low for word in needles):
                    return label
        return self.default

    def predict(self, texts: list[str]) -> list[str]:
        return [self.answer(text) for text in texts]


def _ask(model: Model, batch: list[str]) -> list[str | None]:
    """The model's answers to a batch, one for each text."""
    answers = list(model.predict(batch))
    if len(answers) != len(batch):
        raise ValueError(f"the model gave {len(answers)} answers to {len(batch)} texts")
    return answers


def _answers(model: Model, texts: list[str | None], size: int, on_error: str) -> Iterable[str | None]:
    """Raw responses batch by batch; with on_error='null' a failing row answers null.

    A batch with too few or too many answers fails as a whole, so none moves to another row.
    """
    for start in range(0, len(texts), size):
        batch = [text or "" for text in texts[start : start + size]]
        try:
            answers = _ask(model, batch)
        except Exception:
            if on_error == "raise":
                raise
            answers = []
            for text in batch:
                try:
                    answers += _ask(model, [text])
                except Exception:
                    answers.append(None)
        yield from answers


def raw_responses(
    df: DataFrame,
    load_model: Callable[[], Model],
    text: str,
    batch_size: int = BATCH_SIZE,
    on_error: str = "raise",
    into: str = "raw_response",
) -> DataFrame:
    """All columns plus the model's answer to `text`.

    Map-only: every task loads the model once and streams its Arrow batches through
    it, `batch_size` texts per call; the other columns never become Python objects.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error is 'raise' or 'null'")

    def label_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            answers = pa.array(list(_answers(model, texts, batch_size, on_error)), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, answers], names=[*batch.schema.names, into]
            )

    schema = T.StructType([*df.schema.fields, T.StructField(into, T.StringType())])
    return df.mapInArrow(label_batches, schema)


def append_predictions(
    df: DataFrame,
    load_model: Callable[[], Model],
    text: str,
    normalise: Callable[[Column], Column] = label_lenient,
    into: str = "label_pred",
    **options,
) -> DataFrame:
    """The input rows with the predicted label."""
    plain = df.drop(into)
    answered = raw_responses(plain, load_model, text, into="__raw", **options)
    return answered.select(*plain.columns, normalise(F.col("__raw")).alias(into))


def batch_label(
    df: DataFrame,
    load_model: Callable[[], Model],
    key: str,
    text: str,
    normalise: Callable[[Column], Column] = label_lenient,
    **options,
) -> DataFrame:
    """Key, predicted label and raw response of every row."""
    answered = raw_responses(df.select(key, text), load_model, text, **options)
    return answered.select(
        key, normalise(F.col("raw_response")).alias("label_pred"), "raw_response"
    )
