"""Scoring a labeller on labelled rows: prompt, answer, label."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from labelloom.functions.labels import label_lenient
from labelloom.functions.prompts import render_prompt
from labelloom.operators.labelling import Model, raw_responses
from labelloom.operators.split import sample_n


def score_labeller(
    df: DataFrame,
    load_model: Callable[[], Model],
    key: str,
    text: str,
    true: str,
    template: str | None = None,
    normalise: Callable[[Column], Column] = label_lenient,
    sample_size: int | None = None,
    seed: int | str = 42,
    **options,
) -> DataFrame:
    """Key, text, true label, predicted label and raw response of every (sampled) row.

    The model gets the text, or the prompt of a `template`; a keyword rule would find its
    words in the prompt. The text stays with its row, so examples drawn from a sample show the right text.
    """
    rows = df.select(key, text, true)
    if sample_size is not None:
        rows = sample_n(rows, key, sample_size, seed)
    asked = text
    if template is not None:
        asked = "__prompt"
        rows = rows.withColumn(asked, render_prompt(F.col(text), template))
    answered = raw_responses(rows, load_model, asked, **options)
    return answered.select(
        key, text, true, normalise(F.col("raw_response")).alias("label_pred"), "raw_response"
    )
