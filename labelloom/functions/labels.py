"""Free-text answers and texts to labels, as ordered rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from labelloom.functions.text import strip_unicode

# The stance labels, in order of precedence, and the fall-back.
STANCES = ("in-favor", "against", "neutral-or-unclear")
DEFAULT_STANCE = "neutral-or-unclear"

# Word pieces tried, in order, when no full label occurs in an answer.
PARTIAL_STANCES = (
    ("favor", "in-favor"),
    ("neutral", "neutral-or-unclear"),
    ("unclear", "neutral-or-unclear"),
)

# Word lists of the keyword rule.
GATE_WORDS = ("vaccine", "vaccinated", "get vaccinated", "covid vaccine")
AGAINST_WORDS = ("against", "refuse", "won't", "don't want")
FAVOR_WORDS = ("get", "got", "should", "important", "safe")


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """True where the text holds at least one of the needles as a plain substring."""
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose needle occurs in the text."""
    matches = [F.when(text.contains(needle), F.lit(label)) for needle, label in rules]
    return F.coalesce(*matches, F.lit(default))


def label_lenient(
    answer: Column,
    labels: Sequence[str] = STANCES,
    partial: Sequence[tuple[str, str]] = PARTIAL_STANCES,
    default: str = DEFAULT_STANCE,
) -> Column:
    """First listed label inside the answer, else the first word piece, else the default."""
    rules = [(label.lower(), label) for label in labels] + list(partial)
    return first_match(F.lower(answer), rules, default)


def label_substring(
    answer: Column, labels: Sequence[str] = STANCES, default: str = DEFAULT_STANCE
) -> Column:
    """First listed label inside the answer, else the default."""
    return label_lenient(answer, labels, (), default)


def label_strict(
    answer: Column, labels: Sequence[str] = STANCES, default: str = DEFAULT_STANCE
) -> Column:
    """The stripped answer where it equals a label to the letter, else the default."""
    bare = strip_unicode(answer)
    return F.when(bare.isin(*labels), bare).otherwise(F.lit(default))


def keyword_label(
    text: Column,
    gate: Sequence[str] = GATE_WORDS,
    against: Sequence[str] = AGAINST_WORDS,
    favor: Sequence[str] = FAVOR_WORDS,
    labels: Sequence[str] = STANCES,
    default: str = DEFAULT_STANCE,
) -> Column:
    """Rule labeller: outside the gate the default, inside it against words before favor words."""
    low = F.lower(text)
    favor_label, against_label = labels[0], labels[1]
    gated = contains_any(low, gate)
    return (
        F.when(~gated, F.lit(default))
        .when(contains_any(low, against), F.lit(against_label))
        .when(contains_any(low, favor), F.lit(favor_label))
        .otherwise(F.lit(default))
    )
