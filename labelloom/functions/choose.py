"""Ordered rules as one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def choose(rules: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first rule whose condition holds."""
    (condition, value), *rest = rules
    case = F.when(condition, value)
    for condition, value in rest:
        case = case.when(condition, value)
    return case.otherwise(otherwise)
