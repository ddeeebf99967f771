"""The most frequent terms without shuffling all terms: bounded summaries, then exact counts."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from labelloom.plans.scratch import written

SUMMARY = 200_000  # terms that one task sends at most

# The summaries travel with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def summaries(capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task at most `capacity` terms with lower bounds of their counts, and what was lost.

    When a task holds twice as many, the count of the first that must go is taken from
    all, and those without a rest are dropped: no term of the task has lost more than the
    sum of what was taken. That sum is the row without a term.
    """

    def shrink(counts: dict[str, int]) -> tuple[dict[str, int], int]:
        cut = sorted(counts.values(), reverse=True)[capacity]
        return {term: n - cut for term, n in counts.items() if n > cut}, cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        lost = 0
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for term, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                counts[term] = counts.get(term, 0) + n
            if len(counts) > 2 * capacity:
                counts, cut = shrink(counts)
                lost += cut
        if len(counts) > capacity:
            counts, cut = shrink(counts)
            lost += cut
        columns = [pa.array([*counts, None], pa.string()), pa.array([*counts.values(), lost], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    return run


@dataclass(frozen=True)
class Candidates:
    """`terms` (`term, n`) among which the most frequent are; their counts are exact or lower bounds."""

    terms: DataFrame
    exact: bool


def frequent_candidates(terms: DataFrame, size: int, capacity: int = SUMMARY) -> Candidates | None:
    """Terms that hold the `size` most frequent ones, or None where the summaries can't tell.

    `terms` has one row per occurrence. What is shuffled is at most `capacity` terms per task,
    however many there are. A term that no summary holds occurs at most as often as all tasks
    together have lost; where the `size`-th largest lower bound is above that, it is not among the wanted. Terms
    whose upper bound reaches that `size`-th bound are the candidates.
    """
    column = terms.columns[0]
    plain = terms.select(F.col(column).alias("term")).filter(F.col("term").isNotNull())
    sent = written(plain.mapInArrow(summaries(capacity), "term string, n long"), "term-summaries")
    lost = sent.filter("term IS NULL").agg(F.sum("n")).first()[0] or 0
    sums = sent.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n"))
    if not lost:
        return Candidates(sums, True)
    held = written(sums, "term-bounds")
    top = held.select("n").orderBy(F.desc("n")).limit(size).agg(F.min("n").alias("least"), F.count("*").alias("k"))
    bound = top.first()
    if bound["k"] < size or bound["least"] <= lost:
        return None
    return Candidates(held.filter(F.col("n") + lost >= bound["least"]), False)
