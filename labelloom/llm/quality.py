"""Quality by co-training: a view of the text and a view of the metadata that teach each other."""

from __future__ import annotations

import json
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.llm.common import bound_batches, stored, table, whole
from labelloom.llm.registry import query

GRAMS = 1 << 15  # hash buckets of the words; words that share one share its weight
ESCAPE = 255  # a byte of a packed step that goes on in the next one
BINS = 16  # values of a measure: zero, and ranges cut at quantiles over all documents
GRID = 16  # cells per doubling of a measure
OCTAVES = 32  # doublings below and above one that are told apart
SOURCES = 4096  # hash buckets of the source; sources that share one share its weight
LANGUAGES = 64
ROUNDS = 3
CONFIDENT = 0.95  # a view labels what it is this sure of, for the other view
FOLDS = 5  # labelled rows of one fold calibrate, the others train
THRESHOLD = 0.5
SMOOTHING = 1.0  # rows that every value counts for besides its own
WORD_SMOOTHING = 100.0  # the same for buckets of words: those seen in fewer rows say little
STEPS_PER_LOGIT, LOGIT_LIMIT = 10, 40.0

MEASURES = (
    "symbols bars shouts capital_words line_ends word_length distinct_words distinct_phrases "
    "distinct_lines"
).split()


# Characters of the first shares, in the order of MEASURES.
SHARES = (
    b"*#$%&@^~_=+<>\\/{}[]",
    b"|",
    b"!",
)


class Buckets(dict):
    """The hash bucket of each word of a batch."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word) % GRAMS
        return value


def cell(value: float) -> int:
    """The place of a measure on a grid of GRID cells per doubling, exactly; 0 for zero."""
    if value <= 0:
        return 0
    part, octave = math.frexp(value)
    at = (octave + OCTAVES) * GRID + int((part - 0.5) * 2 * GRID)
    return min(max(at, 1), 2 * OCTAVES * GRID)


def measured(text: str, buckets: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """What the text view sees of a whole text.

    First the grid cells of what MEASURES names, then the buckets of its words, each once.
    """
    raw = text.encode()
    size = max(len(text), 1)
    shares = [(len(raw) - len(raw.translate(None, chars))) / size for chars in SHARES]
    words, lines = raw.split(), raw.split(b"\n")
    count, distinct = max(len(words), 1), set(words)
    phrases = list(zip(words, words[1:], words[2:]))
    numbers = [
        *shares,
        sum(w.isupper() and len(w) > 1 for w in words) / count,
        (len(lines) - 1) / count,
        size / count,
        len(distinct) / count,
        len(set(phrases)) / max(len(phrases), 1) if phrases else 1.0,
        len(set(lines)) / len(lines),
    ]
    return [cell(n) for n in numbers], sorted({buckets[w] for w in distinct})


def packed(numbers: list[int]) -> bytes:
    """Ascending numbers as the steps between them, a step as ESCAPE bytes and its rest.

    Words of a text are many and their steps small, so most take one byte.
    """
    whole_steps, rest = np.divmod(np.diff(np.array(numbers, dtype=np.int64), prepend=0), ESCAPE)
    ends = np.cumsum(whole_steps + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, ESCAPE, dtype=np.uint8)
    out[ends - 1] = rest
    return out.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, dtype=np.uint8)
    return steps.cumsum(dtype=np.int64)[steps != ESCAPE]


def content(text: str) -> Column:
    """`measured` by Arrow batches; a null text counts as empty."""

    @F.pandas_udf("struct<cells array<int>, grams binary>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            buckets = Buckets()  # as many as a batch has words
            seen = [measured(value, buckets) for value in batch]
            grams = [packed(g) for _, g in seen]
            yield pd.DataFrame({"cells": [c for c, _ in seen], "grams": grams})

    return run(whole(text))


def metadata(docs: DataFrame, source: str, lang: str) -> Column:
    """What the metadata view sees, as numbers of categories: the source and the language.

    Nothing of the text, not even its length, so that the views are apart. Values are hashed to
    SOURCES and LANGUAGES buckets, whose values share a weight. A missing column counts as null,
    and null is a category of its own.
    """

    def bucket(column: str, buckets: int) -> Column:
        value = F.col(column).cast("string") if column in docs.columns else F.lit(None).cast("string")
        return F.when(value.isNull(), buckets).otherwise(F.pmod(F.xxhash64(value), F.lit(buckets)))

    return F.array(
        bucket(source, SOURCES).cast("int"), (bucket(lang, LANGUAGES) + (SOURCES + 1)).cast("int")
    )


METADATA_VALUES = SOURCES + 1 + LANGUAGES + 1
FEATURES = ("__measures", "__grams", "__meta")


def featured(
    docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang"
) -> DataFrame:
    """The rows with the columns of FEATURES."""
    bound_batches(docs.sparkSession)
    seen = docs.withColumns({"__seen": content(text), "__meta": metadata(docs, source, lang)})
    return seen.withColumns(
        {"__measures": F.col("__seen.cells"), "__grams": F.col("__seen.grams")}
    ).drop("__seen")


@dataclass(frozen=True)
class View:
    """Naive Bayes log-odds by feature value, and the line that calibrates their sum.

    `words` weighs the buckets of a text's words. Their sum is divided by the root of their number,
    since words of one text are far from independent.
    """

    weights: list[float]
    prior: float
    slope: float = 1.0
    offset: float = 0.0
    words: tuple[float, ...] = ()

    def raw(self, values: Column) -> Column:
        table = F.from_json(F.lit(json.dumps(self.weights)), "array<double>")
        total = F.aggregate(values, F.lit(self.prior), lambda s, v: s + F.get(table, v))
        return total + damped(self.words)("__grams") if self.words else total

    def logit(self, values: Column) -> Column:
        return self.raw(values) * self.slope + self.offset


def damped(weights: tuple[float, ...]):
    """The weights of a row's buckets, summed and divided by the root of their number."""
    known = np.array(weights)

    @F.pandas_udf("double")
    def run(rows: pd.Series) -> pd.Series:
        found = (known[unpacked(r)] for r in rows)
        return pd.Series([f.sum() / math.sqrt(max(len(f), 1)) for f in found], dtype=float)

    return run


@dataclass(frozen=True)
class CoTrained:
    """Two calibrated views; together they score any document, without a join."""

    edges: list[list[int]]
    text: View
    meta: View
    prior: float

    def bins(self) -> Column:
        return binned(self.edges)

    def score(self, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """Featured rows with `p_text, p_meta, score, keep` in place of the features."""
        text, meta = self.text.logit(self.bins()), self.meta.logit(F.col("__meta"))
        new = [*FEATURES, "__t", "__m", "p_text", "p_meta", "score", "keep"]
        kept = [c for c in rows.columns if c not in new]
        logits = rows.select(*kept, text.alias("__t"), meta.alias("__m"))

        def chance(logit: Column) -> Column:
            return 1 / (1 + F.exp(-logit))

        both = F.col("__t") + F.col("__m") - self.prior
        return logits.select(
            *kept, chance(F.col("__t")).alias("p_text"), chance(F.col("__m")).alias("p_meta"),
            chance(both).alias("score"), (chance(both) >= threshold).alias("keep"),
        )


def binned(edges: list[list[int]]) -> Column:
    """The measures as numbers of values: measure times BINS plus the edges below it."""
    table = F.from_json(F.lit(json.dumps(edges)), "array<array<int>>")

    def value(measure: Column, i: Column) -> Column:
        below = F.filter(F.get(table, i), lambda cut: cut < measure)
        return i * BINS + F.size(below)

    return F.transform("__measures", value)


def log_odds(
    counts: dict[int, tuple[int, int]], values: range, good: int, bad: int, smoothing: float = SMOOTHING
) -> list[float]:
    """Naive Bayes weights of the values from their counts among `good` and `bad` rows, both above zero.

    Counts are smoothed towards the classes' shares, so a value that no row has says nothing.
    """
    share = good / (good + bad)
    weights = []
    for v in values:
        g, b = counts.get(v, (0, 0))
        weights.append(
            math.log((g + smoothing * share) / good) - math.log((b + smoothing * (1 - share)) / bad)
        )
    return weights


def calibrated(view: View, scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> View:
    """The view with slope and offset of the logistic fit to held-out scores (Newton steps).

    `scores` is a histogram of at most 2 * STEPS_PER_LOGIT * LOGIT_LIMIT values. Targets are smoothed,
    so the slope stays finite where the classes are apart.
    """
    total_good, total_bad = good.sum(), bad.sum()
    if not (total_good and total_bad):
        return view
    high, low = (total_good + 1) / (total_good + 2), 1 / (total_bad + 2)
    weight, target = good + bad, (good * high + bad * low) / (good + bad)
    slope, offset = 0.0, math.log((total_good + 1) / (total_bad + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * scores + offset, -500, 500)))
        miss, curve = weight * (target - p), weight * p * (1 - p)
        a, b, c = (curve * scores * scores).sum() + 1e-9, (curve * scores).sum(), curve.sum() + 1e-9
        g, h = (miss * scores).sum(), miss.sum()
        det = a * c - b * b
        step = ((c * g - b * h) / det, (a * h - b * g) / det)
        size = max(abs(step[0]), abs(step[1]), 1.0)
        slope, offset = slope + step[0] / size, offset + step[1] / size
        if max(map(abs, step)) < 1e-9:
            break
    # A view that is worse than chance says nothing.
    if slope < 0:
        slope, offset = 0.0, math.log((total_good + 1) / (total_bad + 1))
    return replace(view, slope=float(slope), offset=float(offset))


def by_value(counts: DataFrame) -> dict[int, tuple[int, int]]:
    """Good and bad rows per value, from `value, good, n`: as many as there are values."""
    return {r["value"]: (r["good"], r["n"] - r["good"]) for r in counts.collect()}


def measure_edges(features: DataFrame) -> list[list[int]]:
    """At most BINS - 1 edges per measure: zero, and quantiles of the cells above it.

    They come from counts per cell of the grid, so they are the same on any partitioning.
    """
    cells = features.select(F.posexplode("__measures").alias("i", "cell")).filter("cell > 0")
    counts: list[Counter] = [Counter() for _ in MEASURES]
    for i, at, n in cells.groupBy("i", "cell").count().collect():  # at most 2 * OCTAVES * GRID each
        counts[i][at] = n
    edges = []
    for cell_counts in counts:
        total, upto, cuts = cell_counts.total(), 0, {0}
        for at in sorted(cell_counts):
            before, upto = upto, upto + cell_counts[at]
            # The cell that holds a quantile; quantile b is the first value with b / (BINS - 1) at or below it.
            if any(before * (BINS - 1) < b * total <= upto * (BINS - 1) for b in range(1, BINS - 1)):
                cuts.add(at)
        edges.append(sorted(cuts))
    return edges


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From `y, __grams`: rows of this task, and good ones, per bucket that they hold."""
    good, n = np.zeros(GRAMS, dtype=np.int64), np.zeros(GRAMS, dtype=np.int64)
    for batch in batches:
        for y, grams in zip(batch.column("y").to_pylist(), batch.column("__grams").to_pylist()):
            at = unpacked(grams)  # each bucket once
            n[at] += 1
            good[at] += y
    at = np.flatnonzero(n)
    columns = [pa.array(at.astype(np.int32)), pa.array(good[at]), pa.array(n[at])]
    yield pa.RecordBatch.from_arrays(columns, ["value", "good", "n"])


def fit(
    features: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
    rounds: int = ROUNDS,
) -> CoTrained:
    """Co-train on featured rows and the labels of some of them.

    Each round fits naive Bayes per view by one aggregate over all training rows, calibrates
    both on the held-out fold of labelled rows, and lets each label, for the other, all unlabelled
    rows it is confident of. What comes to the driver are counts per feature value. A label
    is good when above zero; a document with several labels has the smallest; null labels
    and keys count as unlabelled. Without labels of both classes, held-out rows left aside, all
    documents score alike.
    """
    edges = measure_edges(features)
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(key).agg((F.min(label) > 0).cast("int").alias("__y"))
    fold = F.pmod(F.xxhash64(F.col(key)), F.lit(FOLDS)) == 0
    bins = binned(edges).alias("__bins")
    rows = features.select(key, bins, "__grams", "__meta").join(known, key, "left")
    held = (fold & F.col("__y").isNotNull()).alias("__held")
    rows = stored(rows.select("__bins", "__grams", "__meta", "__y", held), "co-training")
    own = F.when(~F.col("__held"), F.col("__y"))
    n_bins = len(MEASURES) * BINS
    # Every row has one of the first values: a cell of the first measure, or a source.
    views_of = {"__bins": (n_bins, BINS), "__meta": (METADATA_VALUES, SOURCES + 1)}
    base = rows.agg(
        F.sum("__y").alias("good"), F.count("__y").alias("n"),
        F.sum(own).alias("own_good"), F.count(own).alias("own_n"),
    ).first()
    if (base["own_good"] or 0) in (0, base["own_n"]):
        flat = View([0.0] * n_bins, 0.0), View([0.0] * METADATA_VALUES, 0.0)
        return CoTrained(edges, *flat, 0.0)
    taught = {"__bins": own, "__meta": own}  # what each view trains on
    views: dict[str, View] = {}
    for _ in range(rounds):
        for name, (size, firsts) in views_of.items():
            seen = rows.withColumn("y", taught[name]).filter("y IS NOT NULL")
            cells = seen.select("y", F.explode(name).alias("value")).groupBy("value")
            counts = by_value(cells.agg(F.sum("y").alias("good"), F.count("*").alias("n")))
            good, bad = (sum(c[side] for v, c in counts.items() if v < firsts) for side in (0, 1))
            view = View(log_odds(counts, range(size), good, bad), math.log(good / bad))
            if name == "__bins":
                part = seen.select("y", "__grams").mapInArrow(word_counts, "value int, good long, n long")
                counts = by_value(part.groupBy("value").agg(F.sum("good").alias("good"), F.sum("n").alias("n")))
                weights = log_odds(counts, range(GRAMS), good, bad, WORD_SMOOTHING)
                view = replace(view, words=tuple(weights))
            views[name] = view
        for name, view in views.items():
            scored = rows.filter("__held").select("__y", view.raw(F.col(name)).alias("raw"))
            steps = F.round(F.col("raw") * STEPS_PER_LOGIT) / STEPS_PER_LOGIT
            bounded = F.greatest(F.least(steps, F.lit(LOGIT_LIMIT)), F.lit(-LOGIT_LIMIT))
            held = scored.groupBy(bounded.alias("s")).agg(
                F.sum("__y").alias("good"), F.count("*").alias("n")
            )
            found = sorted((r["s"], r["good"], r["n"]) for r in held.collect())
            if found:
                s, g, n = (np.array(c, dtype=float) for c in zip(*found))
                views[name] = calibrated(view, s, g, n - g)
        for name, other in (("__bins", "__meta"), ("__meta", "__bins")):
            chance = 1 / (1 + F.exp(-views[other].logit(F.col(other))))
            guess = F.when(chance >= CONFIDENT, 1).when(chance <= 1 - CONFIDENT, 0)
            taught[name] = F.when(F.col("__y").isNull(), guess).otherwise(own)
    good, n = base["good"], base["n"]
    return CoTrained(edges, views["__bins"], views["__meta"], math.log((good + 1) / (n - good + 1)))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows with `p_text, p_meta, score, keep`; columns of these names are replaced.

    A null text counts as empty. Repeated rows get the same score; no row is dropped. A score at the
    threshold keeps. Each text is measured once: the rows are written with what was seen of them.
    """
    rows = stored(featured(docs), "quality-features")
    return fit(rows, labels, key).score(rows)


@query()
def op4_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score and verdict."""
    docs = table(spark, sf_dir, "documents")
    narrow = stored(featured(docs).select("doc_id", *FEATURES), "quality-features")
    return fit(narrow, table(spark, sf_dir, "labels")).score(narrow)
