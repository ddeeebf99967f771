"""Most frequent terms from bounded summaries, and matrices over many labels."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.operators import features, frequent, metrics, sequences


def table(spark, seed, hot=0.0):
    draw = random.Random(seed)
    rows = []
    for i in range(400):
        words = [f"w{min(int(draw.paretovariate(0.8)), 900)}" for _ in range(draw.randint(0, 60))]
        rows.append((i, " ".join(words + ["hot"] * int(hot * 100))))
    rows += [(1000, None), (1001, "")]
    return spark.createDataFrame(rows, "id long, t string").repartition(6, "id")


@pytest.mark.parametrize("capacity", [5, 150, 10_000])
def test_as_the_full_count(spark, capacity):
    """Whether the summaries are exact, give candidates or leave it open."""
    df = table(spark, 3, 0.4)
    want = sequences.vocabulary(df, "t", 20).collect()
    assert sequences.vocabulary(df, "t", 20, summary=capacity).collect() == want


def test_bounds_hold(spark):
    df = table(spark, 4).select(F.explode(F.split("t", " ")).alias("w")).filter("w <> ''")
    full = Counter(r.w for r in df.collect())
    found = df.select("w").mapInArrow(frequent.summaries(30), "term string, n long").collect()
    lost = sum(r.n for r in found if r.term is None)
    sums = Counter()
    for r in found:
        if r.term is not None:
            sums[r.term] += r.n
    tasks = sum(r.term is None for r in found)
    assert len(found) <= tasks * 31
    assert all(sums[w] <= n <= sums[w] + lost for w, n in full.items())
    kinds = {c: frequent.frequent_candidates(df, 5, c) for c in (3, 100, 5000)}
    assert kinds[5000].exact and kinds[3] is None
    assert not kinds[100].exact and kinds[100].terms.count() < len(full)
    top = {w for w, _ in sorted(full.items(), key=lambda p: (-p[1], p[0]))[:5]}
    assert top <= {r.term for r in kinds[100].terms.collect()}


def test_term_statistics(spark):
    df = table(spark, 5)
    want = features.term_statistics(df, "t", 15).collect()
    for capacity in (3, 60, 5000):
        assert features.term_statistics(df, "t", 15, summary=capacity).collect() == want


def test_cells_and_limits(spark):
    rows = [(f"l{i % 7}", f"l{i % 5}" if i % 9 else None) for i in range(100)]
    counts = metrics.confusion_counts(spark.createDataFrame(rows, "t string, p string"), "t", "p")
    labels = {x for r in rows for x in r if x}
    want = Counter(r for r in rows if r[1])
    got = {(r.true, r.pred): r.n for r in metrics.confusion_cells(counts, blocks=3).collect()}
    assert got == {(a, b): want[a, b] for a in labels for b in labels}
    wide = {r["true"]: r for r in metrics.observed_matrix(counts).collect()}
    assert all(wide[a][b] == n for (a, b), n in got.items())
    with pytest.raises(ValueError, match="more than 6"):
        metrics.observed_matrix(counts, 6)
    with pytest.raises(ValueError, match="more than 6"):
        metrics.confusion_cells(counts, 6)
