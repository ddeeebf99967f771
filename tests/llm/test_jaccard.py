"""The similarity join against all pairs."""

from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from labelloom.llm import jaccard
from labelloom.llm.components import components


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def expected(rows):
    """Per row: key, group's smallest key, links; and the number of groups."""
    sets = [shingles(r[1]) for r in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[root(i)].append(row[0])
    smallest = {r: min([k for k in ks if k is not None], default=None) for r, ks in groups.items()}
    out = Counter(
        (row[0], smallest[root(i)], links[i]) for i, row in enumerate(rows)
    )
    return out, len(groups)


@pytest.mark.parametrize("parts", [2048, 3])
def test_against_all_pairs(spark, monkeypatch, parts):
    """Also with buckets cut into many parts."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", parts)
    got = jaccard.jaccard_classes(cases.frame(spark)).collect()
    want, groups = expected(cases.rows())
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want
    assert sum(r["kept"] for r in got) == groups


def test_rows_that_stay(spark):
    docs = cases.frame(spark)
    left = jaccard.drop_near(docs)
    assert left.columns == docs.columns and left.count() == expected(cases.rows())[1]
    assert jaccard.drop_near(cases.empty(spark)).count() == 0
    assert jaccard.jaccard_classes(cases.empty(spark)).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    """Of 200,000 pairs of similarity 0.8, none is pruned; of similarity 0.4, hardly one stays."""
    draw = np.random.default_rng(1)
    values = jaccard.BANDS * jaccard.ROWS
    for similarity, low, high in ((0.8, 199_990, 200_000), (0.4, 0, 200)):
        alive = np.ones(200_000, dtype=bool)
        count = np.zeros(200_000, dtype=int)
        for seen in range(jaccard.STEP, values + 1, jaccard.STEP):
            count += draw.binomial(jaccard.STEP, similarity, 200_000)
            alive &= count >= jaccard.fewest_matches(seen, 0.8, jaccard.TOLERANCE)
        assert low <= alive.sum() <= high


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 8), (7, 9), (7, 7)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    want = {i: 100 for i in range(100, 161)} | {7: 7, 8: 7, 9: 7}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
