"""Product codes against plain integer k-means."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from labelloom.llm import vector_codes as codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, sums int"


def nearest(book, x):
    return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))


def expected(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    span = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * span : (p + 1) * span]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(book, cut(v, p))[1]].append(cut(v, p))
            books[p] = [
                [sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else y
                for e, y in enumerate(book)
            ]
    text = ",".join(str(x) for book in books for y in book for x in y)
    found = [(i, [nearest(books[p], cut(v, p)) for p in range(parts)], label) for i, v, label in kept]
    by_label = Counter()
    for _, best, label in found:
        by_label[label] += sum(d for d, _ in best)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return Counter(
        (i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), by_label[label], sha)
        for i, best, label in found
    )


def vectors(n, width=32, spread=1.0, seed=0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [
        (i, [c + draw.gauss(0, spread) for c in draw.choice(centres)], None if i % 4 == 0 else i % 3)
        for i in range(n)
    ]


def awkward():
    """Ties, repeated rows and keys, equal entries, vectors that take no part."""
    rows = vectors(90, 16, 0.3, 1)
    rows += [(200 + i, [float(i % 2)] * 16, 7) for i in range(40)] + [(3, [0.5] * 16, 1)] * 3
    rows += [(None, [0.25] * 16, None), (300, None, 1), (301, [], 2), (302, [1.0] * 15 + [None], 1)]
    return rows + [(303, [math.nan] * 16, 1), (304, [math.inf] + [0.0] * 15, 1), (-5, [-0.001] * 16, 2)]


CASES = {"spread": vectors(200), "tight": vectors(150, 16, 0.02), "few": vectors(9, 16), "awkward": awkward()}


@pytest.mark.parametrize("name", CASES)
def test_codes(spark, tmp_path, name):
    rows = CASES[name]
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4).write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    got = codes.op13_ball_codes(spark, str(tmp_path))
    assert Counter(tuple(r) for r in got.collect()) == expected(rows)


def test_no_vector_is_left(spark, tmp_path):
    rows = [(1, None, 1, "x", 1), (2, [], 1, "x", 1), (3, [math.nan] * 16, 1, "x", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert codes.op13_ball_codes(spark, str(tmp_path)).count() == 0


def test_balls_find_what_all_distances_find():
    """Whatever ball a row is in; cores do no work, and rings leave most candidates out."""
    draw = np.random.default_rng(3)
    centres = draw.integers(-900, 900, (20, 4))
    rows = centres[draw.integers(0, 20, 3000)] + draw.integers(-25, 25, (3000, 4))
    book = np.concatenate([centres, centres[:3]])[None]  # with equal entries
    apart = ((rows[:, None] - book[0][None]) ** 2).sum(axis=2)
    best, least = apart.argmin(axis=1), apart.min(axis=1)
    for start in (np.zeros(3000, int), draw.integers(0, 23, 3000), best):
        radii = np.array([[math.isqrt(int(apart[start == e, e].max(initial=0))) + 1 for e in range(23)]])
        for balls in (codes.Balls.around(book), codes.Balls.around(book, radii)):
            got, near = balls.nearest(0, rows, start)
            assert (got == best).all() and (near == least).all()
    reach = (balls.edges[0][best] <= 4 * least[:, None]).sum(axis=1)
    assert reach.mean() < 4 and (reach == 1).mean() > 0.3


def test_too_large_components_end_the_run(spark):
    with pytest.raises(Exception, match="over 64 bits"):
        rows = spark.createDataFrame([(1, [1e9] * 16, 1, "x", 1)], SCHEMA)
        codes.encode_vectors(rows)
