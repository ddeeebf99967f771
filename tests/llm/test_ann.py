"""Neighbours on Hilbert curves against brute force."""

from itertools import product

import numpy as np

from pyspark.sql import functions as F

from labelloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def exact(ids, vectors, query, k):
    apart = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(axis=1))
    apart[ids == query] = np.inf
    order = np.lexsort((ids, apart))[:k]
    return ids[order].tolist(), apart[order]


def test_curve_visits_neighbouring_cells():
    cells = np.array(list(product(range(8), repeat=3)))
    order = cells[np.argsort(ann.hilbert_keys(cells, 3))].astype(int)
    assert len(np.unique(ann.hilbert_keys(cells, 3))) == 512
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_recall(spark):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(6000, 24)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = np.arange(6000)
    df = spark.createDataFrame([(int(i), v.tolist(), "x") for i, v in zip(ids, vectors)], SCHEMA)
    got = ann.nearest(df, F.col("vec_id") % 100 == 0, block=128).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert len(found) == 60 and all(sorted(f) == list(range(1, 11)) for f in found.values())
    hits = []
    for q, f in found.items():
        want, apart = exact(ids, vectors.astype(float), q, 10)
        hits.append(len({v for v, _ in f.values()} & set(want)))
        for v, score in f.values():
            assert np.isclose(score, np.sqrt(((vectors[v].astype(float) - vectors[q]) ** 2).sum()), atol=1e-12)
    assert np.mean(hits) / 10 >= 0.9


def test_equal_and_unsound_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], "x") for i in range(0, 400)]  # one vector, many keys
    rows += [(500, [3.0, 4.0], "x"), (500, [3.0, 4.0], "x"), (501, [nan, 1.0], ""), (502, [inf, 1.0], "")]
    rows += [(503, [0.0, 0.0], ""), (504, None, ""), (505, [None, 1.0], ""), (506, [], ""), (507, [1.0], "")]
    rows += [(None, [1.0, 2.0], "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ann.nearest(df, F.col("vec_id").isin(0, 300, 500, 503), k=5, block=64).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == {0: [1, 2, 3, 4, 5], 300: [0, 1, 2, 3, 4], 500: [0, 1, 2, 3, 4]}


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(1, [1.0], "x"), (2, [2.0], "x"), (3, [4.0], "x")], SCHEMA)
    got = ann.nearest(few, F.col("vec_id") == 1).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 2, 1.0), (2, 3, 3.0)]
    none = ann.nearest(few.limit(0), F.lit(True))
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]
