"""Co-training: held-out accuracy, scores against plain Python, tables without labels."""

import math
import random
from collections import Counter

import cases
import numpy as np
import pytest
import xxhash

from labelloom.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=600):
    """Clean prose and symbol junk; a third is labelled. One source is all junk."""
    draw, docs, labels = random.Random(1), [], []
    for i in range(n):
        bad = i % 4 == 0
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(60)]
        text = " ".join(w + "***" * bad for w in words)
        docs.append((i, text, "en", "junkyard" if bad else f"src{i % 7}", len(text)))
        if i % 3 == 0:
            labels.append((i, int(not bad), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = quality.classify(df, spark.createDataFrame(labels, LABELS)).collect()
    known = {i for i, *_ in labels}
    held = [r for r in got if r["doc_id"] not in known]
    assert len(got) == len(docs) and len(held) == 400
    assert np.mean([r["keep"] == (r["doc_id"] % 4 != 0) for r in held]) > 0.99
    # The metadata view learnt the source, which on its own tells the classes apart.
    assert np.mean([(r["p_meta"] > 0.5) == (r["doc_id"] % 4 != 0) for r in held]) > 0.95


def test_awkward_rows(spark):
    docs = cases.frame(spark)
    labels = spark.createDataFrame([(1, 1, 0), (46, 0, 0), (46, 1, 0), (None, 1, 0), (2, None, 0)], LABELS)
    got = quality.classify(docs, labels)
    assert got.count() == docs.count() and got.filter("score IS NULL OR keep IS NULL").count() == 0


def test_without_labels_all_stay(spark):
    docs = cases.frame(spark)
    none = spark.createDataFrame([], LABELS)
    assert quality.classify(docs, none).filter("keep").count() == docs.count()
    assert quality.classify(cases.empty(spark), none).count() == 0


def test_calibration():
    """Scores that are three times the true log-odds get a slope of about a third."""
    draw = np.random.default_rng(2)
    truth = np.round(draw.normal(0, 2, 50_000), 1)
    good = draw.random(50_000) < 1 / (1 + np.exp(-truth))
    values = np.unique(truth)
    hits = np.array([good[truth == v].sum() for v in values], dtype=float)
    n = np.array([(truth == v).sum() for v in values], dtype=float)
    view = quality.calibrated(quality.View([], 0.0), values * 3, hits, n - hits)
    assert abs(view.slope - 1 / 3) < 0.02 and abs(view.offset) < 0.1


# Co-training once more, row by row.


def bucket(value, buckets):
    """Spark's xxhash64 of a string or long, modulo the buckets."""
    if value is None:
        return buckets
    raw = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True)
    return signed(raw) % buckets


def signed(raw):
    value = xxhash.xxh64_intdigest(raw, seed=42)
    return value - 2**64 if value >= 2**63 else value


def logistic(rows):
    """Slope and offset of the logistic fit to `(score, label)`, by Newton steps over the rows."""
    good = sum(y for _, y in rows)
    bad = len(rows) - good
    if not (good and bad):
        return 1.0, 0.0
    goal = {1: (good + 1) / (good + 2), 0: 1 / (bad + 2)}
    x = np.array([[s, 1.0] for s, _ in rows])
    t = np.array([goal[y] for _, y in rows])
    start = np.array([0.0, math.log((good + 1) / (bad + 1))])
    at = start.copy()
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ at))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-12 * np.eye(2), x.T @ (t - p))
        at += step / max(1.0, abs(step).max())
    return tuple(at if at[0] >= 0 else start)


def co_trained(docs, labels):
    """`{doc_id: (p_text, p_meta, score)}` for documents `(doc_id, text, lang, source, ...)`."""
    buckets = quality.Buckets()
    seen = [quality.measured(d[1] or "", buckets) for d in docs]
    y = {}
    for i, label, _ in labels:
        y[i] = min(y.get(i, 1), int(label > 0))
    y = [y.get(d[0]) for d in docs]
    held = [signed(d[0].to_bytes(8, "little")) % 5 == 0 for d in docs]
    cuts = []
    for m in range(len(quality.MEASURES)):
        above = sorted(c[m] for c, _ in seen if c[m] > 0)
        at = [math.ceil(b * len(above) / 15) - 1 for b in range(1, 15)] if above else []
        cuts.append({0, *(above[i] for i in at)})
    text = [
        [("m", m, sum(cut < c for cut in cuts[m])) for m, c in enumerate(cells)] for cells, _ in seen
    ]
    words = [[("w", g) for g in grams] for _, grams in seen]
    meta = [[("s", bucket(d[3], 4096)), ("l", bucket(d[2], 64))] for d in docs]
    none = [[] for _ in docs]
    views = [(text, words), (meta, none)]
    own = [None if h else v for h, v in zip(held, y)]
    taught, logits = [own, own], [None, None]
    for _ in range(3):
        for k, (plain, damped) in enumerate(views):
            rows = [Counter(taught[k])[v] for v in (1, 0)]
            counts = Counter((f, v) for i, v in enumerate(taught[k]) if v is not None for f in plain[i] + damped[i])

            def weight(f, smooth):
                parts = [(counts[f, v] + smooth * n / sum(rows)) / n for v, n in zip((1, 0), rows)]
                return math.log(parts[0]) - math.log(parts[1])

            raw = [
                math.log(rows[0] / rows[1]) + sum(weight(f, 1) for f in plain[i])
                + sum(weight(f, 100) for f in damped[i]) / math.sqrt(max(len(damped[i]), 1))
                for i in range(len(docs))
            ]
            slope, offset = logistic([
                (max(min(math.copysign(math.floor(abs(r) * 10 + 0.5) / 10, r), 40), -40), v)
                for r, v, h in zip(raw, y, held) if h and v is not None
            ])
            logits[k] = [slope * r + offset for r in raw]
        for k in (0, 1):
            sure = [1 if c >= 0.95 else 0 if c <= 1 - 0.95 else None for c in map(chance, logits[1 - k])]
            taught[k] = [s if v is None else o for s, v, o in zip(sure, y, own)]
    known = [v for v in y if v is not None]
    prior = math.log((sum(known) + 1) / (len(known) - sum(known) + 1))
    return {
        d[0]: (chance(t), chance(m), chance(t + m - prior)) for d, t, m in zip(docs, *logits)
    }


def chance(logit):
    return 1 / (1 + math.exp(-logit))


@pytest.mark.parametrize("parts", [1, 7])
def test_scores_are_those_of_plain_co_training(spark, parts):
    """Noisy labels, sources that tell little, nulls; the same on any partitioning."""
    draw = random.Random(5)
    docs, labels = [], []
    for i in range(700):
        bad = draw.random() < 0.3
        pool = ["alpha", "beta", "gamma", "delta"] + ["spam", "CLICK", "win!"] * bad
        text = "\n".join(" ".join(draw.choices(pool, k=draw.randint(1, 12))) for _ in range(draw.randint(1, 5)))
        source = draw.choice(["a", "b", None] if draw.random() < 0.5 else ["junk" if bad else "press"])
        docs.append((i, None if i % 97 == 0 else text, draw.choice(["en", "de", None]), source, len(text)))
        if draw.random() < 0.5:
            labels.append((i, int(bad == (draw.random() < 0.1)), 0))
            if i % 50 == 0:
                labels.append((i, 0, 0))  # a second label
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = quality.classify(df.repartition(parts), spark.createDataFrame(labels, LABELS)).collect()
    want = co_trained(docs, labels)
    assert len(got) == len(want)
    for r in got:
        assert (r["p_text"], r["p_meta"], r["score"]) == pytest.approx(want[r["doc_id"]], abs=1e-7)
        assert r["keep"] == (r["score"] >= 0.5)
    assert len({round(r["score"], 6) for r in got}) > 300


def test_columns_of_the_same_names(spark):
    """Columns named as the results are replaced, a score at the threshold keeps."""
    docs, labels = corpus(60)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    named = df.selectExpr("*", "'x' AS score", "'x' AS keep", "1 AS p_text", "2 AS extra")
    got = quality.classify(named, spark.createDataFrame(labels, LABELS))
    assert got.columns == [*df.columns, "extra", "p_text", "p_meta", "score", "keep"]
    assert dict(got.dtypes)["keep"] == "boolean" and dict(got.dtypes)["score"] == "double"
    none = quality.classify(named, spark.createDataFrame([], LABELS))
    assert {tuple(r) for r in none.select("score", "keep").collect()} == {(0.5, True)}


def test_cells_grow_with_the_measure():
    values = [0.0, 1e-12, 0.001, 0.01, 0.5, 0.53125, 0.99, 1.0, 7.5, 40_000.0, 1e12]
    cells = [quality.cell(v) for v in values]
    assert cells == sorted(cells) and cells[0] == 0 and len(set(cells)) == len(cells)


@pytest.mark.parametrize("numbers", [[], [0], [254, 255, 509], [1, 2, 32767], [255, 510, 765], [0, 255, 32767]])
def test_packed_numbers_come_back(numbers):
    assert quality.unpacked(quality.packed(numbers)).tolist() == numbers
