"""The Merkle manifest against a plain tree built in Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from labelloom.llm import manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return levels


def path(levels, place, fanout):
    """Per level the siblings before and after."""
    out = []
    for level in levels[:-1]:
        start = place // fanout * fanout
        run = level[start : start + fanout]
        out.append(("".join(run[: place - start]), "".join(run[place - start + 1 :])))
        place //= fanout
    return out


def expected(rows, fanout=16):
    by_source = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if text is not None else None
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        digest = leaf(doc_id, source, lang, n_chars, text)
        by_source[source].append((doc_id, digest, leaf(doc_id, source, lang, n_chars, low) if hit else digest))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[source] = tree([r[1] for r in by_source[source]], fanout)
    top = tree([trees[s][-1][0] for s in order], fanout)
    out = Counter()
    for place, source in enumerate(order):
        for i, (doc_id, digest, start) in enumerate(by_source[source]):
            steps = path(trees[source], i, fanout) + path(top, place, fanout)
            end = start
            for before, after in steps:
                end = sha(before + end + after)
            proof = sha("".join(b + a for b, a in steps))
            root = top[-1][0]
            out[(doc_id, digest, trees[source][-1][0], root, proof, end, end == root)] += 1
    return out


def got(spark, tmp_path, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, kids int"
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(tuple(r) for r in manifest.op12_interval_manifest(spark, str(tmp_path)).collect())


def table(sizes):
    return [
        (i, source, "en", i, f"Text {i} of {source}")
        for source, n in sizes.items() for i in range(n)
    ]


CASES = {
    "awkward": [(i, s, lang, n, t) for i, t, lang, s, n, *_ in cases.rows()]
    + [(1, "again", "en", 3, "ABC")] * 20 + [(None, "again", None, None, "X"), (None, "again", None, None, "Y")],
    "sizes": table({None: 3, "": 1, "a": 16, "b": 17, "é": 257, "=": 2, **{f"s{i}": 1 + i % 3 for i in range(40)}}),
    "one row": [(1, None, None, None, None)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_manifest(spark, tmp_path, name):
    assert got(spark, tmp_path, CASES[name]) == expected(CASES[name])


def test_labels_nest(spark):
    """Every node's interval lies in one of the level above, and intervals of a level never overlap."""
    rows = table({"a": 30, "b": 9, "c": 1})
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    built = manifest.build_manifest(docs, fanout=3)
    nodes = defaultdict(list)
    for r in built.nodes().collect():
        nodes[(r.tree, r.level)].append((r.lo, r.hi))
    for (name, level), spans in nodes.items():
        covered = [x for lo, hi in sorted(spans) for x in range(lo, hi + 1)]
        assert covered == list(range(len(covered)))
        above = nodes.get((name, level + 1))
        assert above is None or all(sum(a <= lo and hi <= b for a, b in above) == 1 for lo, hi in spans)
    want = expected(rows, 3)
    proofs = built.proofs().select("digest", "top", "root", manifest.proof_digest(F.col("path")).alias("p"))
    assert Counter(tuple(r) for r in proofs.collect()) == Counter({k[1:5]: n for k, n in want.items()})
