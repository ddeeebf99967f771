"""Recurring passages against a count of all windows."""

from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest

from labelloom.llm import substring_dedup
from labelloom.llm.substring_dedup import Windows, remove_repeats, sliding


def expected(rows, window):
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in texts for i in range(len(w) - window + 1))
    out = Counter()
    for key, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out[(key, len(w), sum(gone), kept)] += 1
    return out


@pytest.mark.parametrize("window", [35, 8, 3])
def test_against_brute_force(spark, window):
    got = remove_repeats(cases.frame(spark), window=window)
    assert Counter(tuple(r) for r in got.collect()) == expected(cases.rows(), window)


def test_no_rows(spark):
    assert remove_repeats(cases.empty(spark)).count() == 0


def test_one_text_repeats_itself(spark):
    rows = [(1, " ".join("a" for _ in range(9))), (2, "b c " * 5), (3, "d e f g h i j k l m n o")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=8)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows, 8)


@pytest.mark.parametrize("size", [1, 3, 7, 30])
def test_sliding(size):
    values = np.random.default_rng(1).integers(0, 50, 64).astype(np.uint64)
    want = [values[i : i + size].min() for i in range(64 - size + 1)]
    assert sliding(values, size, np.minimum).tolist() == want


def test_equal_windows_have_equal_hashes():
    windows, draw = Windows(35), np.random.default_rng(2)
    passage = draw.integers(0, 2**63, 35, dtype=np.uint64)
    for ahead in (0, 1, 1000, 70_000):
        text = np.concatenate([draw.integers(0, 2**63, ahead, dtype=np.uint64), passage])
        assert windows.mixed(text, 35)[-1] == windows.mixed(passage, 35)[0]


def words_joined(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(")


def test_digests_come_from_one_pass(spark):
    got = remove_repeats(cases.frame(spark), digests=True)
    assert words_joined(got) == 0
    assert got.select("doc_id").count() == len(cases.rows())


@pytest.mark.parametrize("window", [2, 11])
def test_windows_of_other_sizes(spark, window):
    got = remove_repeats(cases.frame(spark), window=window)
    assert Counter(tuple(r) for r in got.collect()) == expected(cases.rows(), window)


def test_no_window_reaches_into_the_next_text(spark):
    parts = cases.words(20, 70).split(" ")
    cut = [parts[:20], parts[20:35], parts[35:60], parts[60:]]
    rows = [(i, " ".join(w)) for i, w in enumerate([*cut, parts[:34] + parts[35:], parts])]
    rows += [(10, " ".join(parts[30:] + ["end"])), (11, " ".join(["begin"] + parts[:40]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = remove_repeats(df)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows, 35)


TEXTS = ["", "a", "a\0 a\0\0 a", "漢字 Ünïcode 🙂", "", "x" * 64 + " " + "x" * 65, "12345678 123456789 1234567812345678", "a"]


@pytest.mark.parametrize("low", [0, 1, 3])
def test_words_and_their_hashes(low):
    words = substring_dedup.Words(pa.array(TEXTS).slice(low))
    want = [w.encode() for t in TEXTS[low:] for w in t.split(" ")]
    got = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends)]
    assert got == want and np.diff(words.at).tolist() == [t.count(" ") + 1 for t in TEXTS[low:]]
    hashes = words.hashes().tolist()
    assert len(set(zip(want, hashes))) == len(set(want)) == len(set(hashes))


@pytest.mark.parametrize("width", [1, 2, 3, 7, 13])
def test_group_numbers(width):
    numbers = np.random.default_rng(3).integers(0, 3, 400)
    groups = [tuple(numbers[i : i + width]) for i in range(400 - width + 1)]
    codes = substring_dedup.group_numbers(numbers, width).tolist()
    assert len(codes) == len(groups)
    assert len(set(zip(groups, codes))) == len(set(groups)) == len(set(codes))
