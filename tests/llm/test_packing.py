"""Packing: every id once, no window over capacity, and the differencing itself."""

import random
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from labelloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_differencing():
    # The textbook two-way run: 8 7 6 5 4 differ to 2.
    groups = packing.differences([8, 7, 6, 5, 4], 2)
    assert sorted(sorted(g) for g in groups) and abs(
        sum([8, 7, 6, 5, 4][i] for i in groups[0]) - sum([8, 7, 6, 5, 4][i] for i in groups[1])
    ) == 2
    assert packing.differences([], 3) == [] and packing.differences([5], 3) == [[0]]


def test_windows_are_few_and_near_equal():
    draw = random.Random(2)
    pieces = [(draw.randint(1, 512), i, 0) for i in range(2048)]
    made = packing.windows(pieces, 2048)
    sums = [sum(p[0] for p in w) for w in made]
    assert sorted(p for w in made for p in w) == sorted(pieces)
    assert max(sums) <= 2048 and max(sums) - min(sums) < 64
    assert len(made) <= 1.02 * sum(sums) / 2048 + 1


def test_window_count_rises():
    assert len(packing.windows([(1500, 0, 0), (1500, 1, 0), (1000, 2, 0)], 2048)) == 3


def test_words_match_the_tokenizer(reference):
    with open(PATH, encoding="utf-8") as definition:
        encode = packing.Words(definition.read()).encode
    draw = random.Random(3)
    letters = "abcABC  \n\tÉßŒİıſ's'LL߀漢🙂१²Ⅷ.,$#|09\u0301\x1c<|endoftext|>ǅΣς"
    for _ in range(2000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        if draw.random() < 0.2:
            token = draw.choice(("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "<| endoftext|>"))
            at = draw.randint(0, len(text))
            text = text[:at] + token + text[at:]
        ids = np.frombuffer(encode(text), dtype="<u4").tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_parts_that_come_once_are_not_remembered(reference, monkeypatch):
    """A word is remembered itself; its part is worth the memory only if other words have it too."""
    with open(PATH, encoding="utf-8") as definition:
        words = packing.Words(definition.read())
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    for n in range(300):
        text = f"the end, q{'abcdefghij'[n % 10]}{'klmnopqrst'[n // 10 % 10]}{'uvw'[n // 100]} word."
        ids = np.frombuffer(words.encode(text), dtype="<u4").tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids
        assert len(words) <= 20 and len(words.part.__self__) < 10  # marks may be shared by chance


def test_frame(spark, reference):
    encoder = packing.word_bpe(spark, PATH)
    got = packing.pack_documents(cases.frame(spark), encoder).collect()
    by_text = {}
    for row in got:
        packed = np.array(row["ids"], dtype="<u4").tobytes()
        assert row["length"] == len(row["ids"]) and row["ids_crc32"] == zlib.crc32(packed)
        by_text.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for pieces in by_text.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(reference.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in cases.rows())
    assert sum(r["length"] for r in got) == total
    long_text = next(r[1] for r in cases.rows() if r[0] == 46)
    pieces = sorted((r["start"], r["ids"]) for r in got if r["doc_id"] == 46)
    ids = reference.encode(long_text, add_special_tokens=False).ids + [1]
    assert [i for _, p in pieces for i in p] == ids
    assert packing.pack_documents(cases.empty(spark), encoder).count() == 0
