"""Byte-level BPE against tiktoken, and the round trip to bytes."""

import random

import cases
import public_tokenizers
import pytest
import tiktoken

from labelloom.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def hashed(ranks):
    return bpe.PerfectHash(list(ranks), list(ranks.values()))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids(packed):
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def test_perfect_hash(ranks, hashed):
    assert all(hashed.get(k) == v for k, v in ranks.items())
    assert len(hashed.keys) == len(ranks) and hashed.get(b"no such token") is None
    assert bpe.PerfectHash([], []).get(b"a") is None


def test_pattern_is_the_one_that_may_be_cut():
    assert bpe.GPT_PATTERN == public_tokenizers.PATTERN


def test_random_texts(hashed, reference):
    encoder = bpe.Encoder(hashed, public_tokenizers.PATTERN)
    draw = random.Random(1)
    letters = "abc ABC  \n\t\r\x0b\x1c\x85\xa0\u2003'sé\u0301漢🙂१²Ⅷ.,!?$#|09"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 60)))
        assert ids(encoder.encode(text)) == reference.encode_ordinary(text), repr(text)
    assert ids(encoder.encode("a" * 30_000)) == reference.encode_ordinary("a" * 30_000)


def test_frame(spark, ranks, reference):
    got = bpe.encode_documents(cases.frame(spark), ranks, public_tokenizers.PATTERN).collect()
    texts = sorted(((r[0] is None, r[0]), r[1] or "") for r in cases.rows())
    assert sorted((((r["doc_id"] is None, r["doc_id"]), bytes(r["decoded"]).decode()) for r in got)) == texts
    for row in got:
        assert row["ids"] == reference.encode_ordinary(bytes(row["decoded"]).decode())
    assert bpe.encode_documents(cases.empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


def test_decode_column(spark, ranks, reference):
    df = spark.createDataFrame([(reference.encode_ordinary("häuser am see"),), (None,)], "ids array<int>")
    out = [r[0] for r in df.select(bpe.decode("ids", ranks)).collect()]
    assert bytes(out[0]).decode() == "häuser am see" and out[1] is None
