"""Subword sequences against the library that wrote the vocabulary."""

import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import types as T

from labelloom.operators import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  two  spaces \n new\tline ", "é漢字🙂 <s> </s> <unk> <0x0A>", "hello hello world", "x" * 3000,
    "a" + " " * 40 + "b", "unseen zqxjkv Wörter", " 　\x00 end", "line\nline\r\n", "ﬁ Å ①", "1234567 89",
]


@pytest.fixture(scope="module")
def codec():
    return pieces.read_pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(5)
    texts = TEXTS + ["".join(draw.choice("ab  the\n é漢in") for _ in range(draw.randint(1, 60))) for _ in range(200)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40)
    texts += [r.text for r in docs.collect()]
    rows = [(n, t) for n, t in enumerate([*texts, None])]
    return rows, spark.createDataFrame(rows, "key long, text string").repartition(4)


def test_ids_are_the_library_s(codec, table):
    known, library = codec
    rows, df = table
    got = pieces.encode_pieces(df, "key", {"ids": ("text", None)}, known).collect()
    want = {k: None if t is None else [*library.encode(t), library.eos_id()] for k, t in rows}
    assert {r.key: r.ids for r in got} == want
    assert not any(library.unk_id() in ids for ids in want.values() if ids)


def test_fixed_lengths(codec, table):
    known, library = codec
    rows, df = table
    wanted = {"a": ("text", 16), "b": ("text", 5)}
    for r in pieces.encode_pieces(df, "key", wanted, known).collect():
        for ids, length in ((r.a, 16), (r.b, 5)):
            text = rows[r.key][1]
            full = None if text is None else [*library.encode(text)[: length - 1], library.eos_id()]
            assert ids == (full and full + [0] * (length - len(full)))


def test_decode_of_encode_is_the_text(codec, table):
    known, _ = codec
    rows, df = table
    encoded = pieces.encode_pieces(df, "key", {"ids": ("text", None)}, known)
    assert {r.key: r.text for r in pieces.decode_pieces(encoded, "key", "ids", known).collect()} == dict(rows)


def test_cut_characters_and_strange_ids(spark, codec):
    known, library = codec
    ids = library.encode("漢")  # the blank and three bytes
    frame = spark.createDataFrame([(1, [*ids[:-1], 2, 0, -4, 99_999])], "key long, ids array<int>")
    assert pieces.decode_pieces(frame, "key", "ids", known).first().text.strip("�") == ""


def test_counts(codec, table):
    known, library = codec
    rows, df = table
    want = Counter(i for _, t in rows if t for i in library.encode(t))
    got = pieces.piece_counts(df, "text", known).collect()
    assert {r.id: r.n for r in got} == want and all(library.id_to_piece(r.id) == r.piece for r in got)
    assert pieces.piece_counts(df.limit(0), "text", known).count() == 0


def test_work_follows_different_chunks(codec, monkeypatch):
    """A chunk that comes many times in a slice is looked up once, and decoding needs no look-up per id in the JVM."""
    known, _ = codec
    seen = Counter()
    monkeypatch.setattr(pieces.Pieces, "merged", lambda self, chunk: seen.update([chunk]) or [5, 6])
    monkeypatch.setattr(pieces, "REMEMBERED", 1)

    class Frame:
        """What `_with_ids` asks of a frame."""

        columns, schema = ["ids"], T.StructType([T.StructField("ids", T.ArrayType(T.StringType()))])

        def mapInArrow(self, run, _):
            rows = [["a", "b", "a"], None, [], ["b", "b", "a"]]
            batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["ids"])
            return [b.column(0).to_pylist() for b in run([batch.slice(0), batch.slice(1)])]

    first = [[5, 6] * 3, None, [], [5, 6] * 3]
    assert pieces._with_ids(Frame(), "ids", known) == [first, first[1:]]
    assert seen == {"a": 2, "b": 1}


def test_decode_of_odd_arrays(spark, codec):
    known, library = codec
    ids = library.encode("  two")
    frame = spark.createDataFrame([(1, None), (2, []), (3, [None, *ids, None]), (4, ids)], "key long, ids array<long>")
    got = {r.key: r.text for r in pieces.decode_pieces(frame.coalesce(1), "key", "ids", known).collect()}
    assert got == {1: None, 2: "", 3: "  two", 4: "  two"}
