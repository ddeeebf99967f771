"""Subword sequences over a given piece vocabulary: counts, fixed-length ids, text back from ids."""

from __future__ import annotations

import heapq
import math
import sys
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from labelloom.functions.sequences import pad, truncate
from labelloom.plans.lookup import literal_table

# The sign that stands for a blank, and the shape of a chunk no piece crosses.
BLANK = "▁"
CHUNKS = f"{BLANK}*[^{BLANK}]+|{BLANK}+"

REMEMBERED = 1 << 17  # chunks, and parts of chunks, that a task remembers at once
SHORT = 64  # characters up to which joins are found by looking at all neighbours
SLICE = 256  # rows worked on at once; bounds a task's memory

# The codec travels with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Pieces:
    """A vocabulary with byte fallback: normal pieces with scores, byte pieces, and reserved ids."""

    names: Sequence[str]
    scores: dict[str, tuple[float, int]]
    byte_ids: Sequence[int]
    reserved: Sequence[int]
    end: int
    filler: int

    @cached_property
    def inner(self) -> set[str]:
        """All two characters that are neighbours in a piece."""
        return {name[i : i + 2] for name in self.scores for i in range(len(name) - 1)}

    def apart(self, chunk: str) -> list[str]:
        """The chunk, cut between characters that no piece joins, so that joining stays within a part."""
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.inner]
        return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)])]

    def merged(self, chunk: str) -> list[int]:
        """Ids of a chunk: neighbours join, best score first, then leftmost, while a piece names them.

        The characters are a linked list and the possible joins a heap, so a chunk of n
        characters takes n log n steps. For a short one a look at all neighbours per join is quicker.
        """
        parts = self.merged_short(chunk) if len(chunk) <= SHORT else self.merged_long(chunk)
        ids: list[int] = []
        for part in parts:
            known = self.scores.get(part)
            ids += [known[1]] if known else [self.byte_ids[b] for b in part.encode()]
        return ids

    def merged_short(self, chunk: str) -> list[str]:
        parts, known, none = list(chunk), self.scores.get, (-math.inf, -1)
        pairs = [known(a + b, none)[0] for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) != -math.inf:
            i = pairs.index(best)  # the leftmost
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = known(parts[i - 1] + parts[i], none)[0]
            if i < len(pairs):
                pairs[i] = known(parts[i] + parts[i + 1], none)[0]
        return parts

    def merged_long(self, chunk: str) -> list[str]:
        parts = list(chunk)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (known := self.scores.get(parts[i] + parts[j])):
                heapq.heappush(heap, (-known[0], i, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i] if parts[i] else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != joined:
                continue  # one of the two has been joined to something else
            parts[i], parts[j] = joined, ""
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [part for part in parts if part]


def read_pieces(path: str) -> Pieces:
    """The vocabulary of a model file: bounded by that file, not by the data.

    The model must be of pairwise merges with byte fallback, without normalisation.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    names = [model.id_to_piece(i) for i in ids]
    bytewise = [i for i in ids if model.is_byte(i)]
    if len(bytewise) != 256:
        raise ValueError(f"{path} has no byte pieces, so some texts have no ids")
    reserved = [i for i in ids if model.is_control(i) or model.is_unknown(i)]
    special = {*bytewise, *reserved}
    scores = {names[i]: (model.get_score(i), i) for i in ids if i not in special}
    return Pieces(names, scores, bytewise, reserved, model.eos_id(), model.unk_id())


def piece_vocabulary(spark, pieces: Pieces) -> DataFrame:
    """The vocabulary as a table: `id, piece`."""
    return literal_table(spark, list(enumerate(pieces.names)), "id int, piece string")


def chunks(text: Column) -> Column:
    """The parts of a text that pieces never cross: blanks with what follows them.

    A text starts with a blank of its own; the empty text has no parts.
    """
    marked = F.replace(F.concat(F.lit(" "), text), F.lit(" "), F.lit(BLANK))
    found = F.regexp_extract_all(marked, F.lit(CHUNKS), F.lit(0))
    return F.when(F.length(text) == 0, F.expr("CAST(array() AS array<string>)")).otherwise(found)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def row_ends(lists: pa.ListArray) -> np.ndarray:
    """Where each row starts among the flattened items, then their number; a null row has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _with_ids(df: DataFrame, column: str, pieces: Pieces) -> DataFrame:
    """The rows, with the array of chunks in `column` replaced by their ids, chunk by chunk."""
    at = df.columns.index(column)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, bytes] = {}
        inner: dict[str, bytes] = {}

        def remembered(known: dict[str, bytes], text: str, packed: bytes) -> bytes:
            if len(known) >= REMEMBERED:
                known.clear()
            known[text] = packed
            return packed

        def packed_ids(part: str) -> bytes:
            return inner.get(part) or remembered(inner, part, array("i", pieces.merged(part)).tobytes())

        for batch in sliced(batches):
            lists = batch.column(at)
            # Each different chunk of the slice is looked up once; its ids are then dealt to its places.
            coded = lists.flatten().dictionary_encode()
            known = []
            for part in coded.dictionary.to_pylist():
                packed = memory.get(part)
                if packed is None:
                    packed = remembered(memory, part, b"".join(map(packed_ids, pieces.apart(part))))
                known.append(packed)
            sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
            places = coded.indices.to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes[places])])
            ids = np.frombuffer(b"".join(map(known.__getitem__, places.tolist())), dtype=np.int32)
            values = [*batch.columns]
            values[at] = pa.ListArray.from_arrays(
                pa.array(ends[row_ends(lists)], pa.int32()), pa.array(ids), mask=lists.is_null()
            )
            yield pa.RecordBatch.from_arrays(values, names=batch.schema.names)

    kind = T.ArrayType(T.IntegerType())
    fields = [T.StructField(f.name, kind) if f.name == column else f for f in df.schema.fields]
    return df.mapInArrow(segment, T.StructType(fields))


def piece_counts(df: DataFrame, text: str, pieces: Pieces) -> DataFrame:
    """How often each piece occurs in the corpus: `id, piece, n`, for pieces that occur.

    Equal chunks are counted first, combined before the shuffle, and each different chunk is cut into
    pieces once, however often it occurs.
    """
    parts = df.select(F.explode(chunks(F.col(text))).alias("chunk"))
    counted = parts.groupBy("chunk").agg(F.count("*").alias("n"))
    cut = _with_ids(counted.select(F.array("chunk").alias("ids"), "n"), "ids", pieces)
    sums = cut.select(F.explode("ids").alias("id"), "n").groupBy("id").agg(F.sum("n").alias("n"))
    # At most as many rows as the vocabulary has.
    return sums.join(F.broadcast(piece_vocabulary(df.sparkSession, pieces)), "id").select("id", "piece", "n")


def encode_pieces(
    df: DataFrame, key: str, columns: dict[str, tuple[str, int | None]], pieces: Pieces, padded: bool = True
) -> DataFrame:
    """Key and id arrays: `columns` names, for each result, its text and its length.

    An array is cut to the length less one, closed by the end id and, where `padded`, filled up. Without a
    length it holds the whole text. As a chunk has one id at least, no more chunks than the
    length reach Python. A null text has null ids; no text has an unknown id. Map-only.
    """
    rows = df.select(key, *[
        (truncate(chunks(F.col(text)), length) if length else chunks(F.col(text))).alias(name)
        for name, (text, length) in columns.items()
    ])
    for name in columns:
        rows = _with_ids(rows, name, pieces)
    closed = {}
    for name, (_, length) in columns.items():
        kept = truncate(F.col(name), length - 1) if length else F.col(name)
        ids = F.concat(kept, F.array(F.lit(pieces.end)))
        closed[name] = pad(ids, F.lit(length), pieces.filler) if padded and length else ids
    return rows.withColumns(closed)


def decode_pieces(df: DataFrame, key: str, ids: str, pieces: Pieces) -> DataFrame:
    """Ids back to text: reserved ids left out, the first blank removed; null for null ids.

    The bytes of all pieces are put together before they are read as UTF-8, so characters
    spelt in bytes come back; of one that was cut in the middle a replacement sign stays. Ids
    that the vocabulary lacks are left out. Map-only.
    """
    spelt = [name.replace(BLANK, " ").encode() for name in pieces.names]
    for value, i in enumerate(pieces.byte_ids):
        spelt[i] = bytes([value])
    for i in pieces.reserved:
        spelt[i] = b""
    rows = df.select(key, ids)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [*spelt, b""]
        sizes = np.array([len(entry) for entry in table])
        for batch in sliced(batches):
            lists = batch.column(1)
            flat = pc.fill_null(lists.flatten(), -1).to_numpy()
            # The empty entry at the end stands for what is left out.
            known = np.where((flat >= 0) & (flat < len(spelt)), flat, len(spelt))
            joined = b"".join(map(table.__getitem__, known.tolist()))
            ends = np.concatenate([[0], np.cumsum(sizes[known])])[row_ends(lists)].tolist()
            null = lists.is_null().to_pylist()
            texts = [
                None if gone else joined[a + joined.startswith(b" ", a, b) : b]
                for gone, a, b in zip(null, ends, ends[1:])
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], [key, "text"])

    schema = T.StructType([rows.schema[0], T.StructField("text", T.BinaryType())])
    text = F.make_valid_utf8(F.col("text").cast("string"))
    return rows.mapInArrow(spell, schema).select(key, text.alias("text"))
