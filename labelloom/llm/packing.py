"""Packing token ids into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelloom.llm.common import slices, table, whole
from labelloom.llm.registry import query

WINDOW = 2048
# A document's rest beyond full windows is cut to pieces of at most this many ids: the more
# pieces meet in a window, the nearer to equal the differencing can make the windows.
PIECE = 512
# Pieces of one differencing problem: bounds a task's memory, at any number of documents.
SHARD = 2048
REMEMBERED = 400_000  # words a worker remembers; bounds memory, not results
SEEN = 1 << 20  # marks of words' parts that came once; only those that come again are remembered
LONG = 64  # longer words hardly return

Piece = tuple[int, int, int]  # size, and two numbers that name it


def differences(sizes: list[int], ways: int) -> list[list[int]]:
    """Positions of `sizes` in `ways` groups of near-equal sums, by Karmarkar-Karp.

    A partial partition holds the sums of its groups, largest first, without the groups
    that are still empty. The two with the largest differences are merged, the largest
    sum of one with the smallest of the other, until one is left; as opposing imbalances
    meet, they cancel. Ties go to the earlier partition, so the result is fixed.
    """
    heap: list[tuple[int, int, list[int], list[list[int]]]] = []
    for i, size in enumerate(sizes):
        heap.append((-size if ways > 1 else 0, i, [size], [[i]]))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, sums, groups = heapq.heappop(heap)
        _, _, more, others = heapq.heappop(heap)
        if len(sums) < len(more):
            sums, groups, more, others = more, others, sums, groups
        room = ways - len(sums)
        # The smaller side's largest sums take empty groups, or else the smallest sums.
        sums, groups = sums + more[:room], groups + others[:room]
        for k, (size, group) in enumerate(zip(more[room:], others[room:])):
            at = ways - room - 1 - k
            sums[at] += size
            groups[at] = groups[at] + group
        order = sorted(range(len(sums)), key=lambda g: -sums[g])
        sums, groups = [sums[g] for g in order], [groups[g] for g in order]
        spread = sums[0] - (sums[-1] if len(sums) == ways else 0)
        heapq.heappush(heap, (-spread, serial, sums, groups))
        serial += 1
    return heap[0][3] if heap else []


def windows(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """The pieces in as few near-equal windows as hold them.

    It starts with the fewest windows that could do; the count rises until no window of
    the partition is over capacity.
    """
    sizes = [p[0] for p in pieces]
    ways = max(-(-sum(sizes) // window), 1)
    while True:
        groups = differences(sizes, ways)
        worst = max((sum(sizes[i] for i in g) for g in groups), default=0)
        if worst <= window:
            return [[pieces[i] for i in sorted(g)] for g in groups if g]
        ways += max(ways * (worst - window) // (2 * window), 1)


class Parts(dict):
    """A word's lower-case part to its ids, by the tokenizer's own model."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.visible = model, byte_alphabet()
        self.seen = bytearray(SEEN)

    def __missing__(self, part: str) -> bytes:
        shown = part if part.isascii() else "".join(map(self.visible.__getitem__, part.encode()))
        packed = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
        if len(part) < LONG:
            mark = hash(part) % SEEN
            if not self.seen[mark]:
                self.seen[mark] = 1
                return packed
            if len(self) >= REMEMBERED:
                self.clear()
                self.seen = bytearray(SEEN)
            self[part] = packed
        return packed


class Words(dict):
    """Text without white space to its ids, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space before anything else, so the words of a text may
    be encoded one by one, and remembered. Words of plain Latin letters go to the model itself
    as soon as they are in lower case and split; all others take the whole tokenizer. So does a
    text that holds the string of an added token, which the tokenizer finds before it splits.
    """

    # The tokenizer's own split, and letters that lower-case one by one.
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    SIMPLE = regex.compile(r"[\x21-\x7eÀ-įĲ-ňŊ-ž]+")
    # What str.split() takes for white space and the tokenizer doesn't.
    SEPARATORS = regex.compile(r"[\x1c-\x1f]")

    def __init__(self, definition: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # A token may be looked for in the lowered text.
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)", regex.IGNORECASE)
        self.part = Parts(self.tokenizer.model).__getitem__

    def __missing__(self, word: str) -> bytes:
        if self.SIMPLE.fullmatch(word):
            packed = b"".join(map(self.part, self.SPLIT.findall(word.lower())))
        else:
            packed = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) < LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if self.SEPARATORS.search(text) or self.added.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.split()))


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where it can be seen, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


Encode = Callable[[], Callable[[str], bytes]]


def pack_documents(
    docs: DataFrame,
    encoder: Encode,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    window: int = WINDOW,
    piece: int = PIECE,
    shard: int = SHARD,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of the documents in windows of at most `window` ids, with little padding.

    Returns `key, start, length, ids_crc32, doc_tokens, sequence_id, offset` and, with
    `keep_ids`, the piece's `ids`. A document's ids are the encoder's and `end_id`. As many
    full windows as it has are its own; the rest is cut to pieces of at most `piece` ids, and
    `shard` pieces at a time become windows by differencing, inside the task that read
    them. Nothing is shuffled, no task holds more than a batch and a shard, and a rerun of a lost task
    gives the same windows. `sequence_id` is unique, not dense.

    A null text counts as empty and has the end id alone. Null keys, repeated rows and
    texts of any length are packed like others; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"key {kind}, " + ", ".join(f"`{n}` long" for n in names[1:])
    if keep_ids:
        names, schema = [*names, "ids"], schema + ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        first = TaskContext.get().partitionId() << 36
        made = 0
        tail = np.array([end_id], dtype="<u4").tobytes()
        waiting: list[tuple] = []

        def emit(ready: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal made
            columns: list[list] = [[] for _ in names]
            for window_pieces in ready:
                offset = 0
                for size, start, total, owner, packed in window_pieces:
                    row = [owner, start, size, zlib.crc32(packed), total, first + made, offset]
                    if keep_ids:
                        row.append(np.frombuffer(packed, dtype="<u4").astype(np.int32))
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += size
                made += 1
            kinds = [key_type] + [pa.int64()] * 6 + [pa.list_(pa.int32())] * keep_ids
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        key_type = pa.int64()
        for batch in slices(batches, 256):
            key_type = batch.schema.field("key").type
            full: list[list[tuple]] = []
            for owner, value in zip(batch.column("key").to_pylist(), batch.column("text")):
                packed = encode(value.as_py()) + tail
                total, start = len(packed) // 4, 0
                while start < total:
                    size = window if total - start >= window else min(piece, total - start)
                    cut = (size, start, total, owner, packed[4 * start : 4 * (start + size)])
                    if size == window:
                        full.append([cut])
                    else:
                        waiting.append(cut)
                    start += size
            if full:
                yield emit(full)
            while len(waiting) >= shard:
                yield emit(windows(waiting[:shard], window))
                waiting = waiting[shard:]
        if waiting:
            yield emit(windows(waiting, window))

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def word_bpe(spark: SparkSession, path: str) -> Encode:
    """An encoder of the tokenizer at `path`, sent to each executor once (some MB)."""
    with open(path, encoding="utf-8") as definition:
        shared = spark.sparkContext.broadcast(definition.read())
    return lambda: known_words(shared.value).encode


@lru_cache(maxsize=1)
def known_words(definition: str) -> Words:
    """One table of words per worker process, for all its tasks."""
    return Words(definition)


@query()
def op7_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with the window and the place of each."""
    import public_tokenizers

    encoder = word_bpe(spark, public_tokenizers.path("word_bpe_49k.json"))
    return pack_documents(table(spark, sf_dir, "documents"), encoder, keep_ids=False)
