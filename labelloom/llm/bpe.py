"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelloom.llm.common import slices, table, whole
from labelloom.llm.registry import query

# Parts a worker remembers before it starts anew; it bounds memory, not results.
REMEMBERED = 400_000
LONG = 64  # longer parts hardly return
KEYS_PER_BUCKET = 2  # leaves many buckets of one key, which fit anywhere, for the last slots
# Fixed value: the pattern before a space that always ends a pre-token; others are never cut.
GPT_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
MASK = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) }


def mixed(value: int, seed: int) -> int:
    """A 64-bit hash of a hash and a small seed."""
    value = (value + (seed + 1) * 0x9E3779B97F4A7C15) & MASK
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    return value ^ (value >> 31)


def mixed_all(values: np.ndarray, seed: int) -> np.ndarray:
    """`mixed` for an array."""
    values = values + np.uint64(((seed + 1) * 0x9E3779B97F4A7C15) & MASK)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of byte keys: n keys in n slots, hash and displace.

    Keys fall into buckets; from the largest bucket on, each looks for the first seed that
    sends all its keys to free slots. A bucket of one key takes any free slot and
    stores that slot as a negative seed. The key kept in a slot tells a member from any
    other bytes.
    """

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        n = len(keys)
        self.n, self.buckets = n, max(n // KEYS_PER_BUCKET, 1)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys share a 64-bit hash, or a key is repeated")
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            members[b].append(i)
        self.seeds = [0] * self.buckets
        taken = np.zeros(n, dtype=bool)
        slot_of = np.zeros(n, dtype=np.int64)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        free: Iterator[int] | None = None
        for b in order:
            own = np.array(members[b], dtype=np.int64)
            if len(own) == 0:
                break
            if len(own) == 1:
                free = iter(np.flatnonzero(~taken).tolist()) if free is None else free
                slot = next(free)
                self.seeds[b], slot_of[own[0]] = -slot - 1, slot
                continue
            seed = 0
            while True:
                slots = (mixed_all(hashes[own], seed) % np.uint64(n)).astype(np.int64)
                if not taken[slots].any() and len(set(slots.tolist())) == len(own):
                    break
                seed += 1
            self.seeds[b] = seed
            taken[slots], slot_of[own] = True, slots
        self.keys: list[bytes] = [b""] * n
        self.values = [-1] * n
        for i, slot in enumerate(slot_of.tolist()):
            self.keys[slot], self.values[slot] = keys[i], values[i]

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[h % self.buckets]
        slot = -seed - 1 if seed < 0 else mixed(h, seed) % self.n
        return self.values[slot] if self.keys[slot] == key else None


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair of lowest rank, leftmost first, is merged until none has a rank.

    The parts are a linked list over byte positions; the heap holds candidate pairs, and
    one that no longer stands (a part of it was merged) is skipped when it comes up.
    """
    n, rank = len(piece), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for left in range(n - 1):
        found = rank(piece[left : left + 2])
        if found is not None:
            heap.append((found, left, left + 2))
    heapq.heapify(heap)
    while heap:
        _, left, end = heapq.heappop(heap)
        right = after[left]
        # A part merged into another has no successor; a part that grew ends elsewhere.
        if right < 0 or right >= n or after[right] != end:
            continue
        after[left], after[right] = end, -1
        if end < n:
            before[end] = left
            found = rank(piece[left : after[end]])
            if found is not None:
                heapq.heappush(heap, (found, left, after[end]))
        ahead = before[left]
        if ahead >= 0:
            found = rank(piece[ahead:end])
            if found is not None:
                heapq.heappush(heap, (found, ahead, end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Tokens(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit integers, resolved on demand."""

    def __init__(self, hashed: PerfectHash) -> None:
        super().__init__()
        self.whole = hashed.get
        self.ranks = dict(zip(hashed.keys, hashed.values))

    def __missing__(self, token: str) -> bytes:
        piece = token.encode()
        found = self.whole(piece)
        ids = [found] if found is not None else merge_bytes(piece, self.ranks)
        packed = np.array(ids, dtype="<u4").tobytes()
        if len(token) < LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[token] = packed
        return packed


class Encoder(dict):
    """Text between two spaces to the ids of a space and that text.

    Before a space that a non-space follows, the pattern always ends a pre-token, so a text
    may be cut there and each part split and encoded by itself, and remembered.
    """

    def __init__(self, hashed: PerfectHash, pattern: str) -> None:
        super().__init__()
        self.tokens = Tokens(hashed).__getitem__
        self.find = regex.compile(pattern).findall
        # Two spaces in a row, or other white space after a space, need the pattern as a whole.
        self.plain = regex.compile(r" (?:\s|$)").search

    def split(self, text: str) -> bytes:
        return b"".join(map(self.tokens, self.find(text)))

    def __missing__(self, part: str) -> bytes:
        packed = self.split(" " + part)
        if len(part) < LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = packed
        return packed

    def encode(self, text: str, cut: bool = True) -> bytes:
        """The ids of a text; `cut` says that the pattern allows cutting before spaces."""
        if not cut or self.plain(text):
            return self.split(text)
        first, *rest = text.split(" ")
        return self.split(first) + b"".join(map(self.__getitem__, rest))


def encode_documents(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: `key, ids (array of int), decoded (binary)`.

    A null text is empty; an empty text has no ids. `ranks` is a vocabulary, at most some
    hundred thousand entries, and travels once per executor as a broadcast value. Rows are
    independent, so nothing is shuffled; other columns are ignored and repeated rows are
    encoded alike.
    """
    return run_encoder(docs, ranks, pattern, key, text, digests=False)


def run_encoder(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str, text: str, digests: bool
) -> DataFrame:
    names = list(ranks)
    cut = pattern == GPT_PATTERN
    shared = docs.sparkSession.sparkContext.broadcast(
        (PerfectHash(names, [ranks[k] for k in names]), {v: k for k, v in ranks.items()})
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, bytes_of = shared.value
        encoder = Encoder(hashed, pattern)
        for batch in slices(batches, 256):
            ids_out, decoded_out = [], []
            for value in batch.column("text"):
                packed = encoder.encode(value.as_py(), cut)
                ids = np.frombuffer(packed, dtype="<u4")
                decoded = b"".join(map(bytes_of.__getitem__, ids.tolist()))
                if digests:
                    ids_out.append((len(ids), hashlib.sha256(packed).hexdigest()))
                    decoded_out.append(hashlib.sha256(decoded).hexdigest())
                else:
                    ids_out.append(ids.astype(np.int32))
                    decoded_out.append(decoded)
            keys = batch.column("key")
            if digests:
                counts = pa.array([n for n, _ in ids_out], pa.int64())
                columns = [keys, counts, pa.array([d for _, d in ids_out]), pa.array(decoded_out)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
                )
            else:
                columns = [
                    keys, pa.array(ids_out, pa.list_(pa.int32())), pa.array(decoded_out, pa.binary())
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"])

    rows = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    rest = (
        "n_tokens long, ids_sha256 string, decoded_sha256 string"
        if digests
        else "ids array<int>, decoded binary"
    )
    return rows.mapInArrow(run, f"key {kind}, {rest}").withColumnRenamed("key", key)


def decode(ids: str, ranks: dict[bytes, int]):
    """A column of ids as the bytes they stand for; null for null."""
    bytes_of = {v: k for k, v in ranks.items()}

    @F.pandas_udf("binary")
    def joined(values):
        return values.map(lambda v: None if v is None else b"".join(bytes_of[i] for i in v))

    return joined(F.col(ids))


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and digests of its ids and of the decoded bytes."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    return run_encoder(docs, ranks, public_tokenizers.PATTERN, "doc_id", "text", digests=True)
