"""Similarity join on word shingles: MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.llm.common import SPACE, shuffle_parts, slices, stored, table, whole
from labelloom.llm.components import components
from labelloom.llm.registry import query

WORDS = 5  # of a shingle
SIMILARITY = 0.8
# A pair at the threshold shares one of the bands with probability 1 - (1 - 0.8**4)**28, all but 4e-7.
BANDS, ROWS = 28, 4
TOLERANCE = 1e-6  # a pair goes when reaching the threshold is less likely than this
STEP = 16  # MinHash values between two looks at the posterior
BLOCK_DOCS, BLOCK_WORDS = 2048, 500_000  # of a bucket that are compared at once
SALTS = 16
SEED = 11
REMEMBERED = 250_000  # words a worker remembers; bounds memory, not results


def body_of(text: str | Column) -> Column:
    """Words joined by one space; null and white space alone are empty."""
    return F.trim(F.regexp_replace(whole(text), SPACE, " "))


def node_of(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


class WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class MinHash:
    """Signatures of shingle sets: the smallest of BANDS * ROWS linear hashes, high halves."""

    def __init__(self, values: int = BANDS * ROWS, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        self.mul = draw.integers(0, 2**63, values, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.add = draw.integers(0, 2**63, values, dtype=np.uint64)[:, None]
        self.place = draw.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.words = WordHash()

    def shingles(self, words: list[str]) -> np.ndarray:
        hashed = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(WORDS, len(words))
        mixed = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            mixed += hashed[k : len(words) - width + 1 + k] * self.place[k]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ (mixed >> np.uint64(29))

    def signature(self, words: list[str]) -> np.ndarray:
        shingles = self.shingles(words)
        least = np.full(len(self.mul), np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(shingles), 2048):  # keeps the table of hashes in the cache
            part = shingles[None, start : start + 2048]
            np.minimum(least, (part * self.mul + self.add).min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def fewest_matches(seen: int, threshold: float, tolerance: float) -> int:
    """Matches among `seen` values under which the posterior falls below the tolerance.

    With a uniform prior, the chance that the similarity reaches t after m of n matches is
    that of at most m successes in n + 1 trials of chance t.
    """
    total, m = 0.0, 0
    while m <= seen:
        total += math.comb(seen + 1, m) * threshold**m * (1 - threshold) ** (seen + 1 - m)
        if total >= tolerance:
            return m
        m += 1
    return m


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sets of shingles as sorted numbers, equal exactly where the words are equal."""
    numbers: dict[str, int] = {}
    lengths, flat, short = [], [], {}
    for text in texts:
        words = text.split(" ")
        flat.append([numbers.setdefault(w, len(numbers)) for w in words])
        lengths.append(len(words))
    words = np.array([w for ws in flat for w in ws], dtype=np.int64)
    codes = words
    for k in range(1, WORDS):
        if len(codes) <= 1:
            break
        # Pairs of numbers are numbered anew, so that they stay small and exact.
        _, codes = np.unique(codes[:-1] * len(numbers) + words[k:], return_inverse=True)
        codes = codes.astype(np.int64)
    sets, start = [], 0
    for length, ws in zip(lengths, flat):
        if length < WORDS:
            code = short.setdefault(tuple(ws), -1 - len(short))
            sets.append(np.array([code], dtype=np.int64))
        else:
            sets.append(np.unique(codes[start : start + length - WORDS + 1]))
        start += length
    return sets


class Block:
    """The documents of one or two parts of a bucket, compared with each other."""

    def __init__(self, bucket: int, low: int, high: int, threshold: float, tolerance: float) -> None:
        self.bucket, self.low, self.high = bucket, low, high
        self.threshold, self.tolerance = threshold, tolerance
        self.rows: list[tuple] = []

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that outlast the pruning: each pair once, in the first bucket that it shares."""
        part = np.array([r[1] for r in self.rows])
        first = np.flatnonzero(part == self.low)
        second = first if self.low == self.high else np.flatnonzero(part == self.high)
        signs = np.array([r[4] for r in self.rows], dtype=np.int32)
        open_pairs = np.ones((len(first), len(second)), dtype=bool)
        if self.low == self.high:
            open_pairs = np.triu(open_pairs, 1)
        earlier: dict[int, list[int]] = {}
        for i, row in enumerate(self.rows):
            for home in row[5]:
                if home < self.bucket:
                    earlier.setdefault(home, []).append(i)
        for members in earlier.values():
            a = np.searchsorted(first, np.intersect1d(first, members, assume_unique=True))
            b = np.searchsorted(second, np.intersect1d(second, members, assume_unique=True))
            open_pairs[np.ix_(a, b)] = False
        matches = np.zeros(open_pairs.shape, dtype=np.uint8)
        for h in range(STEP):
            matches += signs[first, h][:, None] == signs[second, h]
        open_pairs &= matches >= fewest_matches(STEP, self.threshold, self.tolerance)
        i, j = np.nonzero(open_pairs)
        count = matches[i, j].astype(np.int32)
        i, j = first[i], second[j]
        for seen in range(2 * STEP, signs.shape[1] + 1, STEP):
            for h in range(seen - STEP, seen):
                count += signs[i, h] == signs[j, h]
            stay = count >= fewest_matches(seen, self.threshold, self.tolerance)
            i, j, count = i[stay], j[stay], count[stay]
        return i, j

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose Jaccard similarity, counted on whole shingle sets, reaches the threshold."""
        i, j = self.candidates()
        if not len(i):
            return i, j
        used = np.unique(np.concatenate([i, j]))
        sets = dict(zip(used.tolist(), shingle_sets([self.rows[u][3] for u in used])))
        values = np.unique(np.concatenate(list(sets.values())))
        sets = {u: np.searchsorted(values, s) for u, s in sets.items()}
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        good = np.zeros(len(i), dtype=bool)
        mark = np.zeros(len(values), dtype=bool)
        edges = np.flatnonzero(np.diff(i)) + 1
        for a, b in pairwise([0, *edges.tolist(), len(i)]):
            own = sets[int(i[a])]
            mark[own] = True
            for at in range(a, b):
                other = sets[int(j[at])]
                shared = np.count_nonzero(mark[other])
                good[at] = shared >= self.threshold * (len(own) + len(other) - shared) - 1e-9
            mark[own] = False
        return i[good], j[good]

    def result(self) -> list[tuple[bytes, int, bytes]]:
        """`node, links, root` of each document with a link in this block.

        Links count documents, copies included; the roots join the block's links
        to groups, so that no pair has to leave the block.
        """
        i, j = self.links()
        if not len(i):
            return []
        weight = np.array([r[2] for r in self.rows], dtype=np.int64)
        count = np.zeros(len(self.rows), dtype=np.int64)
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        parent = list(range(len(self.rows)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(i.tolist(), j.tolist()):
            a, b = root(a), root(b)
            if a != b:
                if self.rows[b][0] < self.rows[a][0]:
                    a, b = b, a
                parent[b] = a
        return [
            (self.rows[x][0], int(count[x]), self.rows[root(x)][0]) for x in np.flatnonzero(count)
        ]


def compare_blocks(threshold: float, tolerance: float):
    """Rows sorted by block to `node, links, root`; one block is in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None

        def closed() -> Iterator[pa.RecordBatch]:
            found = block.result() if block and len(block.rows) > 1 else []
            if found:
                node, links, root = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())],
                    ["node", "links", "root"],
                )

        for batch in slices(batches, 512):
            for row in batch.to_pylist():
                name = (row["bucket"], row["low"], row["high"])
                if block is None or (block.bucket, block.low, block.high) != name:
                    yield from closed()
                    block = Block(*name, threshold, tolerance)
                block.rows.append(
                    (row["node"], row["part"], row["copies"], row["body"], row["sign"], row["homes"])
                )
        yield from closed()

    return run


def signatures(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per distinct word sequence: `node, copies, low, words, sign`."""
    body = body_of(text)
    rows = docs.select(F.col(key).alias("key"), body.alias("body"), node_of(body).alias("node"))
    kind = rows.schema["key"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = MinHash()
        for batch in slices(batches, 512):
            counts, signs = [], []
            for value in batch.column("body"):
                words = value.as_py().split(" ") if value.as_py() else []
                counts.append(len(words))
                signs.append(hashes.signature(words) if words else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("node"),
                    pa.array(counts, pa.int64()), pa.array(signs, pa.list_(pa.int32())),
                ],
                ["key", "node", "words", "sign"],
            )

    signed = rows.mapInArrow(sign, f"key {kind}, node binary, words long, sign array<int>")
    return signed.groupBy("node").agg(
        F.count("*").alias("copies"), F.min("key").alias("low"),
        F.first("words").alias("words"), F.first("sign").alias("sign"),
    )


def linked(
    docs: DataFrame, key: str, text: str, threshold: float, tolerance: float
) -> tuple[DataFrame, DataFrame]:
    """Distinct texts as `node, copies, low`, and `node, links, root` from every block."""
    spark = docs.sparkSession
    texts = stored(signatures(docs, text, key), "signatures")
    bands = [
        F.xxhash64(F.lit(b), *[F.get("sign", F.lit(ROWS * b + r)) for r in range(ROWS)])
        for b in range(BANDS)
    ]
    members = texts.filter("words > 0").select("node", "words", F.explode(F.array(*bands)).alias("bucket"))
    members = members.repartition("bucket")
    buckets = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("words").alias("words"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mix"),
        F.min("node").alias("least"), F.max("node").alias("most"),
    )
    # Copies of one text in near copies fall into many buckets together; one of them will do.
    several = buckets.filter("n > 1").groupBy("n", "mix", "least", "most").agg(
        F.min("bucket").alias("bucket"), F.first("words").alias("words")
    )
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("words") / BLOCK_WORDS))
    chosen = several.select("bucket", parts.cast("int").alias("parts"))
    places = stored(members.join(chosen, "bucket").select("bucket", "node", "parts"), "places")
    homes = places.groupBy("node").agg(F.collect_list("bucket").alias("homes"))  # at most BANDS
    body = body_of(text)
    bodies = docs.select(node_of(body).alias("node"), body.alias("body"))
    bodies = bodies.groupBy("node").agg(F.first("body").alias("body"))
    wanted = homes.join(texts.select("node", "copies", "sign"), "node").join(bodies, "node")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    visits = (
        places.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "bucket", "node", "part",
            F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        )
    )
    order = ["bucket", "low", "high"]
    found = (
        visits.join(wanted, "node")
        .repartition(shuffle_parts(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(compare_blocks(threshold, tolerance), "node binary, links long, root binary")
    )
    return texts.select("node", "copies", "low"), stored(found, "links")


def jaccard_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    threshold: float = SIMILARITY, tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per row of `docs`: `key, class_id, n_links, kept`.

    Two documents are linked when the sets of their five-word shingles have a Jaccard
    similarity of at least `threshold`. `n_links` counts a document's links, `class_id` is
    the smallest key in its group of documents that are linked directly or over others, and one
    document of each group is `kept`, one with that key.

    Words are separated by white space and compared unchanged; a text of fewer than five words is
    one shingle, a null or empty one has none and links to nothing but is kept. Documents of equal words
    are one text throughout and meet no other copy; a null key sorts last; of repeated rows
    one is kept. An empty table gives no rows; other columns are ignored.

    A band of equal MinHash values makes two texts a candidate pair. A bucket of many texts is cut
    into parts, and every two parts are compared in a task of their own. There, further MinHash
    values are compared step by step, a pair goes when its posterior chance of reaching the threshold
    falls below `tolerance`, and the rest are verified on their whole shingle sets. Only
    counts and the roots of groups leave a task, never pairs.
    """
    rows = classes(docs, key, text, threshold, tolerance)
    return rows.select(F.col("key").alias(key), "class_id", "n_links", "kept")


def classes(
    docs: DataFrame, key: str, text: str, threshold: float, tolerance: float
) -> DataFrame:
    """`jaccard_classes` as `key, node, class_id, n_links, kept`."""
    texts, found = linked(docs, key, text, threshold, tolerance)
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    near = groups.join(counts, "node").join(texts, "node")
    keeper = near.groupBy("component").agg(
        F.min(F.struct(F.col("low").isNull().alias("none"), "low", "node")).alias("keeper")
    )
    near = near.join(keeper, "component").select(
        "node", "copies", "low", F.col("keeper.low").alias("class_id"), F.col("keeper.node").alias("keeper"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
    )
    empty = node_of(F.lit(""))
    alone = texts.join(found.select("node").distinct(), "node", "left_anti").select(
        "node", "copies", "low", F.col("low").alias("class_id"), F.col("node").alias("keeper"),
        (F.col("copies") - 1).alias("n_links"),
    )
    # A text of one document knows its key, and so the salt; others meet theirs in SALTS places.
    salt = F.pmod(F.xxhash64("low"), F.lit(SALTS)).cast("int")
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    info = near.unionByName(alone).withColumn(
        "salt", F.explode(F.when(F.col("copies") > 1, every).otherwise(F.array(salt)))
    )
    rows = docs.select(F.col(key).alias("key"), node_of(body_of(text)).alias("node"))
    rows = rows.groupBy("key", "node").agg(F.count("*").alias("again")).withColumn(
        "salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    )
    out = rows.join(info, ["node", "salt"]).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("again").cast("int")))
    )
    first = F.col("key").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("keeper"))
    nothing = F.col("node") == empty  # texts without words stand alone
    return out.select(
        "key", "node",
        F.when(nothing, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(nothing, 0).otherwise(F.col("n_links")).alias("n_links"),
        ((first | nothing) & (F.col("copy") == 1)).alias("kept"),
    )


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that `jaccard_classes` keeps, with all their columns.

    Of repeated rows (equal key and words) the smallest by all columns stays.
    """
    marks = classes(docs, key, text, SIMILARITY, TOLERANCE).filter("kept")
    marks = marks.select(F.col("key").alias("__key"), F.col("node").alias("__mark"))
    full = docs.withColumn("__node", node_of(body_of(text)))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__node") == F.col("__mark"))
    left = full.join(marks, same, "left_semi")
    rows = docs.select(F.col(key).alias("key"), node_of(body_of(text)).alias("node"))
    if rows.groupBy("key", "node").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return left.drop("__node")
    row = F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("row")
    return left.groupBy(F.col(key).alias("__key"), "__node").agg(row).select("row.*")


@query(
    sql=r"""
    WITH RECURSIVE t AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS shingle
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM t WHERE len(ws) > 0)
    ), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), link AS (
        SELECT x, y FROM pairs JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
        WHERE k >= 0.8 * (a.n + b.n - k) - 1e-9
    ), reach(x, y) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
    ), class AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x)
    SELECT doc_id, class_id, (SELECT count(*) FROM link WHERE x = doc_id) AS n_links, doc_id = class_id AS kept
    FROM class
    """
)
def op3_bayesian_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group and number of links."""
    return jaccard_classes(table(spark, sf_dir, "documents"))
