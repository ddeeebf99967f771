"""Removal of word passages that recur anywhere in the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from labelloom.llm.common import bound_batches, shuffle_parts, slices, stored, table
from labelloom.llm.jaccard import body_of
from labelloom.llm.registry import query

WINDOW = 35  # words of a passage
ANCHOR = 6  # words of an anchor; every window holds WINDOW - ANCHOR + 1 of them
SHARD_CHARS = 2_000_000  # of text per shard of passages, and per part of a large shard
CHUNK_WORDS = 40_000  # for which one automaton is compiled
PARTS = 3  # word groups that a phrase is spelt in
SLICE_BYTES = 1 << 20  # of text that are hashed at once, or one text
LANES = 8  # of eight bytes; longer words are hashed one by one
SALTS = 16
BASE = 0x9E3779B97F4A7C15  # of the windows' polynomial; odd, so that it has an inverse
HOT = 1000  # an anchor with more than this part of all occurrences is salted


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits, in place."""
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    return values


def powers(base: int, count: int) -> np.ndarray:
    """`base` to the powers 0 to `count`, modulo 2**64."""
    out = np.full(count + 1, base, dtype=np.uint64)
    out[0] = 1
    return out.cumprod(dtype=np.uint64)


def sliding(values: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    """The smallest or largest of each `span` values in a row, by doubling."""
    size, out = 1, values
    while 2 * size <= span:
        size, out = 2 * size, pick(out[:-size], out[size:])
    count = len(values) - span + 1
    return pick(out[:count], out[span - size : span - size + count])


class Words:
    """The words of some texts: where each lies in the texts' bytes, and where each text's words start.

    `at` ends with the number of words. An empty text has one empty word.
    """

    MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

    def __init__(self, bodies: pa.Array) -> None:
        self.bodies, bodies = bodies, bodies.cast(pa.large_binary())
        bounds = np.frombuffer(bodies.buffers()[1], np.int64)[bodies.offset :][: len(bodies) + 1]
        low, size = int(bounds[0]), int(bounds[-1] - bounds[0])
        # Eight more bytes, so that eight can be read from any place.
        self.data = np.zeros(size + 8, dtype=np.uint8)
        if size:
            self.data[:size] = np.frombuffer(bodies.buffers()[2], np.uint8, size, low)
        bounds = bounds - low
        spaces = np.flatnonzero(self.data[:size] == 32)
        self.filled = np.diff(bounds) > 0
        self.at = np.searchsorted(spaces, bounds) + np.arange(len(bounds))
        last = self.at[1:] - 1
        inner = np.ones(self.at[-1], dtype=bool)
        inner[last] = False
        self.ends = np.empty(self.at[-1], dtype=np.int64)
        self.ends[inner], self.ends[last] = spaces, bounds[1:]
        self.starts = np.empty_like(self.ends)
        self.starts[1:] = self.ends[:-1] + 1
        self.starts[self.at[:-1]] = bounds[:-1]

    def hashes(self) -> np.ndarray:
        """Each word's hash, from eight of its bytes after the other."""
        eight = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        lengths = self.ends - self.starts
        out = mix(lengths.astype(np.uint64) * np.uint64(BASE))
        for k in range(0, 8 * LANES, 8):
            some = np.flatnonzero(lengths > k)
            if not len(some):
                break
            lane = eight[self.starts[some] + k] & self.MASKS[np.minimum(lengths[some] - k, 8)]
            out[some] = mix(mix(out[some] ^ lane))
        for i in np.flatnonzero(lengths > 8 * LANES).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]])
        return out

    def inside(self, window: int) -> np.ndarray:
        """Of the places where a window could start, those whose window lies within one text."""
        count = max(int(self.at[-1]) - window + 1, 0)
        left = np.repeat(self.at[1:], np.diff(self.at))[:count] - np.arange(count)
        return left >= window

    def numbers(self) -> np.ndarray:
        """A number for each word, equal exactly where the words are."""
        return pc.split_pattern(self.bodies, " ").flatten().dictionary_encode().indices.to_numpy()


def group_numbers(numbers: np.ndarray, width: int) -> np.ndarray:
    """A number for each `width` words in a row, equal exactly where all of them are; by doubling."""
    codes, have = numbers.astype(np.int64), 1
    while have < width and len(codes):
        ahead = min(have, width - have)
        pairs = codes[:-ahead] * (int(codes.max()) + 1) + codes[ahead:]
        # Pairs of numbers are numbered anew, so that they stay small and exact.
        codes = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        have += ahead
    return codes


class Windows:
    """Hashes of windows, and the anchor of each: the smallest hash of its word groups.

    Equal windows have equal anchors, so only windows whose anchor recurs can recur. All hashes
    of one width are differences of running sums of a polynomial in the words' hashes. Texts are
    taken together; windows that reach from one into the next are left out.
    """

    def __init__(self, window: int) -> None:
        self.window, self.anchor = window, min(ANCHOR, window)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def mixed(self, hashes: np.ndarray, width: int) -> np.ndarray:
        size = len(hashes)
        if size < width:
            return np.empty(0, dtype=np.uint64)
        if size >= len(self.up):
            self.up, self.down = powers(BASE, 2 * size), powers(pow(BASE, -1, 2**64), 2 * size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(hashes * self.up[:size], out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * self.down[: size - width + 1])

    def groups(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The hash of each word group, the smallest of each window, and the groups in a window."""
        groups, span = self.mixed(hashes, self.anchor), self.window - self.anchor + 1
        return groups, sliding(groups, span, np.minimum), span

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The anchors, each as often as it is the smallest at another place, and their words."""
        inside = words.inside(self.window)
        if not inside.any():
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        groups, least, span = self.groups(words.hashes())
        around = sliding(np.pad(np.where(inside, least, 0), span - 1), span, np.maximum)
        found = np.flatnonzero(around == groups)
        return groups[found].view(np.int64), found


def by_bytes(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches, cut to at most SLICE_BYTES of text each, or one text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy().astype(np.int64))
        start = 0
        while start < batch.num_rows:
            most = SLICE_BYTES + (ends[start - 1] if start else 0)
            stop = max(int(np.searchsorted(ends, most, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def streams(codes: np.ndarray, step: int) -> tuple[list[str], int]:
    """The codes from each of the first `step` places on, every `step`-th, in digits; and the digits of each.

    The library looks through a node's edges one after the other, so there are sixteen symbols.
    """
    digits = max(-(-int(codes.max(initial=0)).bit_length() // 4), 1)
    shifts = np.arange(0, 4 * digits, 4)
    spelt = (codes[:, None] >> shifts & 15).astype(np.uint8) + np.uint8(ord("a"))
    return [spelt[first::step].tobytes().decode("ascii") for first in range(step)], digits


def located(
    owners: list[bytes], starts: list[int], bodies: list[str], recurring: np.ndarray, windows: Windows
) -> pa.RecordBatch:
    """`addr, first word, end` of all passages in the segments that are among the recurring ones.

    The recurring windows that occur in these segments become the phrases of an
    Aho-Corasick automaton, and the segments stream through it. A phrase is spelt in a few
    groups of words, numbered exactly, so that it is short; the segments stream once from
    each word that a group could start at. What is found is equal word for word.
    """
    words = Words(pa.array(bodies, pa.string()))
    size, count = windows.window, int(words.at[-1])
    parts = min(PARTS, size)
    step = size // parts
    inside = words.inside(size)
    phrases = np.empty(0, dtype=np.int64)
    if len(recurring) and inside.any():
        whole = windows.mixed(words.hashes(), size)
        near = np.minimum(np.searchsorted(recurring, whole), len(recurring) - 1)
        same = np.flatnonzero((recurring[near] == whole) & inside)
        phrases = same[np.unique(whole[same], return_index=True)[1]]
    depth = np.zeros(count + 1, dtype=np.int64)
    if len(phrases):
        spelt, digits = streams(group_numbers(words.numbers(), size - (parts - 1) * step), step)
        length = parts * digits
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for row, first in zip((phrases // step * digits).tolist(), (phrases % step).tolist()):
            automaton.add_word(spelt[first][row : row + length])
        automaton.make_automaton()
        for first, stream in enumerate(spelt):
            at = np.fromiter((end for end, _ in automaton.iter(stream)), dtype=np.int64) + 1 - length
            at = at[at % digits == 0] // digits * step + first
            at = at[inside[at]]
            depth[at] += 1  # no two phrases start at one place
            depth[at + size] -= 1
    # Runs of words that go, cut where a segment ends.
    gone = np.concatenate([[False], depth[:-1].cumsum() > 0, [False]])
    bound = np.zeros(count + 1, dtype=bool)
    bound[words.at] = True
    begin = np.flatnonzero(gone[1:] & (bound | ~gone[:-1]))
    end = np.flatnonzero(gone[:-1] & (bound | ~gone[1:]))
    of = np.searchsorted(words.at, begin, "right") - 1
    ahead = np.array(starts, dtype=np.int64)[of] - words.at[of]
    return pa.RecordBatch.from_arrays(
        [pa.array(owners, pa.binary()).take(pa.array(of)), pa.array(begin + ahead), pa.array(end + ahead)],
        ["addr", "first", "end"],
    )


def measured_texts(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """`key, sha, n_words, n_chars, anchors` of every row, with the digest of its words.

    The later steps read this again and again, and the texts only once more.
    """
    body = body_of(text)
    rows = docs.select(F.col(key).alias("key"), F.sha2(body, 256).alias("sha"), body.alias("body"))
    kinds = T.StructType(rows.schema.fields[:2])
    kinds.add("n_words", "long").add("n_chars", "long").add("anchors", T.ArrayType(T.LongType()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window)
        for batch in by_bytes(batches, "body"):
            words = Words(batch.column("body"))
            anchors, found = windows.places(words)
            lists = pa.ListArray.from_arrays(np.searchsorted(found, words.at).astype(np.int32), anchors)
            n_words = np.where(words.filled, np.diff(words.at), 0)
            n_chars = pc.utf8_length(batch.column("body")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("sha"), pa.array(n_words), n_chars, lists], kinds.names
            )

    return stored(rows.mapInArrow(measure, kinds), "measured")


def addr_of(sha: str | Column) -> Column:
    return F.unhex(F.substring(sha, 1, 32))


def recurring_texts(docs: DataFrame, measured: DataFrame, text: str) -> DataFrame:
    """Distinct texts that share an anchor with another place: `addr, body, anchors`.

    `addr` is half of the SHA-256 of the words. Each anchor has a shard, which comes from the
    smallest text that holds it, so the passages of one text stay together.
    """
    body = body_of(text)
    rows = docs.select(addr_of(F.sha2(body, 256)).alias("addr"), body.alias("body"))
    # A text with copies counts its anchors more often, which only adds candidates.
    spots = measured.select(F.explode("anchors").alias("anchor"), addr_of("sha").alias("addr"))
    counted = spots.groupBy("anchor").agg(F.count("*").alias("n"), F.min("addr").alias("owner"))
    total = measured.agg(F.sum("n_chars")).first()[0] or 0
    shards = max(-(-total // SHARD_CHARS), 1)
    again = stored(
        counted.filter("n > 1").select(
            "anchor", "n", F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int").alias("shard")
        ),
        "anchors",
    )
    # At most HOT anchors have more than one HOT-th of the occurrences: these few are salted.
    all_spots = again.agg(F.sum("n")).first()[0] or 0
    salts = F.when(F.col("n") * HOT > all_spots, SALTS).otherwise(1)
    often = again.select("anchor", salts.alias("salts")).filter("salts > 1")
    salt = F.pmod(F.xxhash64("addr"), F.coalesce("salts", F.lit(1))).cast("int")
    salted = spots.join(F.broadcast(often), "anchor", "left").select("anchor", "addr", salt.alias("salt"))
    again = again.select("anchor", "shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    # Anchors of one text per text: as many as a part of its words.
    lists = salted.join(again, ["anchor", "salt"]).groupBy("addr").agg(
        F.collect_set(F.struct("anchor", "shard")).alias("anchors")
    )
    texts = rows.groupBy("addr").agg(F.first("body").alias("body"))
    return stored(texts.join(lists, "addr"), "recurring")


def changed_texts(docs: DataFrame, measured: DataFrame, text: str, window: int) -> DataFrame:
    """`addr, n_removed, kept` of every distinct text that loses words."""
    spark = docs.sparkSession
    texts = recurring_texts(docs, measured, text)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window)
        for batch in by_bytes(batches, "body"):
            words = Words(batch.column("body"))
            starts = np.flatnonzero(words.inside(window))
            if not len(starts):
                continue
            hashes = words.hashes()
            # Runs of windows with one anchor; an anchor has one shard, or none if it comes once.
            least = windows.groups(hashes)[1][starts].view(np.int64)
            owners = np.searchsorted(words.at, starts, "right") - 1
            first = np.append(0, np.flatnonzero(np.diff(least) | np.diff(owners)) + 1)
            known, shard_of = (batch.column("anchors").flatten().field(i).to_numpy() for i in (0, 1))
            known, places = np.unique(known, return_index=True)
            near = np.minimum(np.searchsorted(known, least[first]), len(known) - 1)
            shards = np.where(known[near] == least[first], shard_of[places][near], -1)
            # Runs of these that go to one shard.
            turns = np.append(0, np.flatnonzero(np.diff(shards) | np.diff(owners[first])) + 1)
            shards, first = shards[turns], first[turns]
            counts = np.diff(np.append(first, len(starts)))
            whole = windows.mixed(hashes, window)[starts].view(np.int64)[np.repeat(shards >= 0, counts)]
            shards, first, counts = (x[shards >= 0] for x in (shards, first, counts))
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), whole)
            a, owners = starts[first], owners[first]
            ends = words.ends[a + counts + window - 2].tolist()
            data = words.data.tobytes()
            pieces = [data[i:j] for i, j in zip(words.starts[a].tolist(), ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int32()), batch.column("addr").take(pa.array(owners)),
                    pa.array(a - words.at[owners]), pa.array(pieces, pa.binary()).cast(pa.string()), lists,
                ],
                ["shard", "addr", "start", "body", "windows"],
            )

    candidates = texts.select("addr", "body", "anchors").mapInArrow(
        segments, "shard int, addr binary, start long, body string, windows array<long>"
    )
    routed = stored(candidates, "segments")
    # A window is counted within its shard, which its anchor fixes.
    counted = routed.select("shard", F.explode("windows").alias("window")).groupBy("shard", "window")
    recurring = stored(counted.agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "windows")
    sizes = routed.groupBy("shard").agg(
        F.ceil(F.sum(F.length("body")) / SHARD_CHARS).cast("int").alias("parts")
    )
    to_part = F.pmod(F.xxhash64("addr"), F.col("parts")).cast("int")
    pieces = routed.join(sizes, "shard").select(
        "shard", to_part.alias("part"), F.lit(None).cast("long").alias("window"), "addr", "start", "body"
    )
    phrases = recurring.join(sizes, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "window",
        F.lit(None).cast("binary").alias("addr"), F.lit(None).cast("long").alias("start"),
        F.lit(None).cast("string").alias("body"),
    )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window)
        place, known, waiting, size, sorted_windows = None, [], [], 0, None

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal sorted_windows
            if waiting:
                if sorted_windows is None:
                    sorted_windows = np.sort(np.concatenate([np.empty(0, np.uint64), *known]))
                yield located(*zip(*waiting), sorted_windows, windows)

        for batch in slices(batches, 2048):
            shards, parts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "part"))
            turns = np.flatnonzero((np.diff(shards) != 0) | (np.diff(parts) != 0)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                rows = batch.slice(a, b - a)
                if (shards[a], parts[a]) != place:
                    yield from closed()
                    place, known, waiting, size = (shards[a], parts[a]), [], [], 0
                    sorted_windows = None
                # Within a part all windows come before the texts.
                ahead = rows.column("addr").null_count
                if ahead:
                    known.append(rows.column("window").slice(0, ahead).to_numpy().view(np.uint64))
                texts = [rows.column(c).slice(ahead).to_pylist() for c in ("addr", "start", "body")]
                for owner, start, body in zip(*texts):
                    waiting.append((owner, start, body))
                    size += body.count(" ") + 1
                    if size >= CHUNK_WORDS:
                        yield from closed()
                        waiting, size = [], 0
        yield from closed()

    places = (
        phrases.unionByName(pieces)
        .repartition(shuffle_parts(spark), "shard", "part")
        .sortWithinPartitions("shard", "part", F.col("addr").isNotNull())
        .mapInArrow(locate, "addr binary, first long, end long")
    )
    spans = places.groupBy("addr").agg(F.collect_list(F.struct("first", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            removed, kept = [], []
            for row in batch.to_pylist():
                words = row["body"].split(" ")
                gone = np.zeros(len(words), dtype=bool)
                for span in row["spans"]:
                    gone[span["first"] : span["end"]] = True
                removed.append(int(gone.sum()))
                kept.append(" ".join(w for w, g in zip(words, gone.tolist()) if not g))
            yield pa.RecordBatch.from_arrays(
                [batch.column("addr"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["addr", "n_removed", "kept"],
            )

    return texts.select("addr", "body").join(spans, "addr").mapInArrow(
        cut, "addr binary, n_removed long, kept string"
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, window: int = WINDOW,
    digests: bool = False,
) -> DataFrame:
    """One row per row of `docs`: `key, n_words, n_removed, kept` (or `kept_sha256`).

    A word goes when a window of `window` consecutive words covers it whose word sequence
    also starts at another place of the table, the same text included. `kept` joins the
    words that stay by one space. Words are separated by white space and compared unchanged; a null or empty
    text has none; texts shorter than a window stay whole. Repeated rows are texts that recur.
    An empty table gives no rows; null keys and other columns don't matter.

    Windows are judged by 64-bit hashes within a shard, then found again word by word. Texts are
    read twice (three times without `digests`) and shuffled once, those that share an anchor
    once more; the rest moves in passages.
    """
    bound_batches(docs.sparkSession)
    measured = measured_texts(docs, key, text, window)
    if digests:
        rows = measured.select("key", "sha", "n_words")
    else:
        body = body_of(text)
        n_words = F.when(body == "", 0).otherwise(F.size(F.split(body, " "))).cast("long")
        rows = docs.select(
            F.col(key).alias("key"), F.sha2(body, 256).alias("sha"), n_words.alias("n_words"), body.alias("body")
        )
    rows = rows.withColumns(
        {"addr": addr_of("sha"), "salt": F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")}
    )
    changed = changed_texts(docs, measured, text, window)
    if digests:
        changed = changed.select("addr", "n_removed", F.sha2("kept", 256).alias("after"))
    else:
        changed = changed.withColumnRenamed("kept", "after")
    changed = stored(changed, "changed")
    again = rows.groupBy("addr").agg(F.count("*").alias("copies"), F.first("n_words").alias("words"))
    # Every window of a text that has a copy starts elsewhere too.
    gone = again.filter((F.col("copies") > 1) & (F.col("words") >= window)).select(
        "addr", F.col("words").alias("n_removed"),
        (F.sha2(F.lit(""), 256) if digests else F.lit("")).alias("after"),
    )
    news = gone.unionByName(changed.join(gone, "addr", "left_anti"))
    salted = news.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.join(salted, ["addr", "salt"], "left")
    same = F.col("sha") if digests else F.col("body")
    return joined.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("after", same).alias("kept_sha256" if digests else "kept"),
    )


@query(
    sql=r"""
    WITH t AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
        FROM documents
    ), win AS (
        SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM t WHERE len(ws) >= 35)
    ), rec AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
    hit AS (SELECT doc_id, i FROM win WHERE s IN (SELECT s FROM rec)),
    word AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM t),
    marked AS (
        SELECT word.doc_id, w, p, max(hit.i) OVER (
            PARTITION BY word.doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
        FROM word LEFT JOIN hit ON word.doc_id = hit.doc_id AND p = i
    ), done AS (
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
               coalesce(string_agg(w, ' ' ORDER BY p) FILTER (NOT gone), '') AS kept
        FROM marked GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM t LEFT JOIN done USING (doc_id)
    """
)
def op8_passage_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, how many recurring passages took, and a digest of the rest."""
    return remove_repeats(table(spark, sf_dir, "documents"), digests=True)
