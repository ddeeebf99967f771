"""Nearest neighbours by shifted Hilbert curves over projected vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from labelloom.llm.common import shuffle_parts, slices, stored, table
from labelloom.llm.registry import query

CURVES = 16
DIMENSIONS = 8  # of a projection
BITS = 6  # of a coordinate; DIMENSIONS * BITS must fit 63 bits
BLOCK = 1024  # rows of a curve that are searched at once
# Share of all rows that a query's window takes on each side of it, on every curve. Nearness in
# many dimensions is spread thin over any curve, so windows of a fixed size would lose
# recall as the table grows.
REACH = 0.03
SAMPLE = 2048  # vectors that fix the scale of the projections; the index holds every row
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of cells `(rows, dimensions)` with coordinates below 2**bits.

    Gray-code undoing of the coordinates from the highest bit on, then interleaved bits.
    """
    axes = cells.T.astype(np.uint64)
    count = len(axes)
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for axis in range(count):
            flip = (axes[axis] >> np.uint64(bit)) & one == one
            swap = np.where(flip, np.uint64(0), (axes[0] ^ axes[axis]) & low)
            axes[0] = np.where(flip, axes[0] ^ low, axes[0] ^ swap)
            axes[axis] ^= swap
    for axis in range(1, count):
        axes[axis] ^= axes[axis - 1]
    turn = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        odd = (axes[-1] >> np.uint64(bit)) & one == one
        turn = np.where(odd, turn ^ np.uint64((1 << bit) - 1), turn)
    axes ^= turn
    keys = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(count):
            keys = (keys << one) | ((axes[axis] >> np.uint64(bit)) & one)
    return keys.astype(np.int64)


class Curves:
    """Random rotations, shifts and the scale of each curve."""

    def __init__(self, sample: np.ndarray, curves: int, dimensions: int, bits: int, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.bits, width = bits, sample.shape[1]
        self.frames = []
        for _ in range(curves):
            square = draw.normal(size=(width, max(min(dimensions, width), 1)))
            axes, _ = np.linalg.qr(square)
            seen = sample @ axes
            spread = max(float(seen.std()), 1e-12)
            low = seen.min(axis=0) - draw.random(axes.shape[1]) * spread
            scale = ((1 << bits) - 1) / max(float((seen.max(axis=0) + spread - low).max()), 1e-12)
            self.frames.append((axes, low, scale))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Keys `(rows, curves)`; what lies outside the scale goes to its edge."""
        top = (1 << self.bits) - 1
        columns = []
        for axes, low, scale in self.frames:
            cells = np.clip(np.floor((vectors @ axes - low) * scale), 0, top)
            columns.append(hilbert_keys(cells, self.bits))
        return np.stack(columns, axis=1)


def sound(vector: str) -> Column:
    """True for vectors that can be compared: not null, not zero, all components finite."""
    value = F.col(vector)
    bad = F.exists(
        value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return F.coalesce(~bad & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def search_blocks(k: int):
    """Reranks: rows sorted by block, a block's vectors before the queries that visit it.

    One block is in memory, its queries stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, BLOCK):
            curve, number = (batch.column(c).to_numpy() for c in ("curve", "block"))
            visits = batch.column("visit").to_numpy(zero_copy_only=False)
            ids, vectors = batch.column("id").to_numpy(), matrix(batch.column("vector"))
            edges = np.flatnonzero((np.diff(curve) != 0) | (np.diff(number) != 0)) + 1
            bounds = [0, *edges.tolist(), len(ids)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if (curve[a], number[a]) != block:
                    block, held = (curve[a], number[a]), []
                rows, asks = ~visits[a:b], visits[a:b]
                if rows.any():
                    held.append((ids[a:b][rows], vectors[a:b][rows]))
                if asks.any() and held:
                    held = [tuple(map(np.concatenate, zip(*held)))]
                    own, there = ids[a:b][asks], vectors[a:b][asks]
                    asked, found, score = [], [], []
                    for q, vector in zip(own, there):
                        apart = np.sqrt(((held[0][1] - vector) ** 2).sum(axis=1))
                        others = np.flatnonzero(held[0][0] != q)
                        best = others[np.lexsort((held[0][0][others], apart[others]))[:k]]
                        asked.append(np.full(len(best), q))
                        found.append(held[0][0][best])
                        score.append(apart[best])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (asked, found, score)],
                        ["query_id", "vec_id", "score"],
                    )

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    curves: int = CURVES,
    reach: float = REACH,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """The k nearest rows found for each query: `query_id, rank, vec_id, score`.

    Every vector gets its place on `curves` Hilbert curves, each over its own random
    projection and shift. Spark orders each curve by range partitions; a query is compared,
    in double precision, with all rows of the blocks within `reach` of its own on every
    curve, and the best of all windows are merged. Ties go to the smaller key.

    Rows with a null key, and vectors that are null, empty, zero or hold null or non-finite
    components, take no part, nor do vectors of another length than most. A key that is
    repeated counts once per different vector, at its smallest distance. Of equal vectors only
    the k + 1 smallest keys are candidates: the others cannot be among the nearest. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(sound(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        is_query.alias("asks"),
    )
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    width = widths.orderBy(F.desc("n"), "width").first()
    schema = "query_id long, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], schema).selectExpr(
            "query_id", "cast(1 as int) AS rank", "vec_id", "score"
        )
    rows = rows.filter(F.size("vector") == width["width"])
    alike = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("nth", F.dense_rank().over(alike)).filter(F.col("nth") <= k + 1)
    members = first.select("id", "vector", F.lit(False).alias("visit")).unionByName(
        rows.filter("asks").select("id", "vector", F.lit(True).alias("visit"))
    )
    # The smallest hashes: the same bounded sample every time.
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    frames = Curves(matrix(sample.column(0).combine_chunks()), curves, DIMENSIONS, BITS, seed)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys = frames.keys(matrix(batch.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))],
                ["id", "vector", "visit", "keys"],
            )

    kind = "id long, vector array<double>, visit boolean"
    indexed = stored(members.mapInArrow(index, f"{kind}, keys array<long>"), "curve-keys")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, counts = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve = batch.column("curve").to_numpy()
            place = np.empty(len(curve), dtype=np.int64)
            for c in np.unique(curve):
                here = np.flatnonzero(curve == c)
                place[here] = counts.get(c, 0) + np.arange(len(here))
                counts[c] = counts.get(c, 0) + len(here)
            parts = pa.array(np.full(len(curve), part, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, parts, pa.array(place)], ["curve", "id", "visit", "part", "place"]
            )

    spots = indexed.select("id", "visit", F.posexplode("keys").alias("curve", "at"))
    order = ["curve", "at", "id", "visit"]
    ranged = spots.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    placed = stored(
        ranged.select("curve", "id", "visit").mapInArrow(
            number, "curve int, id long, visit boolean, part int, place long"
        ),
        "curve-places",
    )
    # At most one row per curve and partition.
    sizes = placed.groupBy("curve", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "curve", "part",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("curve")).alias("length"),
    )
    located = placed.join(F.broadcast(starts), ["curve", "part"]).select(
        "curve", "id", "visit",
        F.floor((F.col("start") + F.col("place")) / block).cast("int").alias("block"),
        F.floor((F.col("length") - 1) / block).cast("int").alias("last"),
        F.greatest(F.ceil(F.col("length") * reach / block), F.lit(1)).cast("int").alias("side"),
    )
    windows = located.filter("visit").withColumn(
        "block",
        F.explode(
            F.sequence(
                F.greatest(F.col("block") - F.col("side"), F.lit(0)),
                F.least(F.col("block") + F.col("side"), F.col("last")),
            )
        ),
    )
    visits = located.filter("NOT visit").unionByName(windows).select("curve", "block", "id", "visit")
    # A key with several vectors brings each of them.
    shipped = visits.join(indexed.select("id", "vector", "visit"), ["id", "visit"])
    found = (
        shipped.select("curve", "block", "visit", "id", "vector")
        .repartition(shuffle_parts(spark), "curve", "block")
        .sortWithinPartitions("curve", "block", "visit")
        .mapInArrow(search_blocks(k), schema)
    )
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        best.withColumn("rank", rank.cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query()
def op9_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
