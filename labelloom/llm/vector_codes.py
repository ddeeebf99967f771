"""Product codes of vectors: integer k-means per part, with balls that bound the candidates."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from labelloom.llm.common import slices, stored, table
from labelloom.llm.registry import query
from labelloom.plans.lookup import lookup_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BATCH_ROWS = 8192


def sound(vector: str) -> Column:
    """True for a vector that is not null and has finite components only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return F.coalesce(F.forall(F.col(vector), finite), F.lit(False))


def integers(vector: pa.Array, width: int) -> np.ndarray:
    """The scaled components, floored: a row per vector.

    A squared distance must fit a 64-bit integer, as the results do; components too large for
    that end the run with an error, rather than giving a wrong code.
    """
    values = np.floor(np.asarray(vector.flatten(), dtype=np.float64) * SCALE).reshape(-1, width)
    limit = 2.0 ** ((61 - math.ceil(math.log2(max(width, 1)))) // 2)
    if values.size and np.abs(values).max() >= limit:
        raise OverflowError(f"components beyond {limit / SCALE:g} have squared distances over 64 bits")
    return values.astype(np.int64)


@dataclass(frozen=True)
class Balls:
    """The codebooks, `(part, entry, component)`, with what is known of the entries' balls.

    An entry's ball is its centre and the radius that holds all parts last assigned to it.
    The neighbours of an entry are the entries nearer than twice its radius: no other can be
    nearest to a part of the ball. They are ordered by distance, and half the distance to each is the inner
    edge of a ring: a part within the first edge is in the stable core, one in the
    m-th ring has the first m neighbours as its only candidates.
    """

    books: np.ndarray
    order: np.ndarray  # (part, entry, neighbour): entries by distance, the entry itself first
    edges: np.ndarray  # (part, entry, neighbour): their squared distances; none beyond the ball

    @classmethod
    def around(cls, books: np.ndarray, radii: np.ndarray | None = None) -> Balls:
        """`radii` are upper bounds, whole numbers; without them every entry is a neighbour."""
        apart = ((books[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        entries = np.arange(books.shape[1])
        apart[:, entries, entries] = -1  # the entry itself comes first, also among equal entries
        order = np.argsort(apart, axis=2, kind="stable")
        edges = np.take_along_axis(apart, order, axis=2)
        if radii is not None:
            edges = np.where(edges <= 4 * radii[:, :, None] ** 2, edges, np.iinfo(np.int64).max)
        return cls(books, order, edges)

    def nearest(self, part: int, rows: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row and its squared distance, ties to the lower entry.

        `start` is the ball that each row is in. Rows are taken by ring: the m-th step looks at
        the m-th neighbour, for the rows that lie in a ring beyond its edge.
        """
        book = self.books[part]
        own = ((rows - book[start]) ** 2).sum(axis=1)
        best, near = start.copy(), own.copy()
        # A tie needs d(centre, other) = 2 d(row, centre) at most, so the edge itself counts.
        reach = (self.edges[part][start] <= 4 * own[:, None]).sum(axis=1)
        active = np.argsort(-reach, kind="stable")
        for step in range(1, int(reach.max(initial=1))):
            active = active[: int(np.searchsorted(-reach[active], -step, side="left"))]
            other = self.order[part][start[active], step]
            far = ((rows[active] - book[other]) ** 2).sum(axis=1)
            closer = (far < near[active]) | ((far == near[active]) & (other < best[active]))
            moved = active[closer]
            best[moved], near[moved] = other[closer], far[closer]
        return best, near


def assigned(rows: DataFrame, balls: Balls, parts: int, width: int, last: bool = False) -> DataFrame:
    """The rows with new `code` and `error`, stored, and per task one row of `sums`.

    `sums` holds, for every part and entry, the component sums, the number of members and
    the largest squared distance of a member: a number of values set by the codebooks.
    The last pass leaves the vectors out.
    """
    entries, span = balls.books.shape[1], width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, span + 2), dtype=np.int64)
        empty = True
        for batch in slices(batches, BATCH_ROWS):
            if not batch.num_rows:
                continue
            empty = False
            values = integers(batch.column("vector"), width)
            before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            code, error = np.empty_like(before), np.zeros(len(values), dtype=np.int64)
            for part in range(parts):
                own = values[:, part * span : (part + 1) * span]
                best, near = balls.nearest(part, own, before[:, part].astype(np.int64))
                code[:, part], error = best, error + near
                for component in range(span):
                    np.add.at(sums[part, :, component], best, own[:, component])
                sums[part, :, span] += np.bincount(best, minlength=entries)
                np.maximum.at(sums[part, :, span + 1], best, near)
            codes = pa.array([row.tobytes() for row in code], pa.binary())
            vectors = pa.nulls(len(code), kind) if last else batch.column("vector")
            values = [batch.column("id"), batch.column("label"), vectors, codes, pa.array(error)]
            yield pa.RecordBatch.from_arrays([*values, pa.nulls(len(code), pa.list_(pa.int64()))], names)
        if not empty:
            values = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), kind, pa.binary(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*values, pa.array([sums.ravel().tolist()])], names)

    names = ["id", "label", "vector", "code", "error", "sums"]
    double = rows.schema["vector"].dataType == T.ArrayType(T.DoubleType())
    kind = pa.list_(pa.float64() if double else pa.float32())
    stored_type = "double" if double else "float"
    schema = f"id long, label string, vector array<{stored_type}>, code binary, error long, sums array<long>"
    return stored(rows.select("id", "label", "vector", "code").mapInArrow(run, schema), "codes")


def totals(passed: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """The tasks' sums, added up in Spark; the last value of each entry is a maximum."""
    each = passed.filter(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("at", "value"))
    added = each.groupBy("at").agg(F.sum("value").alias("total"), F.max("value").alias("most"))
    out = np.zeros((math.prod(shape), 2), dtype=np.int64)
    for row in added.collect():  # parts x entries x (components + 2) rows, set by the parameters
        out[row["at"]] = row["total"], row["most"]
    out = out.reshape(*shape, 2)
    return np.concatenate([out[:, :, :-1, 0], out[:, :, -1:, 1]], axis=2)


def moved(books: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The new centres, and bounds of the radii around them.

    A member is no farther from the new centre than from the old one plus the way between them.
    """
    count = sums[:, :, -2:-1]
    new = np.where(count > 0, sums[:, :, :-2] // np.maximum(count, 1), books)
    way = np.sqrt(((new - books) ** 2).sum(axis=2).astype(np.float64))
    radii = np.ceil(np.sqrt(sums[:, :, -1].astype(np.float64)) + way).astype(np.int64) + 1
    return new, radii


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


@dataclass(frozen=True)
class Coded:
    """`rows` has `id, label, code, error`; `books` are the final codebooks."""

    rows: DataFrame
    books: np.ndarray


def encode_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Coded | None:
    """Codes of all vectors, by integer k-means on each of `parts` equal parts.

    Components become floor(256 x). The codebooks start as the parts of the `entries` smallest
    keys (repeated keys by vector, null keys last), fewer where there are fewer rows. Each round assigns all
    parts to their nearest entries, ties to the lower one, and moves each entry to the
    floored mean of its parts; unused entries stay; then all parts are assigned once more.
    All arithmetic is on integers, so results don't depend on partitions.

    Vectors that are null or hold null or non-finite components take no part, nor do those
    of another length than most (of two lengths as frequent, the larger stays), or of length zero. The
    length must be a multiple of `parts`. Repeated rows count each; other columns are ignored. None
    where no vector is left.
    """
    single = vectors.schema[vector].dataType.elementType == T.FloatType()
    rows = vectors.filter(sound(vector)).select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"),
    )
    lengths = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    most = lengths.filter("width > 0").orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return None
    width = most["width"]
    if width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    rows = rows.filter(F.size("vector") == width)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    seeds = integers(first.column(0).combine_chunks(), width)
    books = seeds.reshape(len(seeds), parts, width // parts).swapaxes(0, 1).copy()
    balls = Balls.around(books)
    # Everything starts in the first entry's ball.
    current = rows.withColumn("code", F.lit(bytes(parts)))
    for _ in range(rounds):
        passed = assigned(current, balls, parts, width)
        sums = totals(passed, (parts, len(seeds), width // parts + 2))
        books, radii = moved(balls.books, sums)
        balls = Balls.around(books, radii)
        current = passed.filter(F.col("sums").isNull())
    final = assigned(current, balls, parts, width, last=True).filter(F.col("sums").isNull())
    return Coded(final.drop("sums", "vector"), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """`label_error`: the errors summed over each label, nulls together."""
    name = F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit(""))
    named = rows.withColumn("name", name)
    sums = named.groupBy("name").agg(F.sum("error").alias("label_error"))
    return lookup_join(named, sums, "name").drop("name")


def _assigned(name: str, book: str) -> str:
    """The nearest entry of every part, as `best = distance * entries + entry`."""
    return f"""{name} AS MATERIALIZED (
  SELECT id, p, x, min({ENTRIES} * list_sum(list_transform(range(1, len(x) + 1),
           lambda i: (x[i] - y[i]) * (x[i] - y[i])))::BIGINT + e) AS best
  FROM parts JOIN {book} USING (p) GROUP BY id, p, x)"""


def _moved(name: str, book: str, members: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT p, e, coalesce(n.y, o.y) AS y FROM {book} o LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y FROM (
      SELECT p, best % {ENTRIES} AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
      FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM {members}) GROUP BY ALL) GROUP BY p, e) n
  USING (p, e))"""


SQL = f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), parts AS MATERIALIZED (
  SELECT id, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS x
  FROM (SELECT id, v, unnest(range({PARTS})) AS p FROM kept)
), book0 AS (SELECT p, id - 1 AS e, x AS y FROM parts WHERE id <= {ENTRIES}
), {_assigned("round1", "book0")}, {_moved("book1", "book0", "round1")
}, {_assigned("round2", "book1")}, {_moved("book2", "book1", "round2")
}, {_assigned("round3", "book2")}, coded AS (
  SELECT id, string_agg(format('{{:02x}}', best % {ENTRIES}), '' ORDER BY p) AS code,
         sum(best // {ENTRIES})::BIGINT AS error FROM round3 GROUP BY id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (id)"""


@query(SQL)
def op13_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sound vector's code, its error and the error of its label."""
    coded = encode_vectors(table(spark, sf_dir, "embeddings"))
    if coded is None:
        return spark.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    return with_label_error(coded.rows.select("id", "label", "code", "error")).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(book_digest(coded.books)).alias("codebooks_sha256"),
    )
