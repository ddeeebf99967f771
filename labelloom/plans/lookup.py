"""Joins against a small side whose size is measured before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Together they bound what may reach the driver and every executor: 20,000 rows x 2 KB = 40 MB.
MAX_ROWS = 20_000
MAX_ROW_BYTES = 2_048
SALTS = 64
FETCH_KEYS = 1_000


def pull_small(df: DataFrame, max_rows: int | None = None) -> pa.Table | None:
    """The frame as an Arrow table, or None where it is over the row or the row-size limit.

    Over-long rows are blanked on the executors, so no more than
    `max_rows * MAX_ROW_BYTES` bytes ever leave them.
    """
    max_rows = MAX_ROWS if max_rows is None else max_rows
    columns = df.columns
    wide = F.length(F.to_json(F.struct(*columns))) > MAX_ROW_BYTES
    guarded = df.limit(max_rows + 1).select(
        wide.alias("__wide"), *[F.when(~wide, F.col(c)).alias(c) for c in columns]
    )
    table = guarded.toArrow()
    if table.num_rows > max_rows or True in table.column("__wide").to_pylist():
        return None
    return table.drop_columns(["__wide"])


def pin_small(df: DataFrame, max_rows: int | None = None) -> DataFrame | None:
    """The frame as a local relation of known size, or None where it is over the limit."""
    table = pull_small(df, max_rows)
    if table is None:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few literal rows as a local relation."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrays = [
        pa.array(values, to_arrow_type(field.dataType)) for values, field in zip(columns, fields)
    ]
    return spark.createDataFrame(pa.table(arrays, names=fields.names), schema=fields)


def settle(df: DataFrame) -> DataFrame:
    """A small aggregate computed once and reused; a large one stays a lazy plan."""
    pinned = pin_small(df)
    return df if pinned is None else pinned


def salted_join(big: DataFrame, small: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Shuffle join that spreads each key of `big` over SALTS tasks; `small` is unique on `on`."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(SALTS)).cast("int")
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("__salt", salt).join(copies, [on, "__salt"], how).drop("__salt")


def lookup_join(big: DataFrame, small: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join a per-class table to rows: broadcast within the size limit, salted shuffle beyond it."""
    pinned = pin_small(small)
    if pinned is not None:
        return big.join(F.broadcast(pinned), on, how)
    return salted_join(big, small, on, how)


def fetch_by_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows with the given unique keys.

    Up to FETCH_KEYS keys become a filter, which a columnar source uses to skip what
    it need not read; more are joined.
    """
    table = pull_small(keys.select(key), FETCH_KEYS)
    if table is None:
        return lookup_join(df, keys.select(key), key)
    return df.filter(F.col(key).isin(table.column(key).to_pylist()))


def first_rows(df: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """The first n rows by `order` and key.

    Only the ordering columns go through the top-n, so the many per-task candidates
    stay narrow; the rows themselves are fetched for the n keys that remain.
    """
    ranked = [*order, F.col(key)]
    top = df.select(*[c.alias(f"__{i}") for i, c in enumerate(order)], key)
    top = top.orderBy(*[f"__{i}" for i in range(len(order))], key).limit(n).select(key)
    keys = top.distinct()
    found = fetch_by_key(df, keys, key).orderBy(*ranked)
    # Only where keys are repeated do n keys have more than n rows; these are cut, in order.
    if n <= FETCH_KEYS or fetch_by_key(df.select(key), keys, key).limit(n + 1).count() > n:
        return found.limit(n)
    return found


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
