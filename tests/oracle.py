"""Runs a query in Spark and its oracle in DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


# Spark type and the DuckDB type that stands for it.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
}


def compare(name: str, df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where rows, column names and types agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{name}: {len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{name}: {a!r:.400} != {b!r:.400}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]}
    if wrong:
        return f"{name}: types {wrong}"
    return None
