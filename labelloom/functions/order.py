"""Seeded pseudo-random order that depends on nothing but seed and key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seeded_hash(key: str, seed: int | str) -> Column:
    """Hex digest of `seed:key`: the same on every engine, partitioning and run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
