"""Use of all cores for text work on a table stored in few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scanned table over at least as many tasks as there are cores.

    A table with fewer splits than cores is small; it is spread by its unique key
    before expensive text expressions run. Any larger one is left as it is, so at
    scale this adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
