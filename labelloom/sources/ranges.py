"""One large CSV file in many tasks, rows in file order."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from labelloom.plans.lookup import pin_small
from labelloom.sources.tables import CSV_OPTIONS, header_names, text_fields, typed

# The parts of a record that ranges cut: it starts, goes on through a whole range, ends.
WHOLE, STARTS, GOES_ON, ENDS = range(4)
RECORDS = "file string, range long, nth long, record string, part int"

# The line assembler travels with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order to records; `opens` says whether the range starts within quotes.

    A line with an odd number of quotes opens or closes a quoted break. Lines that are records
    by themselves pass through as they are; only the lines of longer records are handled one by one.
    """
    spot, inside, lines, first, began, nth = None, False, [], 0, True, 0

    def batch_of(file, start, at, records, parts) -> pa.RecordBatch:
        n = len(records)
        values = [pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64()), at, records, parts]
        return pa.RecordBatch.from_arrays(values, ["file", "range", "nth", "record", "part"])

    def one(record: list[str], part: int) -> pa.RecordBatch:
        at, joined = pa.array([first], pa.int64()), pa.array(["\n".join(record)], pa.string())
        return batch_of(*spot, at, joined, pa.array([part], pa.int32()))

    for batch in batches:
        files, starts = batch.column("file"), batch.column("range")
        if not batch.num_rows:
            continue
        same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(starts[1:], starts[:-1]))
        cuts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            here = (files[int(a)].as_py(), starts[int(a)].as_py())
            if here != spot:
                if lines:
                    yield one(lines, STARTS if began else GOES_ON)
                spot, nth, lines, first = here, 0, [], 0
                inside = bool(batch.column("opens")[int(a)].as_py())
                began = not inside
            values = batch.column("value")[int(a) : int(b)]
            odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
            after = (int(inside) + np.cumsum(odd)) % 2
            before = (after + odd) % 2
            places = nth + np.arange(len(odd))
            alone = (before == 0) & (after == 0)
            if alone.any():
                kept = values.filter(pa.array(alone))
                parts = pa.array(np.full(len(kept), WHOLE, np.int32))
                yield batch_of(*spot, pa.array(places[alone]), kept, parts)
            for i in np.flatnonzero(~alone):
                if not before[i]:
                    lines, first, began = [], int(places[i]), True
                lines.append(values[int(i)].as_py())
                if not after[i]:
                    yield one(lines, WHOLE if began else ENDS)
                    lines = []
            inside, nth = bool(after[-1]), nth + len(odd)
    if lines:
        yield one(lines, STARTS if began else GOES_ON)


def in_order(lines: DataFrame, states: DataFrame) -> DataFrame:
    """The lines with their range's state, each range's lines still in order.

    Ranges with a state are few; where they are too many to broadcast, the lines are dealt by range
    and sorted again, a range being what one task reads.
    """
    small = pin_small(states)
    if small is not None:
        return lines.join(F.broadcast(small), ["file", "range"], "left")
    dealt = lines.join(states, ["file", "range"], "left")
    return dealt.repartition("file", "range").sortWithinPartitions("file", "range", "at")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as text, found in byte ranges: `file, range, nth, record`.

    Spark reads the files as lines, a range of bytes per task. The quotes of each range are
    counted first; summed up in the order of the ranges they tell which ranges start within quotes. With
    that every task finds the record ends of its own range. Records that a range's end cuts
    are the only ones that are shuffled. `file, range, nth` grow in file order: `range` is a byte
    offset and `nth` a line of that range.

    Line ends are \\n or \\r\\n. Quotes stand around whole fields and are doubled within, as
    `csv_sink` writes them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "range").agg((F.sum(quotes) % 2).alias("odd"))
    # One row per range: a file's rows in this window are its size by that of a range.
    ahead = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2
    states = counted.select("file", "range", (before == 1).alias("opens"), ((before + F.col("odd")) % 2 == 1).alias("stays"))
    states = states.filter("opens OR stays")
    columns = ("file", "range", "value", "opens")
    marked = in_order(lines, states)
    whole = marked.select(*columns).mapInArrow(assemble, RECORDS).filter(F.col("part") == WHOLE)
    cut = marked.filter("opens OR stays").select(*columns).mapInArrow(assemble, RECORDS)
    cut = cut.filter(F.col("part") != WHOLE)
    # At most two rows per range.
    upto = Window.partitionBy("file").orderBy("range", "nth")
    joined = (
        cut.withColumn("no", F.count_if(F.col("part") == STARTS).over(upto))
        .groupBy("file", "no")
        .agg(F.sort_array(F.collect_list(F.struct("range", "nth", "record"))).alias("parts"))
        .select(
            "file", F.col("parts")[0]["range"].alias("range"), F.col("parts")[0]["nth"].alias("nth"),
            F.array_join(F.col("parts")["record"], "\n").alias("record"),
        )
    )
    found = whole.drop("part").unionByName(joined)
    clean = F.regexp_replace("record", "\r$", "")
    return found.withColumn("record", clean).filter(F.length("record") > 0)


def csv_scan_ranges(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    split: str | None = None,
    malformed: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """`csv_scan` with each file read by as many tasks as it has byte ranges.

    The rows, columns and errors are those of `csv_scan`; line ends within quotes stay as they
    are. `position` names a column that orders the rows as the files do: files by path, then rows.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    names = header_names(spark, path, fields)
    records = csv_records(spark, path)
    first = (F.col("range") == 0) & (F.col("nth") == 0)
    texts, raw = text_fields(names, malformed)
    parsed = F.from_csv("record", texts.simpleString(), read_options(malformed, raw))
    head = F.regexp_replace("record", "^﻿", "")
    shown = F.from_csv(F.when(first, head), text_fields(names, None)[0].simpleString(), read_options(None, raw))
    wrong = reduce(lambda a, b: a | b, [shown.getField(n) != F.lit(n) for n in names])
    # A header that differs ends the read, as it does in `csv_scan`.
    refused = F.raise_error(F.concat(F.lit("a header differs from the first one's in "), F.col("file")))
    checked = F.when(first & F.coalesce(wrong, F.lit(True)), refused.cast("boolean")).otherwise(~first)
    place = F.struct("file", "range", "nth")
    rows = records.filter(checked).select(place.alias("__place"), parsed.alias("__row"))
    rows = rows.select("__row.*", "__place")
    table = typed(rows, fields, names, malformed, raw, [F.col("__place").alias(position)] if position else [])
    return table if split is None else table.withColumn("split", F.lit(split))


def read_options(malformed: str | None, raw: str) -> dict[str, str]:
    options = {name: str(value) for name, value in CSV_OPTIONS.items() if name != "header"}
    if malformed is None:
        return {**options, "mode": "FAILFAST"}
    return {**options, "columnNameOfCorruptRecord": raw}


def parquet_position() -> Column:
    """What orders the rows of a Parquet table as its files do."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
