"""CSV files read in byte ranges, against the reader that takes a file as a whole."""

import pytest
from pyspark.sql import functions as F

from labelloom.catalog import preparation
from labelloom.operators import profile, split
from labelloom.plans import lookup
from labelloom.sources import ranges, tables

SCHEMA = "id long, t string"
TEXTS = ["plain", 'a "q", b\nline two\n\n"x"', "", "c,d", "\n", '"\n"\n"', "ünï\n漢", "end\n"]


def bytes_of(size):
    return {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def cut(spark):
    """Sets the size of the ranges for one test."""
    names = list(bytes_of(1))
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, v) for n, v in bytes_of(size).items()]
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, texts, end="\n", last=True):
    quoted = [f'x,"{t.replace(chr(34), chr(34) * 2)}",{i}' for i, t in enumerate(texts)]
    body = end.join(["more,t,id", *quoted]) + (end if last else "")
    path.write_bytes(body.encode())
    return [(i, t or None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [1, 11])
def test_ranges_end_anywhere(spark, tmp_path, cut, size):
    """With ranges of one byte every position is a cut."""
    want = write(tmp_path / "a.csv", TEXTS)
    whole = tables.csv_scan(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, whole.collect())) == want
    cut(size)
    got = ranges.csv_scan_ranges(spark, str(tmp_path / "a.csv"), SCHEMA, position="at").orderBy("at").collect()
    assert [(r.id, r.t) for r in got] == want


def test_one_file_many_tasks(spark, tmp_path, cut):
    want = write(tmp_path / "a.csv", [f"{i}\n{'x' * (i % 50)}" for i in range(2000)])
    cut(4096)
    records = ranges.csv_records(spark, str(tmp_path / "a.csv"))
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5 and records.select("range").distinct().count() > 5
    got = ranges.csv_scan_ranges(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, got.collect())) == want


def test_too_many_states_to_broadcast(spark, tmp_path, cut, monkeypatch):
    want = write(tmp_path / "a.csv", TEXTS * 3)
    cut(7)
    monkeypatch.setattr(lookup, "MAX_ROWS", 1)
    got = ranges.csv_scan_ranges(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("last", [True, False])
def test_dos_lines_and_no_last_line_end(spark, tmp_path, cut, last):
    want = write(tmp_path / "a.csv", ["a", "b\r\nc", "d"], "\r\n", last)
    cut(3)
    got = ranges.csv_scan_ranges(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, got.collect())) == want


def test_files_in_order(spark, tmp_path, cut):
    for name, texts in (("b", ["2", "3\n"]), ("a", ["0\n\n", "1"]), ("c", [])):
        write(tmp_path / f"{name}.csv", texts)
    cut(4)
    table = ranges.csv_scan_ranges(spark, str(tmp_path), SCHEMA, "test", position="at")
    assert [r.t.strip() for r in table.orderBy("at").collect()] == ["0", "1", "2", "3"]
    assert {r.split for r in table.select("split").collect()} == {"test"}
    assert [r.t.strip() for r in split.head_in_order(table, "at", 3).collect()] == ["0", "1", "2"]


def test_first_appearance(spark, tmp_path):
    """Neither the smallest key nor the smallest text is first, the first row is."""
    rows = [(9, "z", "b"), (1, "a", "b"), (7, "y" * 200, "a"), (0, "x", None), (5, "b", "a")]
    df = spark.createDataFrame(rows, "id long, t string, label string").coalesce(1)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).withColumn("at", ranges.parquet_position())
    got = profile.class_example_in_order(stored, "at", "id", "t", "label").collect()
    assert [tuple(r) for r in got] == [("B", 9, "z..."), ("A", 7, "y" * 100 + "...")]


@pytest.mark.parametrize("row", ["zz,b", "3,c,extra", "4"])
def test_malformed_rows(spark, tmp_path, cut, row):
    (tmp_path / "t.csv").write_text(f"id,t\n1,a\n{row}\n")
    cut(5)
    with pytest.raises(Exception, match="(?i)malformed|cast"):
        ranges.csv_scan_ranges(spark, str(tmp_path), SCHEMA).collect()
    got = ranges.csv_scan_ranges(spark, str(tmp_path), SCHEMA, malformed="raw").collect()
    assert [(r.id, r.t) for r in got if r.raw is None] == [(1, "a")]
    assert [r.raw for r in got if r.raw is not None] == [row]


def test_another_header_ends_the_read(spark, tmp_path):
    write(tmp_path / "a.csv", ["x"])
    (tmp_path / "b.csv").write_text("t,more,id\nx,y,1\n")
    with pytest.raises(Exception, match="header differs"):
        ranges.csv_scan_ranges(spark, str(tmp_path), SCHEMA).collect()


def test_repeated_keys_give_n_rows(spark):
    df = spark.range(3000).select((F.col("id") % 1500).alias("k"), "id").repartition(4)
    for n in (10, 1000, 1200):
        assert split.head_n(df, "k", n).count() == n
        assert split.sample_n(df, "k", n).count() == n


@pytest.mark.parametrize("scan, files", [("csv_scan_ranges", 6), ("_shuffled_file", 6)])
def test_files_grow_with_the_scan(spark, tmp_path, cut, monkeypatch, scan, files):
    """No task writes, and no file holds, more as the table grows."""
    rows = spark.range(600).selectExpr("id AS doc_id", "'a\nb' AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars")
    rows.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    cut(1 << 20)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    monkeypatch.setattr(preparation, "scratch_path", lambda _, name: str(tmp_path / name.strip("_")))
    assert getattr(preparation, scan)(spark, str(tmp_path)).count() == 600
    assert len(list((tmp_path / scan.strip("_")).glob("*.csv"))) >= files
