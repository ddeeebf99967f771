"""Distribution strategies against brute force, on skewed rows."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import resample, split
from labelloom.plans import lookup, ranking
from labelloom.plans.ranking import mark_first, number_rows


def digest(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot label with most rows, small ones, and one with a single row."""
    rows = [(i, "hot" if i % 3 else "warm" if i % 2 else f"c{i % 5}") for i in range(2000)]
    rows.append((5000, "single"))
    return spark.createDataFrame(rows, "key long, label string").repartition(7).cache()


def first_rows(df, seed, quotas):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.label, []).append(r.key)
    chosen = set()
    for label, keys in groups.items():
        chosen |= set(sorted(keys, key=lambda k: (digest(seed, k), k))[: quotas.get(label, 0)])
    return chosen


@pytest.mark.parametrize("digits", [1, 3])
def test_mark_first(spark, skewed, digits):
    wanted = {"hot": 801, "warm": 1, "c0": 0, "c1": 10_000, "single": 1}
    quotas = spark.createDataFrame(list(wanted.items()), "label string, quota long")
    marked = mark_first(
        skewed,
        lambda sizes: sizes.join(quotas, "label").withColumn("quota", F.least("quota", "n")),
        key="key", group="label", seed=7, into="chosen", digits=digits,
    )
    assert marked.count() == skewed.count()
    got = {r.key for r in marked.filter("chosen").collect()}
    assert got == first_rows(skewed, 7, wanted)


def test_split_does_not_depend_on_partitions(skewed):
    one = split.stratified_split(skewed.coalesce(1), "key", "label", 0.25, 1)
    many = split.stratified_split(skewed.repartition(13, "label"), "key", "label", 0.25, 1)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


@pytest.mark.parametrize("rows", [3, 50])
def test_prefix_grows_until_a_sort_is_small(monkeypatch, skewed, rows):
    monkeypatch.setattr(ranking, "SORTED_ROWS", rows)
    got = split.stratified_split(skewed, "key", "label", 0.25, 1)
    monkeypatch.undo()
    assert got.exceptAll(split.stratified_split(skewed, "key", "label", 0.25, 1)).isEmpty()


def test_numbers_follow_any_orderable_key(spark):
    rows = [(f"k{i % 7}", None if i % 11 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b long").distinct().repartition(5)
    got = [(r.a, r.b) for r in number_rows(df, ["a", "b"]).orderBy("row_no").collect()]
    assert got == sorted(set(rows), key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    assert number_rows(df.limit(0), ["a", "b"]).count() == 0


def test_large_head_fetches_rows_by_key(monkeypatch, skewed):
    monkeypatch.setattr(lookup, "FETCH_KEYS", 10)
    df = skewed.withColumn("wide", F.repeat(F.lit("x"), 50))
    head = split.head_n(df, "key", 400)
    text = head._jdf.queryExecution().executedPlan().toString()
    assert not any("TakeOrdered" in line and "wide" in line for line in text.splitlines())
    assert sorted(r.key for r in head.collect()) == sorted(r.key for r in skewed.collect())[:400]


def test_sample_paths_agree(monkeypatch, skewed):
    top = {r.key for r in split.sample_n(skewed, "key", 333, 9).collect()}
    monkeypatch.setattr(split, "TOP_N_LIMIT", 10)
    cut = {r.key for r in split.sample_n(skewed, "key", 333, 9).collect()}
    assert top == cut and len(cut) == 333
    assert split.sample_n(skewed, "key", 10_000, 9).count() == skewed.count()


@pytest.mark.parametrize("keys", ["even", "clustered"])
def test_number_rows(spark, keys):
    rng = random.Random(3)
    values = list(range(997))
    if keys == "clustered":
        values = [rng.randrange(2**40) if i % 50 == 0 else 2**41 + i for i in range(997)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in set(values)], "key long").repartition(5)
    got = {r.key: r.row_no for r in number_rows(df, "key").collect()}
    assert got == {v: i for i, v in enumerate(sorted(set(values)), 1)}


def test_row_numbers_come_from_ranges(spark, skewed):
    """No row is compared with every cut; the numbers stay when the plan runs again."""
    numbered = number_rows(skewed, ["label", "key"])
    text = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "filter(" not in text
    first = {(r.label, r.key): r.row_no for r in numbered.collect()}
    again = {(r.label, r.key): r.row_no for r in numbered.repartition(3).collect()}
    ordered = sorted(first)
    assert first == again == {k: i for i, k in enumerate(ordered, 1)}


def test_batches_are_full_but_the_last(skewed):
    sizes = split.batch_ids(skewed, "key", 16).groupBy("batch_id").count().orderBy("batch_id")
    counts = [r["count"] for r in sizes.collect()]
    assert set(counts[:-1]) == {16} and counts[-1] == 2001 % 16


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", ["MAX_ROWS", "MAX_ROW_BYTES"])
def test_lookup_beyond_the_limits_is_the_same(monkeypatch, spark, skewed, how, limit):
    names = skewed.select("label").distinct().filter("label <> 'c0'")
    small = names.withColumn("size", F.length("label"))
    plain = lookup.lookup_join(skewed, small, "label", how)
    monkeypatch.setattr(lookup, limit, 1)
    assert lookup.pin_small(small) is None
    salted = lookup.lookup_join(skewed, small, "label", how)
    assert "BroadcastHashJoin" not in salted._jdf.queryExecution().optimizedPlan().toString()
    assert plain.exceptAll(salted.select(plain.columns)).isEmpty()
    assert plain.count() == salted.count()


def test_undersample_and_oversample(monkeypatch, skewed):
    assert resample.undersample(skewed, "key", "label").count() == skewed.select("label").distinct().count()
    sizes = {r.label: r["count"] for r in skewed.groupBy("label").count().collect()}
    top = max(sizes.values())
    monkeypatch.setattr(resample, "COPIES_PER_TASK", 100)
    over = resample.oversample(skewed, "key", "label", 5).cache()
    assert {r.label: r["count"] for r in over.groupBy("label").count().collect()} == dict.fromkeys(sizes, top)
    copies = {r.key: r.n for r in over.groupBy("key").agg(F.max("copy_no").alias("n")).collect()}
    more = first_rows(skewed, 5, {label: top % n for label, n in sizes.items()})
    for r in skewed.collect():
        assert copies[r.key] == top // sizes[r.label] + (r.key in more)
    assert over.groupBy("key", "copy_no").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("seed", range(4))
def test_quotas(spark, seed):
    """Largest remainder by hand, also for row counts whose product exceeds 64 bits."""
    rng = random.Random(seed)
    scale = 10**11 if seed % 2 else 1
    sizes = {f"c{i}": rng.randrange(1, 500) * scale for i in range(7)}
    share = rng.choice([0.1, 0.125, 0.2, 0.3])
    total = sum(sizes.values())
    held = math.ceil(total * share)
    base = {c: n * held // total for c, n in sizes.items()}
    spare = held - sum(base.values())
    for c in sorted(sizes, key=lambda c: (-(sizes[c] * held % total), c))[:spare]:
        base[c] += 1
    table = spark.createDataFrame(list(sizes.items()), "label string, n long")
    got = split.split_quotas(table, "label", share)
    assert {r.label: r.quota for r in got.collect()} == base
