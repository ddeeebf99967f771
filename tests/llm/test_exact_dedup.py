"""Exact dedup against a dictionary of normalised texts."""

import hashlib
import re
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from labelloom.llm import exact_dedup


def body(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[body(text)].append(key)
    out = Counter()
    for text, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        done = False
        for key in keys:
            out[(key, keep, len(keys), key == keep and not done, sha)] += 1
            done = done or key == keep
    return out


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.md5(c), 1, 1)])
def test_marks(spark, digest):
    """The weak digest gives many texts one digest; the full content still tells them apart."""
    got = exact_dedup.mark_exact(cases.frame(spark), digest=digest)
    assert Counter(tuple(r) for r in got.collect()) == expected(cases.rows())


def test_one_row_of_each_text_stays(spark):
    docs = cases.frame(spark)
    left = exact_dedup.drop_exact(docs)
    assert left.columns == docs.columns
    assert sorted(body(r["text"]) for r in left.collect()) == sorted({body(r[1]) for r in cases.rows()})


def test_nulls_only_and_no_rows(spark):
    assert exact_dedup.mark_exact(cases.empty(spark)).count() == 0
    assert exact_dedup.drop_exact(cases.empty(spark)).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    got = exact_dedup.mark_exact(nulls).collect()
    assert [r["kept"] for r in got].count(True) == 1 and {r["group_size"] for r in got} == {3}


def test_native_plan(spark):
    plan = exact_dedup.mark_exact(cases.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
