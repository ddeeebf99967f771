"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "lang" and result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(name, df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
