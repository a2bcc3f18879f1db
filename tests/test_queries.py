"""Every registered query against its SQL, and the entry point."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, db, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "revenue"] and df.count() > 0
