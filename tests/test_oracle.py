"""Every registered query against its DuckDB twin on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest
from conftest import SF001
from oracle_compare import compare, duck

import __spark_entry__ as E


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    from dailytally.plans.catalog import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k != "stream_foreachbatch"))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, SF001, [key], con)[key]
    assert res[0] == "ok", res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["restaurant_id", "date", "country", "total_orders", "completed_orders",
                          "cancelled_orders", "gross_revenue"]
    assert df.count() == 8
