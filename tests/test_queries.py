"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from acctcube.suite.check import compare, connect
from acctcube.suite.queries import QUERIES
from acctcube.suite.sql import oracle

SQL = oracle()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, plan, name):
    df = entry.queries()[name](spark, sf)
    assert compare(df, con, SQL[name]) == []
    physical = plan(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in physical


def test_compare_sees_differences(spark, sf, con):
    df = entry.queries()["cohort_filter"](spark, sf)
    sql = SQL["cohort_filter"]
    assert compare(df, con, sql) == []
    assert compare(df, con, f"select * from ({sql}) limit 5")
    assert compare(df, con, f"select * replace (school + 1 as school) from ({sql})")
    assert compare(df, con, f"select * replace (cast(school as bigint) as school) from ({sql})")


def test_entry(spark):
    df = entry.entry(spark)
    assert {"level", "system", "school", "subgroup", "enrolled", "pct_cr_all"} <= set(df.columns)
    assert df.count() > 0
