"""Every registered query against its check query in DuckDB."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from churnmart.plans import catalog
from oracle import twins

QUERIES, SQL = catalog.queries(), twins.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_check(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) == []


def test_the_comparison_sees_differences(spark, con):
    df = spark.createDataFrame([(1, 2.0)], "a INT, b DOUBLE")
    assert differences(df, con, "SELECT 1 AS a, 2e0 AS b") == []
    assert differences(df, con, "SELECT 1 AS a, 2.0000001e0 AS b")
    assert differences(df, con, "SELECT CAST(1 AS BIGINT) AS a, 2e0 AS b")
    assert differences(df, con, "SELECT 1 AS a, 2e0 AS c")
    assert differences(df, con, "SELECT 1 AS a, 2e0 AS b UNION ALL SELECT 1, 2e0")


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
