"""Queries with SQL against DuckDB, row by row."""

import duckdb
import pytest

from churnmart.llm import checks, queries

SQL = checks.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, name):
    folder = folder.replace("sf0.001", "sf0.01")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
