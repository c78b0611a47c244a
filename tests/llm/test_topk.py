"""Top-k by histograms against all inner products."""

import math
import random

import duckdb
from pyspark.sql import functions as F

from churnmart.llm import checks, topk


def slow(rows, k):
    usable = [
        (n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in usable:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in usable if m != n and len(v) == len(q))
            out += [(i, r, j, max(-topk.LONG, min(topk.LONG, -s))) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0, k).collect())


def test_random_vectors_with_ties(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randint(-3, 3) / 8 for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, [0.25, 0.25, 0.25, 0.25]) for i in range(300)]
    assert run(spark, rows) == slow(rows, 5)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, None), (100, [math.nan, 1.0]), (150, [None, 1.0]), (None, [1.0, 1.0]),
        (200, [1.0]), (3, [5.0]), (250, []), (4, []), (5, [math.inf, 0.0]), (6, [-0.001, 0.5]), (300, [1e12, -1e12]), (7, [1e12, 3.0]),
    ]
    assert run(spark, rows) == slow(rows, 5)
    assert run(spark, rows, 1) == slow(rows, 1)
    assert run(spark, []) == []


def test_given_table_matches_sql(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert got == sorted(con.execute(checks.OP3).fetchall())


def test_groups_of_queries_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i * 10, [rng.random() for _ in range(3)]) for i in range(200)]
    monkeypatch.setattr(topk, "QUERY_GROUP", 7)
    monkeypatch.setattr(topk, "BINS", 16)
    assert run(spark, rows) == slow(rows, 5)
