import random

import pytest
from pyspark.sql import functions as F

from churnmart.operators.joins import hot_keys, repeat_rows, salted_join


@pytest.fixture(scope="module")
def sides(spark):
    r = random.Random(1)
    left = [(i, 1 if i % 3 == 0 else (None if i % 50 == 1 else r.randint(2, 4000))) for i in range(6000)]
    right = [(k, k * 10, v) for k in range(1, 3000) for v in range(1 + (k == 1))]
    return (
        spark.createDataFrame(left, "id INT, k INT"),
        spark.createDataFrame(right, "k INT, w INT, version INT"),
    )


def test_hot_keys_get_tasks_by_their_rows(sides, spark, monkeypatch):
    left, _ = sides
    # NULL keys are a fiftieth of the rest, key 1 is a third of all; four shuffle partitions.
    assert hot_keys(left, "k") == [{1: 2}]
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        found, ids = hot_keys(left, "k", "id")
        assert set(found) == {1, None} and 30 <= found[1] <= 36 and ids == {}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert hot_keys(left.limit(0), "k") == [{}]


HOT = {1: 8, None: 3}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [HOT, {}, {1: 4}, {None: 2}, None])
def test_salted_join_equals_the_plain_join(sides, how, hot):
    left, right = sides
    got = salted_join(left, right, "k", F.xxhash64("id"), how, hot=hot)
    want = left.join(right, "k", how)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(tuple, got.select("id", "k", "w", "version").collect()), key=key) == sorted(
        map(tuple, want.select("id", "k", "w", "version").collect()), key=key)


def test_salted_join_with_a_residual_condition(sides):
    left, right = sides
    got = salted_join(
        left, right, "k", F.xxhash64("id"), "left", F.col("version") == 1, hot=HOT
    )
    assert got.count() == left.count()
    assert got.where("version is not null").count() == left.where("k = 1").count()


def test_salted_join_spreads_a_hot_key(sides, spark):
    left, right = sides
    joined = salted_join(left, right, "k", F.xxhash64("id"), "inner", hot=HOT)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64" in plan


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 250_001), ("c", 0), ("d", 1)], "x STRING, n LONG")
    got = dict(map(tuple, repeat_rows(df, "n").groupBy("x").count().collect()))
    assert got == {"a": 3, "b": 250_001, "d": 1}


def test_only_null_keys_are_hot(spark):
    left = spark.range(5000).selectExpr("id", "if(id % 2 = 0, null, id) AS k")
    right = spark.range(5000).selectExpr("id AS k", "id * 2 AS w")
    got = salted_join(left, right, "k", F.xxhash64("id"))
    assert got.count() == 5000 and got.where("w = id * 2").count() == 2500
    assert got.where("w is null").count() == 2500


def test_hot_keys_are_a_table_that_is_looked_up(sides):
    left, right = sides
    plan = salted_join(left, right, "k", F.xxhash64("id"), "inner", hot=HOT)._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in plan and "map_" not in plan and plan.count("rightHint=(strategy=broadcast)") == 2


def test_a_broadcast_side_needs_no_hot_keys(sides, spark, monkeypatch):
    from churnmart.operators import joins

    left, right = sides[0], spark.range(1, 3000).selectExpr("cast(id as int) k", "id * 10 w")
    monkeypatch.setattr(joins, "hot_keys", lambda *a: pytest.fail("looked for"))
    assert salted_join(left, right, "k", F.xxhash64("id"), "inner").count() > 0
    monkeypatch.undo()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not joins.is_broadcast(right)
        plan = salted_join(left, right, "k", F.xxhash64("id"), "inner")._jdf.queryExecution().optimizedPlan().toString()
        assert "pmod(xxhash64" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
