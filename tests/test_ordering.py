import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from churnmart.operators import ordering as O


def rows_with_hot_keys(n=4000, seed=5):
    """A third of the rows share one leading key, some keys are NULL, some rows are copies."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = None if r.random() < 0.05 else (7 if r.random() < 0.35 else r.randint(0, 50))
        out.append((k, r.choice("ab"), i if i % 10 else 0, float(r.randint(0, 300))))
    return out


@pytest.fixture(scope="module")
def hot(spark):
    df = spark.createDataFrame(rows_with_hot_keys(), "k INT, g STRING, id INT, v DOUBLE")
    return df.repartition(7)


def test_rank_is_dense_and_ordered_despite_hot_keys_nulls_and_copies(hot):
    ranked = O.global_rank(hot, [F.col("k").desc(), "id"], "r", total="n")
    got = sorted(ranked.collect(), key=lambda x: x.r)
    assert [x.r for x in got] == list(range(1, 4001))
    assert {x.n for x in got} == {4000}
    keys = [(-x.k if x.k is not None else 10**9, x.id) for x in got]
    assert keys == sorted(keys)


def test_rank_equals_row_number(hot):
    unique = hot.where("id > 0")
    ranked = O.global_rank(unique, ["k", "id"], "r", start=100)
    e = F.row_number().over(Window.orderBy("k", "id")) + 100
    assert ranked.withColumn("e", e).where("r <> e").count() == 0


def test_rank_within_groups_equals_row_number(hot):
    unique = hot.where("id > 0").withColumn("g", F.when(F.col("id") % 11 != 0, F.col("g")))
    ranked = O.global_rank(unique, [F.col("v").desc(), "id"], "r", within=["g"])
    e = F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id"))
    assert ranked.withColumn("e", e).where("r <> e").count() == 0
    assert ranked.count() == unique.count()


def test_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "a INT")
    assert O.global_rank(empty, ["a"], "r").collect() == []


@pytest.mark.parametrize("rows,n", [(0, 4), (1, 4), (3, 4), (4, 4), (5, 4), (10, 4), (11, 3), (7, 7)])
def test_ntile_formula(spark, rows, n):
    df = spark.range(1, rows + 1).withColumn("n", F.lit(rows).cast("long"))
    got = df.withColumn("t", O.ntile_from_rank(F.col("id"), F.col("n"), n))
    want = df.withColumn("t", F.ntile(n).over(Window.orderBy("id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("sorted_rows", [100_000, 0])
def test_quantiles_equal_numpy(hot, sorted_rows, monkeypatch):
    monkeypatch.setattr(O, "_SORTED", sorted_rows)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = O.exact_quantiles(hot, "v", probabilities, ["g"]).collect()
    assert len(got) == 2
    data = rows_with_hot_keys()
    for row in got:
        values = [v for _, g, _, v in data if g == row.g]
        assert row.n == len(values)
        want = np.quantile(values, probabilities)
        assert [row[f"q{i}"] for i in range(7)] == list(want)


@pytest.mark.parametrize("sorted_rows", [100_000, 0])
def test_quantiles_of_one_hot_value_nulls_and_no_keys(spark, sorted_rows, monkeypatch):
    monkeypatch.setattr(O, "_SORTED", sorted_rows)
    rows = [(5.0,)] * 900 + [(float(i),) for i in range(100)] + [(None,)] * 50
    df = spark.createDataFrame(rows, "v DOUBLE")
    row = O.exact_quantiles(df, "v", [0.05, 0.5, 0.97]).first()
    want = np.quantile([v for (v,) in rows if v is not None], [0.05, 0.5, 0.97])
    assert (row.n, row.q0, row.q1, row.q2) == (1000, *want)


def test_quantiles_of_far_apart_values_and_of_nothing(spark):
    values = [-1.7e308, -1.0, 0.0, 1e-300, 2e-300, 1.0, 1.7e308] + [3e-300] * 4
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    row = O.exact_quantiles(df, "v", [0.0, 0.2, 0.5, 1.0]).first()
    assert [row.n, row.q0, row.q2, row.q3] == [11, -1.7e308, sorted(values)[5], 1.7e308]
    assert O.exact_quantiles(df.limit(0), "v", [0.5]).first().n is None


def test_modes_break_ties_to_the_smallest_and_skip_nulls(spark):
    rows = [(10, "b"), (9, "a"), (9, "b"), (10, "a"), (None, None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "x INT, y STRING")
    got = {r["column"]: (r.number, r.text) for r in O.modes(df, ["x", "y"]).collect()}
    assert got == {"x": (9.0, None), "y": (None, "a")}


def test_sample_has_exact_size_and_ignores_partitioning(spark):
    df = spark.range(5000)
    one = O.hash_sample(df.repartition(3), "id", 300).collect()
    two = O.hash_sample(df.repartition(11), "id", 300).collect()
    assert len(one) == 300 and set(one) == set(two)
    assert O.hash_sample(df.limit(20), "id", 300).count() == 20


def test_rank_never_puts_all_rows_in_one_partition(hot):
    plan = O.global_rank(hot, ["k", "id"], "r")._jdf.queryExecution().executedPlan().toString()
    # The single partition holds block sizes; rows come straight from the written table.
    scan = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in scan and "Window" not in scan


def columns_of_all_kinds(spark, n=30_000):
    r = random.Random(9)
    rows = [
        (r.choice([0.0, 0.0, r.gauss(0, 1e5)]), None if i % 7 else i % 50, r.randint(0, 3), None, float(i), "x" if i % 3 else None)
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "a DOUBLE, b INT, c INT, d DOUBLE, e DOUBLE, g STRING").repartition(5)


@pytest.mark.parametrize("broken", [False, True])
def test_quantiles_of_many_columns_equal_numpy(spark, broken, monkeypatch):
    """Also where the sketch's brackets are useless and everything has to lie between the ends."""
    if broken:
        monkeypatch.setattr(O, "_NEAR", 0.0)
        monkeypatch.setattr(O, "_SORTED", 500)
    rows, df = columns_of_all_kinds(spark)
    p = [0.0, 0.013, 0.5, 0.999, 1.0]
    got = O.wide_quantiles(df, ["a", "b", "c", "d", "e"], p, ["g"], {"mean": "avg({v})"}).collect()
    assert len(got) == 2 * 4
    for row in got:
        values = [x["abcde".index(row.column)] for x in rows if x[5] == row.g]
        values = [v for v in values if v is not None]
        assert row.n == len(values) and row.mean == pytest.approx(np.mean(values))
        assert [row[f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(values, p)), rel=1e-14)
    whole = {r.column: r.q0 for r in O.wide_quantiles(df, ["a", "d", "e"], [0.25]).collect()}
    assert whole == {c: np.quantile([x["abcde".index(c)] for x in rows], 0.25) for c in "ae"}


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_quantiles_read_a_table_twice_and_repeat_no_row(spark, monkeypatch, keys):
    _, df = columns_of_all_kinds(spark)
    df, plans = O.materialize(df, "values"), []

    def spied(step):
        def run(*args):
            out = step(*args)
            plans.append(out._jdf.queryExecution().optimizedPlan().toString())
            return out
        return run

    for name in ("_sketched", "_entries"):
        monkeypatch.setattr(O, name, spied(getattr(O, name)))
    out = O.wide_quantiles(df, ["a", "b", "c", "e"], [0.25, 0.5, 0.75], keys)
    assert len(plans) == 2
    for plan in plans:
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Relation [a" in line)
        innermost = max(i for i in range(scan) if "Aggregate" in lines[i])
        assert not any("Generate" in line for line in lines[innermost:scan])
    # Nothing after these two reads the source.
    assert "Relation [a" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_only_values_in_brackets_are_kept(spark, monkeypatch):
    _, df = columns_of_all_kinds(spark, 60_000)
    kept = []
    monkeypatch.setattr(O, "_interpolated", lambda entries, *a, f=O._interpolated: kept.append(entries.count()) or f(entries, *a))
    row = O.wide_quantiles(df, ["e"], [0.5]).first()
    assert row.q0 == 29_999.5 and kept[0] < 100


def test_quantiles_with_nan(spark):
    rows = [(float(i),) for i in range(500)] + [(float("nan"),)] * 100
    row = O.exact_quantiles(spark.createDataFrame(rows, "v DOUBLE"), "v", [0.5, 0.9]).first()
    assert row.q0 == 299.5 and np.isnan(row.q1)


@pytest.mark.parametrize("parts", ["4", "1", "37"])
def test_rank_with_bounds_from_a_table_runs_the_rows_once(spark, hot, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        seen = spark.sparkContext.accumulator(0)
        keys = hot.select("k", "id")
        costly = hot.where("id % 3 <> 1").rdd.map(lambda r: (seen.add(1), r)[1]).toDF(hot.schema)
        ranked = O.global_rank(costly, ["k", "id"], "r", total="n", key_source=keys).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    n = hot.where("id % 3 <> 1").count()
    assert seen.value == n
    got = sorted(ranked, key=lambda x: x.r)
    assert [x.r for x in got] == list(range(1, n + 1)) and {x.n for x in got} == {n}
    order = [(x.k is not None, x.k or 0, x.id) for x in got]
    assert order == sorted(order)


def test_rank_with_bounds_spreads_copies_and_takes_empty_tables(spark):
    same = spark.range(20_000).selectExpr("1 a", "id b")
    placed = O._placed_by(same, ["a"], same)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000
    assert O.global_rank(same, ["a"], "r", key_source=same.limit(0)).agg(F.max("r")).first()[0] == 20_000
    assert O.global_rank(same.limit(0), ["a"], "r", key_source=same).count() == 0


@pytest.mark.parametrize("ids, want", [
    ([5, 6, 7], 5), ([7, 5, 6], 5), ([5, 7], None), ([5, 5, 7], None), ([], None), ([None], None), ([1, None], None),
    ([-1, 0, 1], -1), (list(range(32_760, 32_780)), 32_760),
])
def test_dense_start(spark, ids, want):
    assert O.dense_start(spark.createDataFrame([(i,) for i in ids], "k LONG"), "k") == want
