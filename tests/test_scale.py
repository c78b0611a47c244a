"""Work that has to grow no faster than the rows."""

from bisect import bisect_right
from datetime import date

import pytest
from pyspark.sql import functions as F

from churnmart.functions import exprs as E
from churnmart.operators import facts, ordering as O, scd2
from churnmart.plans import catalog, marts
from churnmart.sources.history import DimensionVersions


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_monthly_trend_makes_one_bitmap_per_month_and_bucket(spark):
    days = spark.createDataFrame(
        [(20200131, 2020, 1, "January", "2020-01"), (20200130, 2020, 1, "January", "2020-01"),
         (20200201, 2020, 2, "February", "2020-02"), (20200401, 2020, 4, None, "2020-04")],
        "date_sk INT, year INT, month INT, month_name STRING, year_month STRING",
    )
    fact = spark.createDataFrame(
        [(20200131, 1, 1), (20200130, 1, 0), (20200130, 40_000, 0), (20200131, None, 1),
         (20200201, 2, 1), (20200401, None, 0), (None, 7, 1), (20190101, 7, 1)],
        "date_sk INT, customer_sk BIGINT, churn_flag INT",
    )
    trend = marts.monthly_churn_trend(fact, days)
    got = [(r.year_month, r.month_name, r.total_transactions, r.churned_txns, r.churn_rate) for r in trend.collect()]
    assert got == [("2020-01", "January", 2, 2, 50.0), ("2020-02", "February", 1, 1, 100.0), ("2020-04", None, 0, 0, 0.0)]
    # The rows of a month and bucket meet before a bitmap is made.
    before_bitmaps = plan_of(trend).rsplit("bitmap_construct_agg", 1)[1]
    assert "REPARTITION_BY_COL" in before_bitmaps


def test_ranked_join_shuffles_rows_once_and_spreads_a_hot_key(spark, monkeypatch):
    # Many blocks though the session has four partitions.
    monkeypatch.setattr(O, "_BLOCK_ROWS", 500)
    lines = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 101 != 0, F.col("id") % 50).alias("k"),
        (F.col("id") % 7).alias("a"), "id",
    )
    # Key 7 twice, key 9 and NULL without a partner, 1000 without a line.
    orders = spark.createDataFrame(
        [(k, f"o{k}") for k in [*range(9), *range(10, 50), 1000, None]] + [(7, "again")], "o LONG, name STRING")
    table = lines.localCheckpoint()
    ranked = O.ranked_join(table, orders, "o", ["k", "a", "id"], "r", {
        "key": F.col("k"), "a": F.col("a"), "id": F.col("id"), "name": F.col("name")}, key_source=table)
    assert ranked.columns == ["r", "key", "a", "id", "name"]
    got = sorted(ranked.collect())
    want = table.join(orders, F.col("k") == F.col("o")).select("k", "a", "id", "name")
    assert [r.r for r in got] == list(range(1, want.count() + 1))
    assert sorted((r.key, r.a, r.id, r.name) for r in got) == sorted(map(tuple, want.collect()))
    order = [(r.key, r.a, r.id) for r in got]
    assert order == sorted(order)
    bounds, firsts, parts = O._bounds(table.where("k IS NOT NULL"), ["k", "a", "id"])
    placed = O._in_blocks(table.where("k = 7"), ["k", "a", "id"], bounds, parts)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert parts == 12 and len(sizes) >= 5 and max(sizes) < 1500
    assert O.ranked_join(table.limit(0), orders, "o", ["k", "a", "id"], "r", {"id": F.col("id")}, key_source=table).count() == 0


def test_transactions_shuffle_no_line_to_find_its_order(bank, monkeypatch):
    from churnmart.sources import bankview

    plans = []
    original = O.materialize
    monkeypatch.setattr(O, "materialize", lambda df, label, *a: (plans.append((label, plan_of(df), df.columns)), original(df, label, *a))[1])
    bankview.transactions(bank.spark, bank.folder, bank.raw, bank.products)
    [(_, plan, columns)] = [p for p in plans if p[0] == "rank-transaction_id"]
    assert "hashpartitioning(l_orderkey" not in plan and plan.count("shufflepartitionidpassthrough") == 2
    assert not set(bankview.LINE_KEY) & set(columns)


def test_first_version_is_computed_once_besides_its_ranges(spark, bank):
    from churnmart.session import new_path

    seen = spark.sparkContext.accumulator(0)
    source = bank.dimension.withColumn("is_current", (F.col("customer_id") % 5 != 0).cast("int"))
    rows = source.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(source.schema)
    versions = DimensionVersions(spark, new_path(spark, "once"))
    versions.write(0, rows)
    n = source.count()
    assert seen.value == 2 * n
    assert sorted(versions.read(0).collect()) == sorted(source.select(versions.read(0).columns).collect())
    assert versions.closed(0).count() == source.where("is_current = 0").count() > 0
    assert versions.last_key(0) == source.agg(F.max("customer_sk")).first()[0]


def test_title_case_of_plain_and_other_text(spark):
    texts = ["", "o'brien SMITH-jones 3x", "Customer#000000001", "éCOLE d'été", "ab cd", "a1b", "x\ny", "ÀB c", None, "ab\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = [r.v for r in df.select("i", E.title_case(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [None if t is None else t.title() for t in texts]


def test_current_rows_of_deltas_meet_in_one_shuffle_and_no_join(spark):
    from churnmart.session import new_path

    versions = DimensionVersions(spark, new_path(spark, "one-shuffle"), buckets=2, compact_at=9)
    rows = spark.createDataFrame(
        [(i, i, "A", 1) for i in range(1, 9)] + [(9, None, "A", 1)], "customer_sk LONG, customer_id LONG, geography STRING, is_current INT")
    versions.write(0, rows)
    for n in (1, 2):
        versions.change(rows.where(F.col("customer_id") <= 5 - n).withColumn("geography", F.lit(f"V{n}")))
    plan = plan_of(versions.current(2))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(customer_id") == 1
    got = sorted((r.customer_id or 0, r.geography) for r in versions.current(2).collect())
    assert got == [(0, "A"), (1, "V2"), (2, "V2"), (3, "V2"), (4, "V1"), *[(i, "A") for i in (5, 6, 7, 8)]]


def test_changes_meet_the_current_rows_once(spark, bank, monkeypatch):
    reads = []
    original = scd2.materialize
    monkeypatch.setattr(scd2, "materialize", lambda df, label, *a: reads.append(label) or original(df, label, *a))
    delta = scd2.changes(bank.dimension, bank.incoming, scd2.HIGH_DATE, last_key=10**6)
    # Closed rows come from the written rows, not from a second join with the dimension.
    assert reads == ["scd2-delta"] and "Join" not in plan_of(delta.where("is_current = 0"))
    twice = scd2.changes(bank.dimension, bank.incoming.union(bank.incoming), scd2.HIGH_DATE, last_key=10**6)
    closed = twice.where("is_current = 0")
    assert closed.count() == closed.select("customer_sk").distinct().count() == delta.where("is_current = 0").count() > 0


@pytest.mark.parametrize("parts", [1, 2, 3, 16, 433])
def test_a_block_is_searched_with_two_names_a_step(spark, parts):
    # Planning puts the steps into each other: names to the power of the steps.
    class Steps(list):
        def withColumn(self, name, column):
            self.append(str(column))
            return self

    steps = O._with_block(Steps(), "__b", parts, lambda i: i < 5)
    assert all(step.count("__b") <= 2 for step in steps) and len(steps) <= 10
    bounds = [3 * (i // 2) for i in range(parts - 1)] or [None]
    rows = spark.range(-2, 3 * parts).withColumn("bounds", F.array(*[F.lit(b).cast("long") for b in bounds]))
    got = O._with_block(rows, "b", parts, lambda i: F.get("bounds", i) <= F.col("id")).select("id", "b").collect()
    assert all(r.b == bisect_right(bounds[:parts - 1], r.id) for r in got)


def test_ranked_join_sorts_by_a_key_that_tells_rows_apart_and_writes_rows_once(spark, monkeypatch):
    written, write = [], O.materialize

    def noted(df, label, *more):
        written.append((label, plan_of(df)))
        return write(df, label, *more)

    monkeypatch.setattr(O, "materialize", noted)
    lines = spark.range(300).selectExpr("id div 3 k", "id").localCheckpoint()
    orders = spark.range(100).selectExpr("id o", "cast(id AS STRING) name")
    ranked = O.ranked_join(lines, orders, "o", ["k", "id"], "r", {"id": F.col("id"), "name": F.col("name")}, key_source=lines)
    assert "Sort [__block" not in dict(written)["rank-r"]
    # The few block counts are written as well: a reader does not count the rows again.
    assert [label for label, _ in written] == ["bounds", "rank-r", "blocks"]
    assert "HashAggregate" not in plan_of(ranked)
    assert sorted((r.r, r.id, r.name) for r in ranked.collect()) == [(i + 1, i, str(i // 3)) for i in range(300)]


def test_transactions_are_not_written_twice(spark, folder, monkeypatch):
    written, write = [], catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, label, *more: written.append(label) or write(df, label, *more))
    assert catalog.Bank(spark, folder).transactions.select("transaction_id").distinct().count() > 5000
    assert "transactions" not in written


def test_day_numbers_need_no_formatting(spark):
    days = [date(1, 1, 1), date(1999, 12, 31), date(2024, 2, 29), date(9999, 12, 31), None]
    rows = spark.createDataFrame([(d,) for d in days], "d DATE").selectExpr("d").union(
        spark.sql("SELECT DATE'+10000-01-02' UNION ALL SELECT DATE'-0044-03-15'"))
    day = facts._day_number(F.col("d"))
    old = F.expr("try_cast(date_format(d, 'yyyyMMdd') AS INT)")
    got = rows.select(day.alias("new"), old.alias("old")).collect()
    assert all(r.new == r.old for r in got) and [r.new for r in got[:4]] == [10101, 19991231, 20240229, 99991231]
