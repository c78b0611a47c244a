from datetime import date

import pytest
from pyspark.sql import functions as F

from churnmart.constants import TRACKED_COLUMNS
from churnmart.operators import scd2
from churnmart.session import new_path
from churnmart.sources import bankview
from churnmart.streaming.scd2_feed import DimensionVersions, merge_stream

LOAD = date(2020, 6, 1)
DIM = (
    "customer_sk BIGINT, customer_id BIGINT, geography STRING, num_of_products INT, "
    "is_active_member INT, has_cr_card INT, risk_score INT, effective_start_date DATE, "
    "effective_end_date DATE, is_current INT, record_version INT, extra STRING"
)
FEED = (
    "customer_id BIGINT, geography STRING, num_of_products INT, is_active_member INT, "
    "has_cr_card INT, risk_score INT"
)
OPEN, START = date(9999, 12, 31), date(2020, 1, 1)


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([
        (1, 10, "France", 1, 1, 1, 2, START, OPEN, 1, 1, "a"),
        (2, 11, "Spain", 2, 1, 0, 3, START, date(2020, 3, 1), 0, 1, "b"),
        (4, 11, "Spain", 3, 1, 0, 3, date(2020, 3, 2), OPEN, 1, 2, "b"),
        (3, 12, None, 1, 0, 0, 4, START, OPEN, 1, 1, "c"),
        (5, 13, "Italy", 1, 1, 1, 1, START, OPEN, 1, 1, "d"),
    ], DIM)


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame([
        (10, "France", 1, 1, 1, 9),
        (11, "France", 4, 1, 0, 7),
        (12, None, 1, 1, 0, 5),
        (99, "Spain", 1, 1, 1, 1),
        (98, "Spain", 1, 1, None, 1),
    ], FEED)


def invariants(df):
    assert df.count() == df.select("customer_sk").distinct().count()
    current = df.where("is_current = 1")
    assert current.count() == df.select("customer_id").distinct().count()
    assert current.where(F.col("effective_end_date") != F.lit(OPEN)).count() == 0
    a, b = df.alias("a"), df.alias("b")
    overlap = a.join(b, (F.col("a.customer_id") == F.col("b.customer_id"))
                     & (F.col("a.customer_sk") < F.col("b.customer_sk"))
                     & (F.col("a.effective_start_date") <= F.col("b.effective_end_date"))
                     & (F.col("b.effective_start_date") <= F.col("a.effective_end_date")))
    assert overlap.count() == 0


def test_classify_is_null_safe(dimension, feed):
    got = {r.customer_id: r.status for r in scd2.classify(dimension, feed).collect()}
    assert got == {10: "unchanged", 11: "changed", 12: "changed", 98: "new", 99: "new"}


def test_change_log_has_one_row_per_column(dimension, feed):
    log = scd2.change_log(scd2.classify(dimension, feed), LOAD)
    got = sorted((r.customer_id, r.column_changed, r.old_value, r.new_value) for r in log.collect())
    assert got == [
        (11, "geography", "Spain", "France"), (11, "num_of_products", "3", "4"),
        (12, "is_active_member", "0", "1"),
    ]


def test_merge(dimension, feed):
    merged = scd2.merge(dimension, feed, LOAD)
    invariants(merged)
    rows = {r.customer_sk: r for r in merged.collect()}
    assert len(rows) == 9
    # Versions first, then new customers, without a gap.
    assert [(sk, rows[sk].customer_id, rows[sk].record_version) for sk in (6, 7, 8, 9)] == [
        (6, 11, 3), (7, 12, 2), (8, 98, 1), (9, 99, 1),
    ]
    assert rows[4].is_current == 0 and rows[4].effective_end_date == date(2020, 5, 31)
    assert rows[2].effective_end_date == date(2020, 3, 1)
    assert rows[6].effective_start_date == LOAD and rows[6].risk_score == 7
    # Untouched: unchanged in the feed, and absent from it.
    assert rows[1].risk_score == 2 and rows[5].is_current == 1
    # Columns the feed does not have are NULL in what it adds.
    assert rows[6].extra is None and rows[4].extra == "b"


def test_merging_again_changes_nothing(dimension, feed):
    once = scd2.merge(dimension, feed, LOAD)
    twice = scd2.merge(once, feed, date(2020, 7, 1))
    assert sorted(map(tuple, once.drop("extra").collect()), key=str) == sorted(
        map(tuple, twice.drop("extra").collect()), key=str)


def test_merge_into_an_empty_dimension(spark, feed):
    merged = scd2.merge(spark.createDataFrame([], DIM), feed, LOAD)
    assert sorted(r.customer_sk for r in merged.collect()) == [1, 2, 3, 4, 5]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "z", None)],
                               "customer_id BIGINT, x STRING, at INT")
    got = sorted(map(tuple, scd2.latest_per_key(df, "at").collect()))
    assert got == [(1, "b"), (2, "z")]


def test_history_and_verify(dimension, feed):
    merged = scd2.merge(dimension, feed, LOAD)
    v = scd2.verify(merged).first()
    assert (v.total_rows, v.current_rows, v.historical_rows, v.multi_version_customers) == (9, 6, 3, 2)
    assert [r.record_version for r in scd2.history(merged, 11).collect()] == [1, 2, 3]
    assert {r.customer_id for r in scd2.history(merged).collect()} == {11, 12}


def test_fixture_merge_keeps_the_invariants(bank):
    invariants(bank.merged)
    # A new version carries bands and scores of its own values.
    stale = bank.merged.where("is_current = 1 AND record_version = 2").where(
        "(num_of_products >= 3 AND risk_score < 3) OR (is_active_member = 0 AND risk_score < 3)")
    assert stale.count() == 0


def stream_parts(spark, bank, files):
    root = new_path(spark, "stream-test")
    feed = bank.incoming.withColumn("at", F.lit(1))
    for i in range(files):
        feed.where(F.col("customer_id") % files == i).coalesce(1).write.mode("append").parquet(
            f"{root}/feed")
    versions = DimensionVersions(spark, f"{root}/dimension")
    versions.write(0, bank.dimension)
    return root, feed, versions


def test_stream_of_many_batches_equals_one_merge(spark, bank):
    root, feed, versions = stream_parts(spark, bank, 4)
    args = (spark, f"{root}/feed", feed.schema, versions, bankview.FEED_LOAD, "at")
    reached = merge_stream(*args, checkpoint=f"{root}/state", files_per_batch=1)
    assert reached == 4
    got = versions.read(reached)
    invariants(got)
    # Keys depend on the order of arrival; everything else must be equal.
    columns = [c for c in bank.merged.columns if c != "customer_sk"]
    assert got.select(columns).exceptAll(bank.merged.select(columns)).count() == 0
    assert got.count() == bank.merged.count()

    # Started again with nothing new: same version.
    assert merge_stream(*args, checkpoint=f"{root}/state") == 4
    # The whole feed once more (a lost checkpoint): nothing changes.
    bank.incoming.withColumn("at", F.lit(2)).write.mode("append").parquet(f"{root}/feed")
    again = merge_stream(*args, checkpoint=f"{root}/state")
    assert again == 5 and versions.read(again).exceptAll(got).count() == 0
    assert versions.read(again).count() == got.count()
    # Older states stay readable.
    assert versions.read(0).exceptAll(bank.dimension.select(versions.read(0).columns)).count() == 0


def test_a_batch_replayed_after_a_crash_ends_in_the_same_state(spark, bank):
    root, feed, versions = stream_parts(spark, bank, 1)
    # What an unfinished attempt at version 1 may leave behind.
    bank.dimension.limit(3).write.partitionBy("is_current").parquet(versions.path(1))
    reached = merge_stream(
        spark, f"{root}/feed", feed.schema, versions, bankview.FEED_LOAD, "at",
        checkpoint=f"{root}/state",
    )
    assert reached == 1
    got = versions.read(1).select(bank.merged.columns)
    assert got.exceptAll(bank.merged).count() == 0 and got.count() == bank.merged.count()


def small_stream(spark, rows, label):
    """A stream over a dimension of three customers; ``feed(rows)`` adds a file and merges."""
    root = new_path(spark, label)
    columns = ("customer_id LONG, geography STRING, num_of_products INT, is_active_member INT, at INT")
    versions = DimensionVersions(spark, f"{root}/dimension")
    start = spark.createDataFrame(
        [(i, i, "A", 1, 1, date(2020, 1, 1), scd2.HIGH_DATE, 1, 1) for i in (1, 2, 3)],
        "customer_sk LONG, customer_id LONG, geography STRING, num_of_products INT, is_active_member INT, "
        "effective_start_date DATE, effective_end_date DATE, is_current INT, record_version INT")
    rest = {c: F.lit(1) for c in TRACKED_COLUMNS if c not in start.columns}
    versions.write(0, start.withColumns(rest))

    def feed(rows, day=date(2020, 6, 1), state="state"):
        df = spark.createDataFrame(rows, columns).withColumns(rest)
        df.coalesce(1).write.mode("append").parquet(f"{root}/feed")
        return merge_stream(spark, f"{root}/feed", df.schema, versions, day, "at", f"{root}/{state}")

    return versions, feed


def shown(versions, version):
    rows = versions.read(version).collect()
    return sorted((r.customer_id, r.record_version, r.geography, r.is_current) for r in rows)


def test_stream_keeps_what_another_checkpoint_merged(spark):
    versions, feed = small_stream(spark, [], "stream-again")
    assert feed([(1, "B", 1, 1, 1), (7, "B", 1, 1, 1)]) == 1
    # A new checkpoint starts at batch 0 and merges the old file again.
    assert feed([(8, "C", 1, 1, 1)], state="other") == 2
    assert shown(versions, 2) == [(1, 1, "A", 0), (1, 2, "B", 1), (2, 1, "A", 1), (3, 1, "A", 1), (7, 1, "B", 1), (8, 1, "C", 1)]
    with pytest.raises(ValueError, match="finished"):
        versions.write(2, versions.read(1))


def test_late_rows_change_nothing_and_order_outlives_unchanged_rows(spark):
    versions, feed = small_stream(spark, [], "stream-late")
    feed([(1, "B", 1, 1, 9), (2, "A", 1, 1, 9)])
    reached = feed([(1, "Z", 1, 1, 2), (2, "Z", 1, 1, 2), (3, "C", 1, 1, 2)])
    assert shown(versions, reached) == [(1, 1, "A", 0), (1, 2, "B", 1), (2, 1, "A", 1), (3, 1, "A", 0), (3, 2, "C", 1)]


def test_same_day_change_replaces_the_version_of_the_day(spark):
    versions, feed = small_stream(spark, [], "stream-day")
    feed([(1, "B", 1, 1, 1)])
    reached = feed([(1, "C", 1, 1, 2)])
    assert shown(versions, reached) == [(1, 1, "A", 0), (1, 2, "C", 1), (2, 1, "A", 1), (3, 1, "A", 1)]
    reached = feed([(1, "D", 1, 1, 3)], day=date(2020, 6, 2))
    rows = versions.read(reached).where("customer_id = 1").orderBy("record_version").collect()
    assert [(r.geography, r.record_version) for r in rows] == [("A", 1), ("C", 2), ("D", 3)]
    assert all(r.effective_start_date <= r.effective_end_date for r in rows)


def test_rows_without_a_key_are_set_aside(spark):
    versions, feed = small_stream(spark, [], "stream-null")
    reached = feed([(None, "B", 1, 1, 1), (1, "B", 1, 1, 1)])
    assert versions.read(reached).where("customer_id is null").count() == 0
    assert versions.rejected().count() == 1


def test_merge_refuses_rows_without_a_key(dimension, feed):
    keyless = feed.withColumn("customer_id", F.when(F.col("customer_id") > 0, None))
    with pytest.raises(ValueError, match="without customer_id"):
        scd2.merge(dimension, keyless, LOAD)


def test_closed_versions_do_not_meet_the_feed(bank):
    plan = scd2.merge(bank.dim_customer, bank.incoming, date(2030, 1, 1))._jdf.queryExecution().optimizedPlan().toString()
    # The join reads current rows only.
    left = plan.split("Join")[1].split("Relation")[0]
    assert "is_current" in left and "= 1" in left


def stored(spark, label, n=400, **options):
    """A stored dimension of ``n`` customers, and feeds that change some of them."""
    versions = DimensionVersions(spark, f"{new_path(spark, label)}/dimension", **options)
    rest = {c: F.lit(1) for c in TRACKED_COLUMNS if c not in ("geography", "num_of_products")}
    rows = spark.range(1, n + 1).selectExpr(
        "id customer_sk", "id customer_id", "'A' geography", "1 num_of_products", "date'2020-01-01' effective_start_date",
        "date'9999-12-31' effective_end_date", "1 is_current", "1 record_version")
    versions.write(0, rows.withColumns(rest))

    def feed(ids, value):
        return spark.createDataFrame([(i, value, 1) for i in ids], "customer_id LONG, geography STRING, num_of_products INT").withColumns(rest)

    return versions, feed


def files_of(versions):
    """Path and write time of every data file."""
    import os

    root = versions.root.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def rows_in(spark, files):
    return spark.read.parquet(*files).count() if files else 0


def test_a_load_writes_its_changes_and_touches_no_file(spark):
    versions, feed = stored(spark, "load")
    before = files_of(versions)
    assert scd2.load(versions, feed([1, 2, 500], "B"), date(2020, 2, 1)) == 1
    after = files_of(versions)
    assert {f: t for f, t in after.items() if f in before} == before
    # Two closed rows, two new versions, one new customer.
    assert rows_in(spark, set(after) - set(before)) == 5
    assert scd2.load(versions, feed([1], "C"), date(2020, 3, 1)) == 2
    last = files_of(versions)
    assert {f: t for f, t in last.items() if f in after} == after and rows_in(spark, set(last) - set(after)) == 2
    invariants(versions.read(2))
    rows = versions.read(2).where("customer_id in (1, 2, 500)").orderBy("customer_id", "record_version").collect()
    assert [(r.customer_id, r.customer_sk, r.geography, r.is_current) for r in rows] == [
        (1, 1, "A", 0), (1, 401, "B", 0), (1, 404, "C", 1), (2, 2, "A", 0), (2, 402, "B", 1), (500, 403, "B", 1)]
    assert versions.read(0).count() == 400 and versions.read(1).count() == 403 and versions.last_key(2) == 404


def test_a_version_may_start_from_an_earlier_one(spark):
    versions, feed = stored(spark, "branch")
    scd2.load(versions, feed([1, 2], "B"), date(2020, 2, 1))
    reached = scd2.load(versions, feed([3], "C"), date(2020, 2, 1), base=0)
    assert reached == 2
    changed = versions.current(2).where("geography <> 'A'").collect()
    assert [(r.customer_id, r.customer_sk) for r in changed] == [(3, 401)]


@pytest.mark.parametrize("options", [{"buckets": 3, "most_deltas": 2, "compact_at": 9}, {"buckets": 2, "compact_at": 0.3}])
def test_compaction_changes_no_result(spark, options):
    plain, feed = stored(spark, "plain", 60, buckets=4, most_deltas=100, compact_at=100)
    packed, _ = stored(spark, "packed", 60, **options)
    for n in range(1, 4):
        rows = feed([*range(n, 60, 7), 100 + n], f"V{n}")
        day = date(2020, 1 + n, 1)
        assert scd2.load(plain, rows, day) == scd2.load(packed, rows, day) == n
        got, want = packed.read(n), plain.read(n)
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()
        invariants(got)
    kinds = {p["part"] for p in packed._manifest(3) if p["version"] > 0}
    assert "base" in kinds
    deltas: dict = {}
    for p in packed._manifest(3):
        deltas[p["bucket"]] = deltas.get(p["bucket"], 0) + (p["part"] == "delta")
    assert max(deltas.values()) <= options.get("most_deltas", 8)


def test_a_stream_batch_writes_as_much_as_it_changes(spark):
    versions, feed = stored(spark, "stream-size", 3000)
    root = versions.root.removesuffix("/dimension")
    written = []
    for n, ids in enumerate(([5], [6, 7], list(range(1, 301)))):
        df = feed(ids, f"V{n}").withColumn("at", F.lit(n))
        df.coalesce(1).write.mode("append").parquet(f"{root}/feed")
        before = files_of(versions)
        merge_stream(spark, f"{root}/feed", df.schema, versions, date(2020, 2 + n, 1), "at", f"{root}/state")
        after = files_of(versions)
        assert {f: t for f, t in after.items() if f in before} == before
        written.append(rows_in(spark, set(after) - set(before)))
    # A closed and an open row for each customer of the batch.
    assert written == [2, 4, 600]


def test_a_reader_lists_no_other_version(spark):
    versions, feed = stored(spark, "listing", 50, buckets=2)
    for n in range(1, 4):
        scd2.load(versions, feed([n], "B"), date(2020, 1 + n, 1))
    files = versions.read(1).inputFiles()
    assert files and not any("version=2" in f or "version=3" in f for f in files)
