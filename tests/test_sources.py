import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from churnmart import schemas
from churnmart.operators import dimensions
from churnmart.session import materialize, new_path, shared_dir
from churnmart.sources import readers, writers


def test_raw_csv_round_trip_keeps_nulls_and_white_space(spark, bank):
    path = new_path(spark, "raw-test")
    writers.overwrite_files(bank.dirty, path, "csv")
    back = readers.read_raw_customers(spark, path, "csv")
    assert back.exceptAll(bank.dirty).count() == 0 and back.count() == bank.dirty.count()


def test_missing_path_and_unknown_format_fail(spark):
    with pytest.raises(AnalysisException, match="nowhere"):
        readers.read_raw_customers(spark, "/tmp/nowhere-at-all.csv")
    with pytest.raises(ValueError):
        readers.read_table(spark, "/tmp/x", "a INT", "xml")


def test_bad_cell_fails_the_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|CANNOT_PARSE"):
        readers.read_table(spark, str(tmp_path / "x.csv"), "a INT, b INT").collect()


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a DOUBLE, b INT")
    assert [r.a for r in schemas.clean_numbers(df).orderBy("b").collect()] == [None, 2.0]


def test_append_adds_and_overwrite_replaces(spark):
    path = new_path(spark, "sink-test")
    writers.append_files(spark.range(3), path)
    writers.append_files(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6
    writers.overwrite_files(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_a_published_table_is_replaced_in_one_step(spark, monkeypatch):
    path = new_path(spark, "publish-test")
    with pytest.raises(FileNotFoundError):
        readers.published(spark, path)

    def now():
        return sorted(r.id for r in spark.read.parquet(readers.published(spark, path)).collect())

    first = writers.publish_files(spark.range(3), path)
    reader = spark.read.parquet(first)
    # A job that reads what it replaces.
    writers.publish_files(reader.unionByName(spark.range(3, 5)), path)
    assert now() == [0, 1, 2, 3, 4] and reader.count() == 3
    # A job that fails while it writes, and one that fails between write and publish.
    boom = F.raise_error(F.lit("boom")).cast("long")
    with pytest.raises(Exception, match="boom"):
        writers.publish_files(spark.range(100).select(F.when(F.col("id") == 99, boom).otherwise(F.col("id")).alias("id")), path)
    assert now() == [0, 1, 2, 3, 4]
    written = writers.overwrite_files

    def fails_afterwards(*args):
        written(*args)
        raise OSError("lost")

    monkeypatch.setattr(writers, "overwrite_files", fails_afterwards)
    with pytest.raises(OSError, match="lost"):
        writers.publish_files(spark.range(7), path)
    monkeypatch.undo()
    assert now() == [0, 1, 2, 3, 4]
    # Older folders go, the one before stays for its readers.
    writers.publish_files(spark.range(1), path)
    assert now() == [0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(first)
    writers.publish_files(spark.range(2), path)
    assert now() == [0, 1]


def test_enforce_schema_fills_defaults_and_rounds(spark):
    df = spark.createDataFrame(
        [(1, 10, 579.5, 10.005, date(2020, 1, 1))],
        "customer_sk INT, customer_id INT, credit_score DOUBLE, balance DOUBLE, "
        "effective_start_date DATE")
    out = schemas.enforce_schema(df, schemas.DIM_CUSTOMER)
    assert [f.name for f in out.schema] == [f.name for f in schemas.DIM_CUSTOMER.schema]
    row = out.first()
    assert row.credit_score == 580 and row.balance == Decimal("10.01")
    assert (row.churn_flag, row.high_value_flag, row.is_current, row.record_version) == (0, "N", 1, 1)
    assert row.effective_end_date == date(9999, 12, 31) and isinstance(row.created_at, datetime)
    assert row.surname is None


def test_not_null_is_checked(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (3, 3)], "product_sk INT, product_id INT")
    typed = schemas.enforce_schema(df, schemas.DIM_PRODUCT)
    found = schemas.not_null_violations(typed, schemas.DIM_PRODUCT).collect()
    assert {r.column: r.nulls for r in found} == {"product_sk": 1, "product_id": 1}
    with pytest.raises(Exception, match="NOT NULL"):
        schemas.require_not_null(typed, schemas.DIM_PRODUCT).collect()
    good = typed.where("product_id = 3")
    assert schemas.require_not_null(good, schemas.DIM_PRODUCT).count() == 1


def test_product_catalog_is_the_published_one(spark):
    rows = dimensions.product_dimension(dimensions.product_catalog(spark)).orderBy("product_sk").collect()
    # The published product table.
    assert [tuple(r) for r in rows] == [
        (1, 101, "Savings Account", "Deposit", Decimal("3.50"), 1, 2015),
        (2, 102, "Fixed Deposit", "Deposit", Decimal("6.80"), 1, 2015),
        (3, 103, "Personal Loan", "Loan", Decimal("12.50"), 1, 2015),
        (4, 104, "Credit Card", "Credit", Decimal("18.00"), 1, 2015),
    ]


def test_calendar_equals_python_dates(spark):
    days = dimensions.date_dimension(spark, date(2022, 1, 1), date(2024, 12, 31)).collect()
    assert len(days) == 1096
    for r in days:
        d = r.full_date
        assert r.date_sk == int(d.strftime("%Y%m%d")) and r.week_no == d.isocalendar()[1]
        assert r.day_of_week_no == d.isoweekday() and r.is_weekend == int(d.isoweekday() > 5)
        assert (r.month_name, r.month_short, r.day_name) == (
            d.strftime("%B"), d.strftime("%b"), d.strftime("%A"))
        assert (r.year_month, r.year_quarter) == (
            d.strftime("%Y-%m"), f"{d.year}-Q{(d.month + 2) // 3}")
    assert sum(r.is_month_start for r in days) == sum(r.is_month_end for r in days) == 36


def test_churn_reason_default(spark):
    customers = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "customer_id BIGINT, churn_flag INT")
    survey = spark.createDataFrame([(1, "Too many fees", "2020-01")],
                                   "customer_id BIGINT, churn_reason STRING, exit_month STRING")
    got = dimensions.churn_reason_dimension(customers, survey).orderBy("churn_reason_sk").collect()
    assert [(r.churn_reason_sk, r.customer_id, r.churn_reason, r.exit_month) for r in got] == [
        (1, 1, "Too many fees", "2020-01"), (2, 3, "N/A - Active Customer", None),
        (3, 2, "N/A - Active Customer", None),
    ]


def test_materialize_keeps_columns_rows_and_emptiness(spark):
    df = spark.range(10).withColumn("p", F.col("id") % 2).select("p", "id")
    back = materialize(df, "t", ["p"])
    assert back.columns == ["p", "id"] and back.exceptAll(df).count() == 0 and back.count() == 10
    assert materialize(df.where("id < 0"), "t", ["p"]).count() == 0


def test_append_table_adds_to_a_catalog_table(spark):
    writers.append_table(spark.range(3), "append_test")
    writers.append_table(spark.range(3), "append_test")
    assert spark.table("append_test").count() == 6


class _Session:
    """Only what shared_dir asks a session for."""

    def __init__(self, master, configured=None):
        self.configured = configured
        self.conf = self
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"

    def get(self, key, default=None):
        return "file:/tables/" if key == "spark.sql.warehouse.dir" else self.configured or default


def test_shared_folder_comes_from_the_session():
    assert shared_dir(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))
    assert shared_dir(_Session("local[2]")) == "file:/tables"


def test_temporary_tables_leave_nothing(spark, bank, folder):
    from churnmart.plans.catalog import queries
    from churnmart.session import new_path, temporary_tables

    queries()["q3"](spark, folder).collect()  # the bank's own tables
    root = os.path.dirname(new_path(spark, "probe"))
    before = sorted(os.listdir(root))
    for _ in range(2):
        with temporary_tables(spark):
            assert queries()["q3"](spark, folder).count() > 0
            assert sorted(os.listdir(root)) != before
        assert sorted(os.listdir(root)) == before
