"""Product, date and churn-reason dimensions."""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from churnmart import constants as C
from churnmart.functions.exprs import col, share_pct
from churnmart.operators.ordering import surrogate_key
from churnmart.schemas import DIM_CHURN_REASON, DIM_DATE, DIM_PRODUCT, enforce_schema


def product_catalog(spark: SparkSession) -> DataFrame:
    """The bank's own four products as a feed."""
    rows = [
        (i, name, category, Decimal(rate), 1, C.PRODUCT_LAUNCH_YEAR)
        for i, name, category, rate in C.PRODUCT_CATALOG
    ]
    return spark.createDataFrame(
        rows,
        "product_id BIGINT, product_name STRING, product_category STRING, "
        "interest_rate_pct DECIMAL(5,2), is_active INT, launch_year INT",
    )


def product_dimension(feed: DataFrame) -> DataFrame:
    return enforce_schema(surrogate_key(feed, "product_sk", ["product_id"]), DIM_PRODUCT)


def date_dimension(spark: SparkSession, start: date | Column, end: date | Column) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    first = start if isinstance(start, Column) else F.lit(start)
    last = end if isinstance(end, Column) else F.lit(end)
    days = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date")
    )
    d = F.col("full_date")
    year, quarter = F.year(d), F.quarter(d)
    spine = days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
        "full_date",
        year.alias("year"),
        quarter.alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.weekofyear(d).alias("week_no"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week_no"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(year, F.lit("-Q"), quarter).alias("year_quarter"),
    )
    return enforce_schema(spine, DIM_DATE)


def churn_reasons(customers: DataFrame, survey: DataFrame) -> DataFrame:
    """Reason and exit month per customer; the default for who is not in the survey.

    ``customers``: customer_id, churn_flag, one row each. ``survey``: customer_id,
    churn_reason, exit_month, one row per answering customer.
    """
    return customers.join(survey, "customer_id", "left").select(
        "customer_id",
        "churn_flag",
        F.coalesce(F.col("churn_reason"), F.lit(C.NO_CHURN_REASON)).alias("churn_reason"),
        "exit_month",
    )


def churn_reason_dimension(customers: DataFrame, survey: DataFrame) -> DataFrame:
    """Churned customers first, then the others, each in customer order."""
    keyed = surrogate_key(
        churn_reasons(customers, survey),
        "churn_reason_sk",
        [col("churn_flag").desc(), "customer_id"],
    )
    return enforce_schema(keyed, DIM_CHURN_REASON)


def reason_distribution(dim_churn_reason: DataFrame) -> DataFrame:
    """Reasons among churned customers with their share."""
    churned = dim_churn_reason.where("churn_flag = 1")
    total = churned.select(F.count(F.lit(1))).scalar()
    return churned.groupBy("churn_reason").agg(F.count(F.lit(1)).alias("customers")).withColumn(
        "pct", share_pct(F.col("customers"), total, 1)
    )
