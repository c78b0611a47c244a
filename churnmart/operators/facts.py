"""Transaction fact: key resolution, referential checks, point-in-time lookup."""

from pyspark.sql import Column, DataFrame, functions as F

from churnmart.functions.exprs import col, rate_pct
from churnmart.operators.joins import HotKeys, salted_join
from churnmart.operators.ordering import dense_start, surrogate_key
from churnmart.schemas import FACT_TRANSACTIONS, enforce_schema


def customer_lookup(dim_customer: DataFrame) -> DataFrame:
    """One key per customer: the current version's, the last one on a tie."""
    return (
        dim_customer.where("is_current = 1")
        .groupBy("customer_id").agg(F.max("customer_sk").alias("customer_sk"))
    )


def _day_number(day: Column) -> Column:
    """yyyyMMdd as a number, by arithmetic where the year has a plain form."""
    number = F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(F.year(day).between(1, 9999), number).otherwise(F.date_format(day, "yyyyMMdd").cast("int"))


def build_fact(transactions: DataFrame, dim_customer: DataFrame,
               dim_product: DataFrame) -> DataFrame:
    """Transactions with resolved keys; a failed lookup leaves the key NULL.

    ``transactions`` should be a written table: its hot customers and products are
    counted first, where a dimension is too large to broadcast, and their rows are spread by
    transaction. Keys follow the transaction ids; if these are one run without gaps, as the
    feed numbers them, the keys are that run from one on and nothing is sorted.
    """
    feed = transactions.select(
        "transaction_id", "customer_id", "transaction_date", "transaction_year",
        "transaction_month", "transaction_type", "channel", "product_id", "amount", "churn_flag",
    )
    hot = HotKeys(transactions, "customer_id", "product_id")
    keyed = salted_join(
        feed, customer_lookup(dim_customer), "customer_id", F.xxhash64("transaction_id"), hot=hot,
    )
    products = dim_product.select("product_id", "product_sk")
    resolved = salted_join(
        keyed, products, "product_id", F.xxhash64("transaction_id"), hot=hot
    ).withColumn("date_sk", _day_number(F.col("transaction_date")))
    first = dense_start(transactions, "transaction_id")
    if first is None:
        numbered = surrogate_key(resolved, "transaction_sk", ["transaction_id"], key_source=transactions)
    else:
        numbered = resolved.withColumn("transaction_sk", F.col("transaction_id") - first + 1)
    return enforce_schema(numbered, FACT_TRANSACTIONS)


def key_resolution(fact: DataFrame) -> DataFrame:
    """How many fact rows found each key, one row."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count("customer_sk").alias("customer_sk_resolved"),
        F.count("product_sk").alias("product_sk_resolved"),
        F.count("date_sk").alias("date_sk_resolved"),
    )


def orphan_counts(fact: DataFrame, dimensions: dict) -> DataFrame:
    """Fact rows without a partner per foreign key; a NULL key is an orphan as well.

    ``dimensions`` maps the key column to its dimension. Fact rows are counted per key
    value before each join, so only distinct keys meet the dimension. An outer join with
    a NULL test keeps it that way: an anti-join would be moved below the count.
    """
    parts = []
    for fk, dim in dimensions.items():
        used = fact.groupBy(col(fk)).agg(F.count(F.lit(1)).alias("n"))
        known = dim.select(fk).distinct().withColumn("known", F.lit(1))
        lost = used.join(known, fk, "left").where("known is null")
        parts.append(lost.agg(
            F.lit(fk).alias("foreign_key"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def as_of_versions(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Each transaction with the customer version that was valid on its day (or none).

    An equi-join on the customer with the validity range as a residual, so it stays a
    hash or merge join. Versions of one customer do not overlap: at most one matches.
    """
    versions = dim_customer.select(
        "customer_id",
        F.col("customer_sk").alias("version_sk"),
        "record_version",
        "geography",
        "effective_start_date",
        "effective_end_date",
    )
    valid = (F.col("transaction_date") >= F.col("effective_start_date")) & (
        F.col("transaction_date") <= F.col("effective_end_date")
    )
    rows = fact.select("transaction_id", "customer_id", "transaction_date", "amount")
    joined = salted_join(
        rows, versions, "customer_id", F.xxhash64("transaction_id"), "left", valid,
        hot=HotKeys(fact, "customer_id"),
    )
    return joined.drop("effective_start_date", "effective_end_date")


def fact_profile(fact: DataFrame) -> DataFrame:
    """Size, date range, customers and amount statistics, one row."""
    return fact.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("amount").alias("total_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def date_profile(dim_date: DataFrame) -> DataFrame:
    return dim_date.agg(
        F.count(F.lit(1)).alias("days"),
        F.min("full_date").alias("first_date"),
        F.max("full_date").alias("last_date"),
        F.count_distinct("year").alias("years"),
        F.count_if(F.col("is_weekend") == 1).alias("weekend_days"),
        F.count_if(F.col("is_weekend") == 0).alias("weekdays"),
    )


def table_inventory(tables: dict) -> DataFrame:
    """Row count and status per table; a table given as None is missing."""
    out = None
    for name, table in tables.items():
        if table is None:
            continue
        part = table.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        ).withColumn("status", F.lit("OK"))
        out = part if out is None else out.unionByName(part)
    missing = [name for name, table in tables.items() if table is None]
    if missing and out is not None:
        names = F.array(*[F.lit(name) for name in missing])
        gone = out.sparkSession.range(1).select(
            F.explode(names).alias("table_name"),
            F.lit(0).cast("long").alias("row_count"),
            F.lit("MISSING").alias("status"),
        )
        out = out.unionByName(gone)
    return out


def churn_metric(dim_customer: DataFrame) -> DataFrame:
    """Churned, active and rate over current customers, one row."""
    churned, rows = F.sum("churn_flag"), F.count(F.lit(1))
    return dim_customer.where("is_current = 1").agg(
        churned.alias("churned"), (rows - churned).alias("active"),
        rate_pct(churned, rows).alias("churn_rate"),
    )
