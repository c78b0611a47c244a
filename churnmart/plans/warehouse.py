"""The star schema from raw feeds: stage, merge history, build dimensions and fact."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnmart import constants as C
from churnmart.operators import scd2
from churnmart.operators.dimensions import (
    churn_reason_dimension,
    date_dimension,
    product_dimension,
)
from churnmart.operators.facts import build_fact
from churnmart.plans.staging import feed_rows, stage_customers
from churnmart.schemas import DIM_CUSTOMER, enforce_schema, require_not_null
from churnmart.session import materialize
from churnmart.sources.readers import run_sql

TABLES = ("dim_customer", "dim_product", "dim_date", "dim_churn_reason", "fact_transactions")


@dataclass
class Warehouse:
    """The five tables, each a DataFrame over written files."""

    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    dim_churn_reason: DataFrame
    fact_transactions: DataFrame

    def tables(self) -> dict:
        return {name: getattr(self, name) for name in TABLES}

    def sql(self, text: str, args: dict | None = None) -> DataFrame:
        """The user's own SQL over the five tables, named in braces."""
        return run_sql(self.dim_customer.sparkSession, self.tables(), text, args)


def customer_history(snapshot: DataFrame, feed: DataFrame, snapshot_date: date,
                     feed_date: date) -> DataFrame:
    """Initial load of ``snapshot`` and one incremental merge of ``feed``.

    Derived columns of the feed are computed before the merge, so that a new version
    never carries the bands and scores of the old one.
    """
    dimension = materialize(stage_customers(snapshot, snapshot_date), "dimension")
    incoming = scd2.latest_per_key(feed_rows(feed), C.RAW_ORDER)
    return scd2.merge(dimension, incoming, feed_date)


def customer_dimension(history: DataFrame) -> DataFrame:
    return require_not_null(enforce_schema(history, DIM_CUSTOMER), DIM_CUSTOMER)


def store_customer_dimension(history: DataFrame) -> DataFrame:
    """Stored by ``is_current``: the marts read the current partition only."""
    return materialize(customer_dimension(history), "dim_customer", ["is_current"])


def calendar_for(spark: SparkSession, transactions: DataFrame) -> DataFrame:
    """Every day from the first to the last transaction."""
    span = transactions.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    return date_dimension(spark, span[0], span[1])


def build_warehouse(spark: SparkSession, history: DataFrame, products: DataFrame,
                    transactions: DataFrame, customers: DataFrame,
                    survey: DataFrame) -> Warehouse:
    """Dimensions first, then the fact that looks its keys up in them.

    ``transactions`` is a written feed; ``customers`` has customer_id and churn_flag.
    """
    dim_customer = store_customer_dimension(history)
    dim_product = materialize(product_dimension(products), "dim_product")
    return Warehouse(
        dim_customer=dim_customer,
        dim_product=dim_product,
        dim_date=materialize(calendar_for(spark, transactions), "dim_date"),
        dim_churn_reason=materialize(churn_reason_dimension(customers, survey), "dim_churn_reason"),
        fact_transactions=materialize(
            build_fact(transactions, dim_customer, dim_product), "fact_transactions"
        ),
    )
