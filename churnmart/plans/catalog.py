"""Every operator of the library as a named query over a folder of given tables.

A query is ``(spark, folder) -> DataFrame``. Feeds and warehouse tables that several
queries share are derived from the given tables once per application and written to the
shared folder, as a load job does before reports run.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnmart import constants as C
from churnmart.functions.exprs import bin_label, col
from churnmart.operators import cleanse, crosstab, derive, dimensions, facts, ordering, profile
from churnmart.operators import quality, scd2
from churnmart.plans import marts, staging, warehouse
from churnmart.plans.reports import export_reports
from churnmart.session import folder_state, materialize, new_path
from churnmart.sources import bankview, readers, writers
from churnmart.sources.history import DimensionVersions
from churnmart.streaming.scd2_feed import merge_stream


class Bank:
    """Feeds and tables derived from one folder, each written on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def raw(self) -> DataFrame:
        return materialize(bankview.raw_customers(self.spark, self.folder), "raw")

    @cached_property
    def dirty(self) -> DataFrame:
        return materialize(bankview.dirty_customers(self.raw), "dirty")

    @cached_property
    def cleansing(self) -> staging.Cleansing:
        return staging.cleanse_feed(self.dirty)

    @cached_property
    def dirty_cleansed(self) -> DataFrame:
        return self.cleansing.rows

    @cached_property
    def caps(self):
        return cleanse.fit_caps(self.dirty_cleansed)

    @cached_property
    def staged(self) -> DataFrame:
        staged = staging.stage_cleansed(self.dirty_cleansed, bankview.FEED_LOAD)
        return materialize(staged, "staged")

    @cached_property
    def history(self) -> DimensionVersions:
        """The stored dimension; version 0 is the initial load of the earlier snapshot."""
        feed = materialize(bankview.snapshot_customers(self.spark, self.folder), "snapshot")
        versions = DimensionVersions(self.spark, new_path(self.spark, "history"))
        versions.write(0, staging.stage_customers(feed, bankview.DIMENSION_LOAD))
        return versions

    @cached_property
    def dimension(self) -> DataFrame:
        return self.history.read(0)

    @cached_property
    def incoming(self) -> DataFrame:
        """The later feed, enriched, one row per customer."""
        feed = materialize(bankview.incoming_customers(self.raw), "incoming-raw")
        rows = staging.feed_rows(feed)
        return materialize(scd2.latest_per_key(rows, C.RAW_ORDER), "incoming")

    @cached_property
    def classified(self) -> DataFrame:
        return materialize(scd2.classify(self.dimension, self.incoming), "classified")

    @cached_property
    def merged(self) -> DataFrame:
        return self.history.read(scd2.load(self.history, self.incoming, bankview.FEED_LOAD, base=0))

    @cached_property
    def products(self) -> DataFrame:
        return materialize(bankview.products(self.spark, self.folder), "products")

    @cached_property
    def transactions(self) -> DataFrame:
        # Its rows and the ranks of its blocks are written by the ranked join: not once more.
        return bankview.transactions(self.spark, self.folder, self.raw, self.products)

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw.select(
            col("CustomerId").alias("customer_id"), col("Exited").alias("churn_flag")
        )

    @cached_property
    def survey(self) -> DataFrame:
        return materialize(bankview.exit_survey(self.spark, self.folder, self.raw), "survey")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return warehouse.store_customer_dimension(self.merged)

    @cached_property
    def dim_product(self) -> DataFrame:
        return materialize(dimensions.product_dimension(self.products), "dim_product")

    @cached_property
    def dim_date(self) -> DataFrame:
        return materialize(warehouse.calendar_for(self.spark, self.transactions), "dim_date")

    @cached_property
    def dim_churn_reason(self) -> DataFrame:
        reasons = dimensions.churn_reason_dimension(self.customers, self.survey)
        return materialize(reasons, "dim_churn_reason")

    @cached_property
    def fact(self) -> DataFrame:
        fact = facts.build_fact(self.transactions, self.dim_customer, self.dim_product)
        return materialize(fact, "fact_transactions")

    @cached_property
    def warehouse(self) -> warehouse.Warehouse:
        return warehouse.Warehouse(
            self.dim_customer, self.dim_product, self.dim_date, self.dim_churn_reason, self.fact
        )

    def rows_of(self, df: DataFrame):
        """Row count of a feed as a scalar subquery."""
        return df.select(F.count(F.lit(1))).scalar()


_BANKS: dict = {}


def bank(spark: SparkSession, folder: str) -> Bank:
    """The derived tables of ``folder`` as its files are now; changed files give new tables."""
    key = (spark.sparkContext.applicationId, folder, folder_state(spark, folder))
    if key not in _BANKS:
        _BANKS[key] = Bank(spark, folder)
    return _BANKS[key]


def reloaded(b: Bank, df: DataFrame, label: str, fmt: str) -> str:
    path = new_path(b.spark, label)
    writers.overwrite_files(df, path, fmt)
    return path


# --- sources and sinks -----------------------------------------------------------------


def scan_raw_customers(b: Bank) -> DataFrame:
    return readers.read_raw_customers(b.spark, reloaded(b, b.dirty, "raw-csv", "csv"), "csv")


def scan_staged_customers(b: Bank) -> DataFrame:
    path = reloaded(b, b.staged, "staged-csv", "csv")
    return readers.read_staged_customers(b.spark, path, "csv")


def sink_roundtrip(b: Bank) -> DataFrame:
    """A published table replaced by a job that reads it."""
    path = new_path(b.spark, "roundtrip")
    writers.publish_files(b.staged.where("customer_id % 2 = 0"), path)
    before = readers.read_staged_customers(b.spark, readers.published(b.spark, path))
    odd = b.staged.where("customer_id % 2 <> 0")
    writers.publish_files(before.unionByName(odd), path)
    return readers.read_staged_customers(b.spark, readers.published(b.spark, path))


def sink_append_twice(b: Bank) -> DataFrame:
    path = new_path(b.spark, "append")
    feed = b.transactions.select("transaction_id", "customer_id", "amount")
    writers.append_files(feed, path)
    writers.append_files(feed, path)
    return (
        readers.read_table(b.spark, path, feed.schema)
        .groupBy("transaction_id", "customer_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.sum("amount").cast("double").alias("amount"))
    )


def enforce_dim_customer_schema(b: Bank) -> DataFrame:
    typed = warehouse.customer_dimension(b.staged.drop("record_version"))
    return money_as_double(typed.drop("created_at"))


def money_as_double(df: DataFrame) -> DataFrame:
    return df.select(*[
        col(f.name).cast("double").alias(f.name)
        if f.dataType.typeName() == "decimal" else col(f.name)
        for f in df.schema
    ])


def table_inventory(b: Bank) -> DataFrame:
    return facts.table_inventory({
        **b.warehouse.tables(), "stg_customers": b.staged, "stg_archive": None,
    })


# --- staging ---------------------------------------------------------------------------


def etl_impute(b: Bank) -> DataFrame:
    return cleanse.impute(b.dirty, cleanse.fit_fill_values(b.dirty))


def etl_dedup(b: Bank) -> DataFrame:
    return cleanse.deduplicate(etl_impute(b)).drop(C.RAW_ORDER)


def etl_standardize(b: Bank) -> DataFrame:
    return cleanse.standardize(b.dirty)


def etl_cap(b: Bank) -> DataFrame:
    return cleanse.cap_outliers(b.dirty_cleansed, b.caps).drop(C.RAW_ORDER)


def etl_cap_counts(b: Bank) -> DataFrame:
    return cleanse.cap_counts(b.dirty_cleansed, b.caps)


DERIVED = (
    "AgeGroup", "CreditTier", "TenureBand", "HighValueFlag", "EstimatedLTV", "ChurnLabel",
    "BalanceSalaryRatio", "ProductEngagement",
)


def derive_columns(b: Bank) -> DataFrame:
    return derive.derive_columns(b.raw).select("CustomerId", *DERIVED)


def risk_score(b: Bank) -> DataFrame:
    scored = derive.risk_score(derive.derive_columns(b.raw))
    return scored.select("CustomerId", "RiskScore", "RiskCategory")


def stg_customers(b: Bank) -> DataFrame:
    return staging.stage_customers(b.dirty, bankview.FEED_LOAD)


def churn_by_risk(b: Bank) -> DataFrame:
    return profile.churn_table(b.staged, "risk_category", "risk_category", "churn_flag")


def risk_churn_corr(b: Bank) -> DataFrame:
    return profile.correlations(b.staged, [("risk_score", "churn_flag")], 3)


def quality_gate(b: Bank) -> DataFrame:
    return quality.quality_gate(b.staged, b.rows_of(b.dirty))


def report_etl_quality(b: Bank) -> DataFrame:
    return quality.etl_quality_report(b.staged, b.rows_of(b.dirty))


def preview_staged(b: Bank) -> DataFrame:
    return b.staged.orderBy("customer_sk").limit(5).select(
        "customer_sk", "customer_id", "geography", "age_group", "credit_tier", "churn_flag",
        "risk_category", "is_current",
    )


# --- history ---------------------------------------------------------------------------


def scd2_classify(b: Bank) -> DataFrame:
    return scd2.classify(b.dimension, b.incoming).select(
        "customer_id", "status", "old_sk", "old_version"
    )


def scd2_stream(b: Bank) -> DataFrame:
    """The feed through a file stream, one micro-batch per file.

    Four files hold every customer once. A fifth repeats every third customer as they were
    earlier: rows that arrive late and must change nothing. Keys follow the arrival and are
    left out.
    """
    root = new_path(b.spark, "stream")
    feed = b.incoming.withColumn("feed_order", F.lit(2))
    late = feed.where("customer_id % 3 = 0").withColumns({
        "feed_order": F.lit(1), "is_active_member": 1 - F.col("is_active_member")})
    files = [feed.where(F.col("customer_id") % 4 == i) for i in range(4)] + [late]
    versions = DimensionVersions(b.spark, f"{root}/dimension")
    versions.write(0, b.dimension)
    for rows in files:
        rows.write.mode("append").parquet(f"{root}/feed")
        reached = merge_stream(
            b.spark, f"{root}/feed", feed.schema, versions, bankview.FEED_LOAD, "feed_order",
            checkpoint=f"{root}/state",
        )
    return versions.read(reached).drop("customer_sk")


def scd2_merge(b: Bank) -> DataFrame:
    """The feed loaded into the stored dimension, as a version after the initial load."""
    return b.history.read(scd2.load(b.history, b.incoming, bankview.FEED_LOAD, base=0))


def scd2_asof_fact(b: Bank) -> DataFrame:
    return money_as_double(facts.as_of_versions(b.fact, b.dim_customer))


def fk_orphans(b: Bank) -> DataFrame:
    """A fact whose feed lost some keys and invented others, against whole dimensions."""
    n = F.col("transaction_id")
    late = b.fact.withColumns({
        "customer_sk": F.when(n % 89 != 0, F.col("customer_sk")),
        "product_sk": F.when(n % 97 == 0, F.col("product_sk") + 1_000_000).otherwise(F.col("product_sk")),
        "date_sk": F.when(n % 83 == 0, 19000101).otherwise(F.col("date_sk")),
    })
    return facts.orphan_counts(late, {
        "customer_sk": b.dim_customer, "product_sk": b.dim_product, "date_sk": b.dim_date,
    })


MONTHLY = """
SELECT d.year, d.month, d.year_month, COUNT(*) AS transactions,
       COUNT(DISTINCT f.customer_sk) AS customers, SUM(f.churn_flag) AS churned_txns
FROM {fact_transactions} f JOIN {dim_date} d ON f.date_sk = d.date_sk
GROUP BY d.year, d.month, d.year_month
"""


def sql_monthly(b: Bank) -> DataFrame:
    """A user's SQL text over the warehouse."""
    return b.warehouse.sql(MONTHLY)


# --- profiles --------------------------------------------------------------------------


def credit_tier_dist(b: Bank) -> DataFrame:
    return profile.banded_counts(b.raw, "CreditScore", C.CREDIT_TIERS_WITH_RANGE)


def zero_balance(b: Bank) -> DataFrame:
    return profile.churn_table(b.raw, col("Balance") == 0, "zero_balance")


GENDERS = {"Female": "female", "Male": "male"}
ACTIVE = {0: "inactive", 1: "active"}


def pivot_geo_gender(b: Bank) -> DataFrame:
    return crosstab.rate_pivot(b.raw, col("Geography"), "geography", col("Gender"), GENDERS)


def pivot_age_tenure(b: Bank) -> DataFrame:
    bands = {label: label for label in C.TENURE_BANDS.labels}
    return crosstab.rate_pivot(
        b.raw, bin_label(col("Age"), C.AGE_GROUPS), "age_group",
        bin_label(col("Tenure"), C.TENURE_BANDS), bands,
    )


def pivot_products_active(b: Bank) -> DataFrame:
    return crosstab.rate_pivot(
        b.raw, col("NumOfProducts"), "num_of_products", col("IsActiveMember"), ACTIVE
    )


def pivot_products_active_counts(b: Bank) -> DataFrame:
    return crosstab.count_pivot(
        b.raw, "NumOfProducts", "IsActiveMember", ACTIVE, "CustomerId"
    ).withColumnRenamed("NumOfProducts", "num_of_products")


def pivot_credit_value(b: Bank) -> DataFrame:
    value = F.when(col("Balance") > C.HIGH_VALUE_BALANCE, "High Value").otherwise("Standard")
    return crosstab.rate_pivot(
        b.raw, bin_label(col("CreditScore"), C.CREDIT_TIERS), "credit_tier", value,
        {"High Value": "high_value", "Standard": "standard"},
    )


# Fewer than the customers of the smallest tables that are checked.
SAMPLE = 500


def sample_customers(b: Bank) -> DataFrame:
    sample = ordering.hash_sample(b.raw, "CustomerId", SAMPLE)
    return sample.select(
        "CustomerId", "Age", "Balance", "Exited",
        (col("Balance") > C.HIGH_VALUE_BALANCE).cast("int").alias("high_value"),
    )


def report_export(b: Bank) -> DataFrame:
    """The customer report as users get it: exported to a CSV file with header, and read again."""
    [path] = export_reports(b.warehouse, new_path(b.spark, "reports"), names=["geo_gender_churn"])
    schema = marts.geo_gender_churn(b.dim_customer).schema
    return readers.read_table(b.spark, path, schema, "csv")


def positive_balance(b: Bank) -> DataFrame:
    return b.raw.where("Balance > 0")


CATALOG = {
    # sources and sinks
    "scan_raw_customers": scan_raw_customers,
    "scan_staged_customers": scan_staged_customers,
    "sink_roundtrip": sink_roundtrip,
    "sink_append_twice": sink_append_twice,
    "enforce_dim_customer_schema": enforce_dim_customer_schema,
    "table_inventory": table_inventory,
    # raw validation
    "column_inventory": lambda b: quality.column_inventory(b.dirty),
    "schema_diff": lambda b: quality.schema_diff(b.dirty),
    "null_profile": lambda b: quality.profile_nulls(b.dirty),
    "dup_profile": lambda b: quality.profile_duplicates(b.dirty),
    "dup_rows": lambda b: quality.duplicate_rows(b.dirty),
    "dup_keys": lambda b: quality.duplicate_keys(b.dirty),
    "churn_distribution": lambda b: quality.churn_distribution(b.dirty),
    "churn_by_geography": lambda b: profile.churn_table(b.raw, "Geography", "geography", share=True),
    "churn_by_gender": lambda b: profile.churn_table(b.dirty, "Gender", "gender"),
    "describe_numeric": lambda b: profile.describe_numeric(b.dirty),
    "outliers_iqr": lambda b: quality.outliers_iqr(b.dirty),
    "value_counts": lambda b: profile.value_counts(b.dirty),
    "report_validation": lambda b: quality.validation_report(b.dirty),
    # staging
    "etl_impute": etl_impute,
    "etl_dedup": etl_dedup,
    "etl_standardize": etl_standardize,
    "etl_cap": etl_cap,
    "etl_cap_counts": etl_cap_counts,
    "etl_step_counts": lambda b: staging.step_counts(b.cleansing, b.staged),
    "derive_columns": derive_columns,
    "risk_score": risk_score,
    "churn_by_risk": churn_by_risk,
    "risk_churn_corr": risk_churn_corr,
    "stg_customers": stg_customers,
    "quality_gate": quality_gate,
    "report_etl_quality": report_etl_quality,
    "preview_staged": preview_staged,
    # history
    "scd2_current": lambda b: scd2.current_versions(b.merged),
    "scd2_classify": scd2_classify,
    "scd2_change_log": lambda b: scd2.change_log(b.classified, bankview.FEED_LOAD),
    "scd2_merge": scd2_merge,
    "scd2_verify": lambda b: scd2.verify(b.merged),
    "scd2_history": lambda b: scd2.history(b.merged),
    "scd2_stream": scd2_stream,
    "scd2_asof_fact": scd2_asof_fact,
    # star schema
    "dim_customer": lambda b: money_as_double(
        warehouse.customer_dimension(b.merged).drop("created_at")
    ),
    "dim_product": lambda b: money_as_double(dimensions.product_dimension(b.products)),
    "dim_date": lambda b: warehouse.calendar_for(b.spark, b.transactions),
    "dim_churn_reason": lambda b: dimensions.churn_reason_dimension(b.customers, b.survey),
    "fact_transactions": lambda b: money_as_double(
        facts.build_fact(b.transactions, b.dim_customer, b.dim_product)
    ),
    "fact_key_resolution": lambda b: facts.key_resolution(b.fact),
    "fk_orphans": fk_orphans,
    "warehouse_churn_metric": lambda b: facts.churn_metric(b.dim_customer),
    "fact_profile": lambda b: money_as_double(facts.fact_profile(b.fact)),
    "fact_value_counts": lambda b: profile.value_counts(b.fact, ("transaction_type", "channel")),
    "fact_amount_stats": lambda b: profile.describe_numeric(b.fact, ["amount"]),
    "dim_date_years": lambda b: profile.distinct_values(b.dim_date, "year"),
    "dim_date_profile": lambda b: facts.date_profile(b.dim_date),
    "churn_reason_dist": lambda b: dimensions.reason_distribution(b.dim_churn_reason),
    # marts
    "q1": lambda b: marts.geo_gender_churn(b.dim_customer),
    "q2": lambda b: marts.revenue_at_risk(b.dim_customer),
    "q3": lambda b: marts.ltv_segments(b.dim_customer),
    "q4": lambda b: marts.monthly_churn_trend(b.fact, b.dim_date),
    "q5": lambda b: marts.product_analysis(b.fact, b.dim_product),
    "q6": lambda b: marts.at_risk_customers(b.dim_customer),
    "q7": lambda b: marts.credit_tier_churn(b.dim_customer),
    "q8": lambda b: marts.member_status_churn(b.dim_customer),
    "q9": lambda b: marts.tenure_band_churn(b.dim_customer),
    "q10": lambda b: marts.executive_kpis(b.dim_customer),
    "sql_monthly": sql_monthly,
    "report_export": report_export,
    "balance_rank_within_group": lambda b: money_as_double(
        marts.balance_rank_within_group(b.dim_customer)
    ),
    # exploration
    "univariate_stats": lambda b: profile.univariate_stats(b.raw, ("CreditScore", "Age", "Balance")),
    "credit_tier_dist": credit_tier_dist,
    "age_group_churn": lambda b: profile.banded_churn(b.raw, "Age", C.AGE_GROUPS),
    "balance_segments": lambda b: profile.balance_segments(b.raw),
    "churn_by_zero_balance": zero_balance,
    "distinct_tenures": lambda b: profile.distinct_values(b.raw, "Tenure"),
    "churn_by_tenure": lambda b: profile.churn_table(b.raw, "Tenure", "tenure"),
    "churn_by_products": lambda b: profile.churn_table(b.raw, "NumOfProducts", "num_of_products"),
    "churn_by_active": lambda b: profile.churn_table(b.raw, "IsActiveMember", "is_active_member"),
    "hist_credit_score": lambda b: profile.histogram(b.raw, "CreditScore", 40),
    "hist_age": lambda b: profile.histogram(b.raw, "Age", 30),
    "hist_balance": lambda b: profile.histogram(positive_balance(b), "Balance", 40),
    "hist_balance_by_churn": lambda b: profile.histogram(
        positive_balance(b), "Balance", 30, by="Exited"
    ),
    "box_credit_by_churn": lambda b: profile.box_stats(b.raw, "CreditScore"),
    "corr_matrix": lambda b: profile.correlation_matrix(b.dirty),
    "corr_with_churn": lambda b: profile.correlation_with_target(b.dirty),
    "pivot_geo_gender": pivot_geo_gender,
    "pivot_age_tenure": pivot_age_tenure,
    "pivot_products_active": pivot_products_active,
    "pivot_products_active_counts": pivot_products_active_counts,
    "pivot_credit_value": pivot_credit_value,
    "sample_customers": sample_customers,
}


def queries() -> dict:
    """Query name -> callable on (spark, folder of given tables)."""
    def bound(build):
        return lambda spark, folder: build(bank(spark, folder))

    return {name: bound(build) for name, build in CATALOG.items()}
