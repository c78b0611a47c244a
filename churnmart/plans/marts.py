"""The ten business reports over the star schema, and the ranked members behind one.

Each takes warehouse tables and returns a DataFrame; ``dim_customer`` filters on
``is_current``, which prunes partitions when the dimension is stored by that column.
Windows appear only after aggregation, over report rows. NULL group keys are kept.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from churnmart import constants as C
from churnmart.functions.exprs import KEY_BITS, KEY_BUCKET, col, count_bits, key_bits, key_bucket, map_label, money, rate_pct
from churnmart.operators.ordering import global_rank, ntile_from_rank


def _current(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.where(F.col("is_current") == 1)


def _rows() -> Column:
    return F.count(F.lit(1))


def geo_gender_churn(dim_customer: DataFrame) -> DataFrame:
    """Churn rate by geography and gender."""
    customers, churned = F.count_distinct("customer_id"), F.sum("churn_flag")
    return (
        _current(dim_customer).groupBy("geography", "gender").agg(
            customers.alias("total_customers"),
            churned.alias("churned_customers"),
            (customers - churned).alias("active_customers"),
            rate_pct(churned, customers).alias("churn_rate_pct"),
        ).orderBy(F.col("churn_rate_pct").desc(), "geography", "gender")
    )


def revenue_at_risk(dim_customer: DataFrame, top=20) -> DataFrame:
    """Balance of churned customers by segment, with its share of the grand total."""
    segments = ["geography", "age_group", "credit_tier"]
    balance = F.sum("balance")
    grouped = (
        _current(dim_customer).where("churn_flag = 1").groupBy(*segments).agg(
            F.count_distinct("customer_id").alias("churned_customers"),
            balance.alias("__balance"),
            money(F.avg("balance")).alias("avg_balance_per_churner"),
        )
    )
    # The share is of all segments, so it is taken before the top rows are.
    everything = F.sum("__balance").over(Window.partitionBy())
    share = F.round(F.try_divide(F.col("__balance") * 100, everything), 2)
    return (
        grouped.withColumn("pct_of_total_at_risk", share.cast("double"))
        .orderBy(F.col("__balance").desc(), *segments).limit(top)
        .select(
            *segments, "churned_customers",
            money(F.col("__balance")).alias("total_balance_at_risk"),
            "avg_balance_per_churner", "pct_of_total_at_risk",
        )
    )


def ltv_segments(dim_customer: DataFrame) -> DataFrame:
    """Lifetime-value quartiles, the highest first."""
    slim = _current(dim_customer).select("customer_id", "estimated_ltv", "churn_flag")
    ranked = global_rank(
        slim, [col("estimated_ltv").desc(), "customer_id"], "__rank", total="__total"
    )
    quartile = ntile_from_rank(F.col("__rank"), F.col("__total"), 4)
    churned, rows = F.sum("churn_flag"), _rows()
    return (
        ranked.withColumn("ltv_quartile", quartile).groupBy("ltv_quartile").agg(
            rows.alias("customer_count"),
            money(F.min("estimated_ltv")).alias("min_ltv"),
            money(F.max("estimated_ltv")).alias("max_ltv"),
            money(F.avg("estimated_ltv")).alias("avg_ltv"),
            churned.alias("churned_in_segment"),
            rate_pct(churned, rows).alias("segment_churn_rate_pct"),
        )
        .withColumn("segment_label", map_label(F.col("ltv_quartile"), C.LTV_SEGMENTS))
        .select(
            "ltv_quartile", "segment_label", "customer_count", "min_ltv", "max_ltv", "avg_ltv",
            "churned_in_segment", "segment_churn_rate_pct",
        )
        .orderBy("ltv_quartile")
    )


def monthly_churn_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Churn rate per month and its change on the month before.

    ``total_transactions`` counts distinct customers while the rate divides by rows: the
    names and formulas of the report as users know them. Customers are bits of their dense
    keys. A task of the fact has few rows of each month and bucket of keys, so these rows are
    brought together first: one bitmap per month and bucket, not one per task as well.
    """
    churned, rows = F.sum("churned"), F.sum("rows")
    exact_rate = F.round(
        churned.cast("decimal(20,0)") * 100 / rows.cast("decimal(20,0)"), 2
    ).cast("decimal(7,2)")
    month = ["year", "month", "month_name", "year_month"]
    # A number for the month, by a window over the days of the calendar.
    days = dim_date.select("date_sk", *month, F.dense_rank().over(Window.orderBy(*month)).alias("__month"))
    group = ["__month", KEY_BUCKET]
    months = (
        fact.select("date_sk", "customer_sk", "churn_flag", key_bucket("customer_sk"))
        .join(days.select("date_sk", "__month"), "date_sk").drop("date_sk")
        .repartition(*group)
        .groupBy(*group)
        .agg(key_bits("customer_sk"), F.sum("churn_flag").alias("churned"), _rows().alias("rows"))
        .groupBy("__month")
        .agg(
            count_bits().alias("total_transactions"),
            churned.alias("churned_txns"),
            exact_rate.alias("rate"),
        )
        .join(days.select("__month", *month).distinct(), "__month")
    )
    before = F.lag("rate").over(Window.orderBy("year", "month"))
    trend = (
        F.when(F.col("rate") > F.col("before"), "Increasing")
        .when(F.col("rate") < F.col("before"), "Decreasing")
        .otherwise("Stable")
    )
    return months.withColumn("before", before).select(
        "year", "month", "month_name", "year_month", "total_transactions", "churned_txns",
        F.col("rate").cast("double").alias("churn_rate"),
        F.col("before").cast("double").alias("prev_month_churn_rate"),
        money(F.col("rate") - F.col("before")).alias("mom_churn_change"),
        trend.alias("trend_direction"),
    ).orderBy("year", "month")


def product_analysis(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Revenue, customers and churn per product, ranked by revenue.

    The fact shrinks to bitmaps of customer keys and sums per product before it meets the
    product names; the bitmaps of products of one name are united, then counted.
    """
    churned, rows = F.sum("churned"), F.sum("rows")
    per_product = fact.groupBy("product_sk", key_bucket("customer_sk")).agg(
        key_bits("customer_sk"),
        F.count("transaction_sk").alias("transactions"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("amounts"),
        F.sum("churn_flag").alias("churned"),
        _rows().alias("rows"),
    )
    named = per_product.join(
        dim_product.select("product_sk", "product_name", "product_category", "interest_rate_pct"),
        "product_sk",
    )
    mean = F.try_divide(F.sum("amount"), F.sum("amounts").cast("decimal(20,0)"))
    name = ["product_name", "product_category", "interest_rate_pct"]
    united = named.groupBy(*name, KEY_BUCKET).agg(
        F.bitmap_or_agg(KEY_BITS).alias(KEY_BITS),
        *[F.sum(c).alias(c) for c in ("transactions", "amount", "amounts", "churned", "rows")],
    )
    grouped = united.groupBy(*name).agg(
        count_bits().alias("customer_count"),
        F.sum("transactions").alias("transaction_count"),
        F.sum("amount").alias("revenue"),
        money(mean).alias("avg_transaction_value"),
        churned.alias("churned_transactions"),
        rate_pct(churned, rows).alias("product_churn_rate_pct"),
    )
    rank = F.dense_rank().over(Window.orderBy(F.col("revenue").desc()))
    return grouped.withColumn("revenue_rank", rank).select(
        "product_name", "product_category",
        F.col("interest_rate_pct").cast("double").alias("interest_rate_pct"),
        "customer_count", "transaction_count",
        money(F.col("revenue")).alias("total_revenue"),
        "avg_transaction_value", "churned_transactions", "product_churn_rate_pct", "revenue_rank",
    ).orderBy("revenue_rank", "product_name")


def at_risk_customers(dim_customer: DataFrame, top=100) -> DataFrame:
    """Remaining customers with a risk score of 3 or more, the riskiest first."""
    action = F
    for floor, label in C.ACTIONS:
        action = action.when(F.col("risk_score") >= floor, label)
    return (
        _current(dim_customer).where("churn_flag = 0 AND risk_score >= 3")
        .orderBy(F.col("risk_score").desc(), F.col("balance").desc(), "customer_id").limit(top)
        .select(
            "customer_id", "surname", "geography", "age", "age_group", "credit_tier", "tenure",
            "tenure_band", money(F.col("balance")).alias("balance"), "num_of_products",
            "is_active_member", "risk_score", "risk_category",
            money(F.col("estimated_ltv")).alias("estimated_ltv"),
            action.otherwise(C.DEFAULT_ACTION).alias("recommended_action"),
        )
    )


def credit_tier_churn(dim_customer: DataFrame) -> DataFrame:
    """Churn by credit tier and high-value flag."""
    churned, rows = F.sum("churn_flag"), _rows()
    return (
        _current(dim_customer).groupBy("credit_tier", "high_value_flag").agg(
            rows.alias("total_customers"),
            churned.alias("churned"),
            rate_pct(churned, rows).alias("churn_rate_pct"),
            money(F.avg("balance")).alias("avg_balance"),
            money(F.avg("estimated_ltv")).alias("avg_ltv"),
        ).orderBy("credit_tier", "high_value_flag")
    )


def member_status_churn(dim_customer: DataFrame) -> DataFrame:
    """Churn of active against inactive members."""
    churned, rows = F.sum("churn_flag"), _rows()
    status = F.when(F.col("is_active_member") == 1, "Active Member").otherwise("Inactive Member")
    return (
        _current(dim_customer).groupBy("is_active_member").agg(
            rows.alias("total_customers"),
            churned.alias("churned"),
            rate_pct(churned, rows).alias("churn_rate_pct"),
            money(F.avg("balance")).alias("avg_balance"),
        )
        .orderBy(F.col("is_active_member").desc())
        .select(
            status.alias("member_status"), "total_customers", "churned", "churn_rate_pct",
            "avg_balance",
        )
    )


def balance_rank_within_group(dim_customer: DataFrame) -> DataFrame:
    """Customers ranked by balance among active and among inactive members.

    Two groups hold everybody, so the rank is global and restarts per group.
    """
    slim = _current(dim_customer).select(
        "customer_id", "is_active_member", "balance", "churn_flag", "geography"
    )
    return global_rank(
        slim, [col("balance").desc(), "customer_id"], "balance_rank_within_group",
        within=["is_active_member"],
    )


def tenure_band_churn(dim_customer: DataFrame) -> DataFrame:
    """Churn by tenure band (NULL for tenure 0) and geography."""
    churned, rows = F.sum("churn_flag"), _rows()
    return (
        _current(dim_customer).groupBy("tenure_band", "geography").agg(
            rows.alias("total_customers"),
            churned.alias("churned"),
            rate_pct(churned, rows).alias("churn_rate_pct"),
            money(F.avg("balance")).alias("avg_balance"),
            F.round(
                F.sum("risk_score").cast("decimal(20,0)")
                / F.count("risk_score").cast("decimal(20,0)"), 2
            ).cast("double").alias("avg_risk_score"),
        ).orderBy(F.col("churn_rate_pct").desc(), "tenure_band", "geography")
    )


def executive_kpis(dim_customer: DataFrame) -> DataFrame:
    """Headline numbers, one row."""
    customers, churned = F.count_distinct("customer_id"), F.sum("churn_flag")
    gone, stays = F.col("churn_flag") == 1, F.col("churn_flag") == 0

    def staying(category):
        return F.sum(F.when((F.col("risk_category") == category) & stays, 1).otherwise(0))

    return _current(dim_customer).agg(
        customers.alias("total_customers"),
        churned.alias("total_churned"),
        (customers - churned).alias("total_active"),
        rate_pct(churned, _rows()).alias("overall_churn_rate_pct"),
        money(F.sum(F.when(gone, F.col("balance")).otherwise(0))).alias("total_revenue_at_risk"),
        money(F.avg(F.when(gone, F.col("balance")))).alias("avg_churner_balance"),
        staying("Critical Risk").alias("critical_risk_active_count"),
        staying("High Risk").alias("high_risk_active_count"),
        money(F.avg("estimated_ltv")).alias("avg_customer_ltv"),
        money(F.sum("estimated_ltv")).alias("total_portfolio_ltv"),
    )
