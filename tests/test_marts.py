import numpy as np
import pytest
from pyspark.sql import functions as F

from churnmart.operators import facts, profile
from churnmart.plans import marts


@pytest.fixture(scope="module")
def dim(bank):
    return bank.dim_customer


def test_every_mart_covers_all_current_customers(dim):
    kpis = marts.executive_kpis(dim).first()
    total, churned = kpis.total_customers, kpis.total_churned
    assert total == dim.where("is_current = 1").count() and kpis.total_active == total - churned
    for df, n, c in (
        (marts.geo_gender_churn(dim), "total_customers", "churned_customers"),
        (marts.ltv_segments(dim), "customer_count", "churned_in_segment"),
        (marts.credit_tier_churn(dim), "total_customers", "churned"),
        (marts.member_status_churn(dim), "total_customers", "churned"),
        (marts.tenure_band_churn(dim), "total_customers", "churned"),
    ):
        row = df.agg(F.sum(n), F.sum(c)).first()
        assert (row[0], row[1]) == (total, churned)
    revenue = marts.revenue_at_risk(dim, top=10_000)
    row = revenue.agg(F.sum("churned_customers"), F.sum("total_balance_at_risk"),
                      F.sum("pct_of_total_at_risk")).first()
    assert row[0] == churned
    assert row[1] == pytest.approx(kpis.total_revenue_at_risk)
    assert row[2] == pytest.approx(100, abs=1)


def test_share_is_of_everything_not_of_the_top_rows(dim):
    few = {tuple(r) for r in marts.revenue_at_risk(dim, top=3).collect()}
    assert few <= {tuple(r) for r in marts.revenue_at_risk(dim, top=10_000).collect()}


def test_critical_customers_agree(dim):
    listed = marts.at_risk_customers(dim, top=10**6)
    kpis = marts.executive_kpis(dim).first()
    assert listed.where("risk_category = 'Critical Risk'").count() == kpis.critical_risk_active_count
    assert listed.where("risk_category = 'High Risk'").count() == kpis.high_risk_active_count


def test_quartiles_are_even_and_ordered(dim):
    rows = marts.ltv_segments(dim).collect()
    counts = [r.customer_count for r in rows]
    assert max(counts) - min(counts) <= 1 and counts == sorted(counts, reverse=True)
    for above, below in zip(rows, rows[1:]):
        assert above.min_ltv >= below.max_ltv


def test_fact_marts_agree_with_the_fact(bank):
    products = marts.product_analysis(bank.fact, bank.dim_product)
    row = products.agg(F.sum("transaction_count"), F.sum("churned_transactions")).first()
    months = marts.monthly_churn_trend(bank.fact, bank.dim_date).agg(F.sum("churned_txns")).first()
    assert row[0] == bank.fact.count() and row[1] == months[0]


def test_trend_of_the_first_month_is_stable(bank):
    first = marts.monthly_churn_trend(bank.fact, bank.dim_date).first()
    assert first.prev_month_churn_rate is None and first.trend_direction == "Stable"


def test_dense_rank_does_not_skip(spark):
    fact = spark.createDataFrame(
        [(1, 1, 1, 10, 0), (2, 2, 1, 10, 1), (3, 3, 1, 5, 0)],
        "transaction_sk BIGINT, product_sk BIGINT, customer_sk BIGINT, amount INT, churn_flag INT",
    ).withColumn("amount", F.col("amount").cast("decimal(15,2)"))
    product = spark.createDataFrame(
        [(1, "a", "x", 1), (2, "b", "x", 1), (3, "c", "x", 1)],
        "product_sk BIGINT, product_name STRING, product_category STRING, interest_rate_pct INT")
    got = [(r.product_name, r.revenue_rank) for r in marts.product_analysis(fact, product).collect()]
    assert got == [("a", 1), ("b", 1), ("c", 2)]


def test_marts_of_an_empty_dimension(dim):
    empty = dim.where("customer_id < 0")
    assert marts.executive_kpis(empty).first().total_customers == 0
    assert marts.ltv_segments(empty).count() == 0
    assert marts.revenue_at_risk(empty).count() == 0


def test_user_sql_runs_over_the_warehouse(bank):
    got = bank.warehouse.sql("""
        SELECT d.year_month, COUNT(*) AS n, SUM(f.amount) AS amount
        FROM {fact_transactions} f JOIN {dim_date} d ON f.date_sk = d.date_sk
        GROUP BY d.year_month ORDER BY year_month""")
    assert got.agg(F.sum("n")).first()[0] == bank.fact.count()
    with pytest.raises(Exception, match="no_such_column"):
        bank.warehouse.sql("SELECT no_such_column FROM {dim_customer}").collect()


def test_unresolved_keys_stay_null_and_count_as_orphans(bank):
    dims = bank.dim_customer.where("customer_id > 20")
    fact = facts.build_fact(bank.transactions, dims, bank.dim_product.where("product_id <> 1"))
    assert fact.count() == bank.transactions.count()
    r = facts.key_resolution(fact).first()
    assert 0 < r.customer_sk_resolved < r.fact_rows and 0 < r.product_sk_resolved < r.fact_rows
    orphans = facts.orphan_counts(fact, {"customer_sk": dims, "product_sk": bank.dim_product})
    got = {o.foreign_key: o.orphans for o in orphans.collect()}
    assert got["customer_sk"] == r.fact_rows - r.customer_sk_resolved
    assert got["product_sk"] == r.fact_rows - r.product_sk_resolved


def test_as_of_finds_at_most_one_version(bank):
    joined = facts.as_of_versions(bank.fact, bank.dim_customer)
    assert joined.count() == bank.fact.count()
    late = joined.where("transaction_date >= '2000-01-01' AND record_version IS NULL")
    # Only customers who joined later have no version then.
    assert late.join(bank.dimension.select("customer_id"), "customer_id").count() == 0


def test_histogram_counts_everything_once(bank):
    import numpy as np

    values = bank.raw.select("CreditScore").toPandas().CreditScore
    counts, edges = np.histogram(values, bins=40)
    got = profile.histogram(bank.raw, "CreditScore", 40).collect()
    assert [r.customers for r in got] == list(counts)
    assert np.allclose([r.lower for r in got], edges[:-1], atol=1e-3)


def test_histogram_bins_fractions_as_they_are(spark):
    values = [0.1, 0.2, 0.4, 0.6, 0.9]
    counts, edges = np.histogram(values, bins=4)
    got = profile.histogram(spark.createDataFrame([(v,) for v in values], "x DOUBLE"), "x", 4).collect()
    assert [r.customers for r in got] == counts.tolist()
    assert [r.lower for r in got] == [round(e, 4) for e in edges[:-1].tolist()]


def test_histogram_of_a_constant(spark):
    import numpy as np

    df = spark.createDataFrame([(5,)] * 3, "x INT")
    counts, edges = np.histogram([5, 5, 5], bins=4)
    got = profile.histogram(df, "x", 4).collect()
    assert [r.customers for r in got] == list(counts)
    assert [r.lower for r in got] == list(edges[:-1])


def test_export_writes_each_report_as_one_sorted_file(spark, bank):
    from churnmart.plans.reports import REPORTS, export_reports
    from churnmart.session import new_path

    out = new_path(spark, "reports")
    paths = export_reports(bank.warehouse, out)
    assert len(paths) == len(REPORTS) == 10
    back = spark.read.option("header", True).csv(f"{out}/tenure_band_churn")
    want = marts.tenure_band_churn(bank.dim_customer)
    assert back.columns == want.columns
    assert [r.tenure_band for r in back.collect()] == [r.tenure_band for r in want.collect()]


def test_warehouse_from_feeds(spark, bank, folder):
    from churnmart.plans import warehouse
    from churnmart.sources import bankview

    history = warehouse.customer_history(
        bank.raw.where("CustomerId % 97 <> 0"), bank.raw, bankview.DIMENSION_LOAD,
        bankview.FEED_LOAD,
    )
    built = warehouse.build_warehouse(
        spark, history, bank.products, bank.transactions, bank.customers, bank.survey
    )
    assert set(built.tables()) == set(warehouse.TABLES)
    assert built.fact_transactions.where("customer_sk is null").count() == 0
    # The same feed twice: only the customers left out at first are added.
    assert built.dim_customer.count() == bank.raw.count()
    assert facts.churn_metric(built.dim_customer).first().churned == bank.raw.where("Exited = 1").count()


def test_products_of_one_name_are_one_row_with_distinct_customers(spark):
    fact = spark.createDataFrame(
        [(1, 1, 7, 1), (2, 2, 7, 0), (3, 2, 8, 0), (4, None, 9, 0), (5, 1, None, 1)],
        "transaction_sk BIGINT, product_sk BIGINT, customer_sk BIGINT, churn_flag INT",
    ).withColumn("amount", F.lit("2.50").cast("decimal(15,2)"))
    product = spark.createDataFrame(
        [(1, "a", "x", 1), (2, "a", "x", 1)],
        "product_sk BIGINT, product_name STRING, product_category STRING, interest_rate_pct INT")
    row, = marts.product_analysis(fact, product).collect()
    assert (row.customer_count, row.transaction_count, row.total_revenue) == (2, 4, 10.0)
    assert (row.churned_transactions, row.product_churn_rate_pct) == (2, 50.0)
    assert row.avg_transaction_value == 2.5
