"""Plans, not results: what is read, what is shuffled, what is left out."""

import re

from churnmart.operators import facts
from churnmart.plans import marts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_read_only_current_rows_and_needed_columns(bank):
    plan = plan_of(marts.credit_tier_churn(bank.dim_customer))
    assert re.search(r"PartitionFilters: \[[^\]]*is_current", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "surname" not in schema and "balance" in schema


def test_filters_reach_the_scan(bank):
    plan = plan_of(marts.at_risk_customers(bank.dim_customer))
    assert "EqualTo(churn_flag,0)" in plan and "GreaterThanOrEqual(risk_score,3)" in plan
    assert "TakeOrderedAndProject" in plan


def test_deduplication_has_no_sort_aggregate(bank):
    from churnmart.operators import cleanse

    plan = plan_of(cleanse.deduplicate(bank.dirty))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_profiles_repeat_no_row(bank):
    from churnmart.operators import profile

    optimized = profile.correlation_matrix(bank.raw)._jdf.queryExecution().optimizedPlan().toString()
    # Between the source and the first aggregate; what is repeated after that are NULL patterns.
    assert "Generate" not in optimized.split("Aggregate [")[-1].split("Relation")[0]


def test_top_segments_do_not_sort_everything(bank):
    assert "TakeOrderedAndProject" in plan_of(marts.revenue_at_risk(bank.dim_customer))


def test_member_report_needs_no_window(bank):
    assert "Window" not in plan_of(marts.member_status_churn(bank.dim_customer))


def test_dimension_joins_are_broadcast_by_size(bank):
    plan = plan_of(marts.monthly_churn_trend(bank.fact, bank.dim_date))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_as_of_join_is_not_a_nested_loop(bank):
    plan = plan_of(facts.as_of_versions(bank.fact, bank.dim_customer))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_python_rows_and_no_cartesian_products(bank):
    from churnmart.plans.catalog import CATALOG

    for name in ("q1", "q2", "q3", "q4", "q5", "corr_matrix", "null_profile", "scd2_merge",
                 "etl_dedup", "hist_balance_by_churn", "describe_numeric"):
        plan = plan_of(CATALOG[name](bank))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_distinct_customers_are_shuffled_as_bitmaps(bank):
    for df in (marts.monthly_churn_trend(bank.fact, bank.dim_date), marts.product_analysis(bank.fact, bank.dim_product)):
        plan = plan_of(df)
        assert "bitmap_construct_agg" in plan and "hashpartitioning" in plan
        for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan):
            assert "customer_sk" not in keys
