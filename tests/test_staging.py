from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnmart import constants as C
from churnmart.functions.exprs import map_label
from churnmart.operators import cleanse, derive, quality
from churnmart.plans import staging
from churnmart.plans.marts import at_risk_customers
from churnmart.schemas import RAW_CUSTOMERS


def raw(spark, rows):
    names = [
        "RowNumber", "CustomerId", "Surname", "CreditScore", "Geography", "Gender", "Age",
        "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember",
        "EstimatedSalary", "Exited",
    ]
    base = [1, 1, "Doe", 600, "France", "Male", 40, 5, 1000.0, 1, 1, 1, 50000.0, 0]
    full = []
    for row in rows:
        full.append([row.get(n, b) for n, b in zip(names, base)] + [None, None, None, None])
    return spark.createDataFrame(full, RAW_CUSTOMERS)


def test_fill_values_use_all_rows_before_deduplication(spark):
    df = raw(spark, [
        {"RowNumber": 1, "CustomerId": 1, "CreditScore": 500, "Age": 30, "HasCrCard": 0},
        {"RowNumber": 1, "CustomerId": 1, "CreditScore": 500, "Age": 30, "HasCrCard": 0},
        {"RowNumber": 2, "CustomerId": 2, "CreditScore": 601, "Age": 35, "Geography": "Spain"},
        {"RowNumber": 3, "CustomerId": 3, "CreditScore": 700, "Age": 36},
        {"RowNumber": 4, "CustomerId": 4, "CreditScore": None, "Age": None, "Balance": None,
         "HasCrCard": None, "Geography": None, "Tenure": None, "EstimatedSalary": None},
    ])
    fill = cleanse.fit_fill_values(df).values
    assert fill["CreditScore"] == 550.5 and fill["Age"] == 32 and fill["Balance"] == 0.0
    assert fill["HasCrCard"] == 0 and fill["Geography"] == "France"
    row = cleanse.impute(df, cleanse.FillValues(fill)).where("CustomerId = 4").first()
    assert (row.CreditScore, row.Age, row.Balance, row.HasCrCard) == (550.5, 32, 0.0, 0)
    done = cleanse.standardize(cleanse.impute(df, cleanse.FillValues(fill)))
    assert done.where("CustomerId = 4").first().CreditScore == 550


def test_a_column_without_values_stays_null(spark):
    df = raw(spark, [{"Age": None, "Gender": None}])
    row = cleanse.impute(df, cleanse.fit_fill_values(df)).first()
    assert row.Age is None and row.Gender is None


@pytest.mark.parametrize("partitions", [1, 6])
def test_dedup_keeps_the_last_row_per_key(spark, partitions):
    rows = [{"RowNumber": i, "CustomerId": i % 3, "Balance": float(i)} for i in range(1, 31)]
    df = raw(spark, rows + rows).repartition(partitions)
    got = {r.CustomerId: r.Balance for r in cleanse.deduplicate(df).collect()}
    assert got == {0: 30.0, 1: 28.0, 2: 29.0}


def test_caps_match_pandas_and_lose_no_rows(bank):
    before = bank.dirty_cleansed
    pdf = before.toPandas()
    caps = cleanse.fit_caps(before)
    for c in C.CAPPED_COLUMNS:
        assert caps.limits[c] == (pdf[c].quantile(0.01), pdf[c].quantile(0.99))
    after = cleanse.cap_outliers(before, caps).toPandas()
    assert len(after) == len(pdf)
    merged = pdf.merge(after, on="CustomerId")
    want = merged.Balance_x.clip(*caps.limits["Balance"])
    assert np.array_equal(merged.Balance_y, want)


def test_domain_ranges_of_age_and_tenure(spark):
    df = raw(spark, [
        {"CustomerId": 1, "Age": 5, "Tenure": -1}, {"CustomerId": 2, "Age": 130, "Tenure": 11},
        {"CustomerId": 3, "Age": None, "Tenure": None},
    ])
    caps = cleanse.Caps({c: (0.0, 1e9) for c in C.CAPPED_COLUMNS})
    got = {r.CustomerId: (r.Age, r.Tenure) for r in cleanse.cap_outliers(df, caps).collect()}
    assert got == {1: (18, 0), 2: (100, 10), 3: (None, None)}
    counts = {r["column"]: r.values_capped for r in cleanse.cap_counts(df, caps).collect()}
    assert counts["Age"] == 2 and counts["Tenure"] == 2 and counts["Balance"] == 0


# Published members of the retention list
# (credit tier is left out, the score behind it is not published).
PUBLISHED = [
    # age, tenure, balance, products, active -> age group, band, risk, category, action
    (31, 1, 127320.36, 3, 0, "25-35", "New (0-2 yrs)", 8, "Critical Risk", "Immediate outreach required"),
    (59, 0, 135296.33, 1, 0, "51-65", None, 7, "Critical Risk", "Immediate outreach required"),
    (53, 2, 111061.01, 2, 0, "51-65", "New (0-2 yrs)", 7, "Critical Risk", "Immediate outreach required"),
    (41, 7, 104405.54, 3, 0, "36-50", "Mature (6-8 yrs)", 7, "Critical Risk", "Immediate outreach required"),
    (29, 5, 101713.84, 3, 0, "25-35", "Growing (3-5 yrs)", 7, "Critical Risk", "Immediate outreach required"),
    (32, 1, 0.0, 3, 0, "25-35", "New (0-2 yrs)", 7, "Critical Risk", "Immediate outreach required"),
    (51, 9, 156773.78, 2, 0, "51-65", "Loyal (9-10 yrs)", 6, "High Risk", "Schedule retention call"),
    (68, 4, 136525.99, 1, 0, "65+", "Growing (3-5 yrs)", 6, "High Risk", "Schedule retention call"),
]


def test_published_members_are_reproduced(spark):
    rows = [
        {"CustomerId": i, "Age": a, "Tenure": t, "Balance": b, "NumOfProducts": n, "IsActiveMember": m}
        for i, (a, t, b, n, m, *_) in enumerate(PUBLISHED)
    ]
    scored = derive.risk_score(derive.derive_columns(raw(spark, rows)))
    current = staging.to_warehouse_names(scored).withColumn("is_current", F.lit(1))
    got = {
        r.customer_id: (r.age_group, r.tenure_band, r.risk_score, r.risk_category, r.recommended_action)
        for r in at_risk_customers(current).collect()
    }
    assert got == {i: row[5:] for i, row in enumerate(PUBLISHED)}


def test_derived_values(spark):
    row = derive.derive_columns(raw(spark, [{
        "Balance": 100000.0, "EstimatedSalary": 0.0, "Tenure": 3, "Exited": 1,
    }])).first()
    assert row.HighValueFlag == "N" and row.BalanceSalaryRatio == 0.0
    assert row.EstimatedLTV == 2000.0 and row.ChurnLabel == "Churned" and row.ProductEngagement == 4


def test_staged_keys_follow_the_feed(bank):
    staged = bank.staged.select("customer_sk", "customer_id").toPandas().sort_values("customer_sk")
    assert list(staged.customer_sk) == list(range(1, len(staged) + 1))
    feed = bank.dirty.select("RowNumber", "CustomerId").toPandas().sort_values("RowNumber")
    last = feed.drop_duplicates("CustomerId", keep="last")
    assert list(staged.customer_id) == list(last.CustomerId)


def test_quality_gate_passes_on_clean_and_fails_on_lossy_input(spark, bank):
    clean = staging.stage_customers(bank.raw, date(2001, 1, 1))
    passed = quality.quality_gate(clean, bank.rows_of(bank.raw)).collect()
    assert {r.gate for r in passed} == {"PASSED"} and {r.status for r in passed} == {"OK"}
    failed = quality.quality_gate(bank.staged, bank.rows_of(bank.dirty)).collect()
    assert {r.gate for r in failed} == {"FAILED"}
    broken = bank.staged.withColumn("churn_flag", F.when(F.col("customer_sk") > 1, 2))
    found = {r.check: r.violations for r in quality.quality_gate(broken, F.lit(1)).collect()}
    assert found["mandatory_churn_flag"] == 1 and found["churn_flag_binary"] == bank.staged.count()


def test_duplicate_profiles_match_pandas(bank):
    pdf = bank.dirty.toPandas()
    row = quality.profile_duplicates(bank.dirty).first()
    assert (row.total_rows, row.duplicate_rows, row.duplicate_keys) == (
        len(pdf), int(pdf.duplicated().sum()), int(pdf.CustomerId.duplicated().sum()))
    assert quality.duplicate_rows(bank.dirty).count() == int(pdf.duplicated(keep=False).sum())
    keys = [r.CustomerId for r in quality.duplicate_keys(bank.dirty).collect()]
    assert keys == sorted(pdf.CustomerId[pdf.CustomerId.duplicated(keep=False)])


def test_map_label_is_used_for_segments(spark):
    df = spark.range(1, 5)
    got = [r[0] for r in df.orderBy("id").select(map_label(F.col("id"), C.LTV_SEGMENTS)).collect()]
    assert got == list(C.LTV_SEGMENTS.values())


def test_describe_matches_pandas(bank):
    from churnmart.operators.profile import describe_numeric

    pdf = bank.dirty.toPandas()
    for r in describe_numeric(bank.dirty).collect():
        want = pdf[r["column"]].describe().round(2)
        got = pd.Series([r["count"], r["mean"], r["std"], r["min"], r.p25, r.p50, r.p75, r["max"]])
        assert np.allclose(got, want.values, atol=0.011)


def test_step_counts_see_rows_that_only_imputation_makes_equal(spark, bank):
    run = staging.run_staging(bank.dirty, date(2024, 1, 1))
    plain = {r.step: r for r in run.steps.collect()}
    assert plain["Null Treatment"].rows_before == plain["Null Treatment"].rows_after == bank.dirty.count()
    assert plain["Outlier Capping"].rows_after == run.customers.count()
    # The report reads what the run wrote, and no step runs again for it.
    plan = run.steps._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Join" not in plan
    assert plain["Full Row Deduplication"].rows_after < bank.dirty.distinct().count()
    assert plain["Key Deduplication"].rows_after == bank.raw.count()


def test_correlations_match_pandas_with_nulls_and_constants(spark):
    from churnmart.operators import profile

    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(1e9, 1, 400), "b": rng.normal(0, 1e-6, 400), "c": rng.integers(0, 3, 400).astype(float)})
    pdf["d"] = pdf.a * 2 + rng.normal(0, 1, 400)
    pdf["flat"], pdf["none"] = 7.25, None
    pdf.loc[::3, "b"] = None
    pdf.loc[pdf.c == 1, "d"] = None
    rows = [tuple(None if v is None or v != v else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, flat DOUBLE, none DOUBLE").repartition(5)
    got = {(r.x, r.y): r["corr"] for r in profile.correlation_matrix(df, list(pdf.columns), 6).collect()}
    assert len(got) == 36
    want = pdf[["a", "b", "c", "d"]].corr()
    for x in "abcd":
        for y in "abcd":
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=2e-6)
    assert all(v is None for (x, y), v in got.items() if {"flat", "none"} & {x, y})


def test_correlations_scan_once(bank):
    from churnmart.operators import profile

    plan = profile.correlation_matrix(bank.dirty)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
