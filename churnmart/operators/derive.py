"""Staging steps T6-T7: bands, values and scores from columns of the same row."""

from pyspark.sql import DataFrame, functions as F

from churnmart import constants as C
from churnmart.functions.exprs import add_up, bin_label, clip, col, map_label, round_even


def derive_columns(df: DataFrame, tenure_include_lowest=False) -> DataFrame:
    """T6. Tenure 0 has no band (left-open bins) unless ``tenure_include_lowest``."""
    balance, salary, tenure = col("Balance"), col("EstimatedSalary"), col("Tenure")
    ltv = balance * C.LTV_BALANCE_WEIGHT + salary * C.LTV_SALARY_WEIGHT * tenure
    ratio = round_even(F.try_divide(balance, salary), 4)
    engagement = col("NumOfProducts") + col("IsActiveMember") * 2 + col("HasCrCard")
    return df.withColumns({
        "AgeGroup": bin_label(col("Age"), C.AGE_GROUPS),
        "CreditTier": bin_label(col("CreditScore"), C.CREDIT_TIERS),
        "TenureBand": bin_label(tenure, C.TENURE_BANDS, tenure_include_lowest),
        "HighValueFlag": F.when(balance > C.HIGH_VALUE_BALANCE, "Y").otherwise("N"),
        "EstimatedLTV": round_even(ltv, 2),
        "ChurnLabel": map_label(col("Exited"), C.CHURN_LABELS),
        "BalanceSalaryRatio": F.when(salary > 0, ratio).otherwise(0.0),
        "ProductEngagement": clip(engagement, C.SCORE_MIN, C.SCORE_MAX),
    })


def risk_score(df: DataFrame) -> DataFrame:
    """T7: additive churn risk 0..10 and its category; an unknown factor adds nothing."""
    # Factor and weight.
    rules = (
        (col("NumOfProducts") >= 3, 3),
        (col("IsActiveMember") == 0, 3),
        (col("Age") >= 51, 2),
        (col("Tenure") <= 2, 1),
        (col("HighValueFlag") == "Y", 1),
    )
    score = add_up([F.when(rule, weight).otherwise(0) for rule, weight in rules])
    scored = df.withColumn("RiskScore", clip(score, C.SCORE_MIN, C.SCORE_MAX))
    return scored.withColumn("RiskCategory", bin_label(col("RiskScore"), C.RISK_CATEGORIES))
