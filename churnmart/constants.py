"""Business constants. Results depend on every one of them."""

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Bands:
    """Right-closed intervals ``(edges[i], edges[i + 1]]`` and one label for each."""

    edges: tuple
    labels: tuple


# Band edges and labels.
CREDIT_TIERS = Bands(
    (0, 579, 669, 739, 799, 900),
    ("Poor", "Fair", "Good", "Very Good", "Excellent"),
)
CREDIT_TIERS_WITH_RANGE = Bands(
    CREDIT_TIERS.edges,
    (
        "Poor (300-579)",
        "Fair (580-669)",
        "Good (670-739)",
        "Very Good (740-799)",
        "Excellent (800-850)",
    ),
)
AGE_GROUPS = Bands(
    (0, 25, 35, 50, 65, 100),
    ("Under 25", "25-35", "36-50", "51-65", "65+"),
)
TENURE_BANDS = Bands(
    (0, 2, 5, 8, 10),
    ("New (0-2 yrs)", "Growing (3-5 yrs)", "Mature (6-8 yrs)", "Loyal (9-10 yrs)"),
)
RISK_CATEGORIES = Bands(
    (-1, 2, 4, 6, 10),
    ("Low Risk", "Medium Risk", "High Risk", "Critical Risk"),
)

# Flags, thresholds, weights.
HIGH_VALUE_BALANCE = 100000
CHURN_LABELS = {0: "Active", 1: "Churned"}
LTV_BALANCE_WEIGHT = 0.02
LTV_SALARY_WEIGHT = 0.001
SCORE_MIN, SCORE_MAX = 0, 10
AGE_MIN, AGE_MAX = 18, 100
TENURE_MIN, TENURE_MAX = 0, 10
CAP_PROBABILITIES = (0.01, 0.99)
IQR_FENCE = 1.5
MIN_RETENTION_PCT = 99
IMBALANCE_RATIO = 0.25
STRONG_CORRELATION, MODERATE_CORRELATION = 0.2, 0.1
HIGH_DATE = date(9999, 12, 31)

# Column roles of the raw customer table.
RAW_KEY = "CustomerId"
RAW_ORDER = "RowNumber"
EXPECTED_RAW_COLUMNS = (
    "RowNumber", "CustomerId", "Surname", "CreditScore", "Geography", "Gender", "Age",
    "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember",
    "EstimatedSalary", "Exited",
)
PASS_THROUGH_COLUMNS = ("Complain", "Satisfaction Score", "Card Type", "Point Earned")
INTEGER_COLUMNS = (
    "CustomerId", "CreditScore", "Age", "Tenure", "NumOfProducts", "HasCrCard",
    "IsActiveMember", "Exited",
)
MONEY_COLUMNS = ("Balance", "EstimatedSalary")
TEXT_COLUMNS = ("Geography", "Gender", "Surname")
CAPPED_COLUMNS = ("CreditScore", "Balance", "EstimatedSalary")
OUTLIER_COLUMNS = ("CreditScore", "Age", "Balance", "EstimatedSalary")
CATEGORICAL_COLUMNS = ("Geography", "Gender", "HasCrCard", "IsActiveMember", "NumOfProducts")
CORRELATION_COLUMNS = (
    "CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard",
    "IsActiveMember", "EstimatedSalary", "Exited",
)
TRACKED_COLUMNS = ("geography", "num_of_products", "is_active_member", "has_cr_card")
MANDATORY_COLUMNS = (
    "customer_sk", "customer_id", "credit_score", "geography", "gender", "age", "tenure",
    "churn_flag", "is_current",
)

# Raw and derived names -> warehouse names.
WAREHOUSE_NAMES = {
    "CustomerId": "customer_id",
    "Surname": "surname",
    "CreditScore": "credit_score",
    "Geography": "geography",
    "Gender": "gender",
    "Age": "age",
    "Tenure": "tenure",
    "Balance": "balance",
    "NumOfProducts": "num_of_products",
    "HasCrCard": "has_cr_card",
    "IsActiveMember": "is_active_member",
    "EstimatedSalary": "estimated_salary",
    "Exited": "churn_flag",
    "AgeGroup": "age_group",
    "CreditTier": "credit_tier",
    "TenureBand": "tenure_band",
    "HighValueFlag": "high_value_flag",
    "EstimatedLTV": "estimated_ltv",
    "ChurnLabel": "churn_label",
    "BalanceSalaryRatio": "balance_salary_ratio",
    "ProductEngagement": "product_engagement",
    "RiskScore": "risk_score",
    "RiskCategory": "risk_category",
}

# Product catalog (id, name, category, interest rate in percent).
PRODUCT_CATALOG = (
    (101, "Savings Account", "Deposit", "3.50"),
    (102, "Fixed Deposit", "Deposit", "6.80"),
    (103, "Personal Loan", "Loan", "12.50"),
    (104, "Credit Card", "Credit", "18.00"),
)
PRODUCT_LAUNCH_YEAR = 2015

# Fixed value: the default of the churn reason lookup.
NO_CHURN_REASON = "N/A - Active Customer"

# Mart labels.
LTV_SEGMENTS = {
    1: "Platinum (Top 25%)",
    2: "Gold (26-50%)",
    3: "Silver (51-75%)",
    4: "Bronze (Bottom 25%)",
}
ACTIONS = (
    (7, "Immediate outreach required"),
    (5, "Schedule retention call"),
    (3, "Send engagement email"),
)
DEFAULT_ACTION = "Monitor"

# Names of the staging steps in the step report.
STAGING_STEPS = (
    "Null Treatment", "Full Row Deduplication", "Key Deduplication", "Standardization", "Outlier Capping",
)
