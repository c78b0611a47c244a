"""All reports of a warehouse by name, and their export."""

from churnmart.plans import marts
from churnmart.plans.warehouse import Warehouse
from churnmart.sources.writers import overwrite_files

REPORTS = {
    "geo_gender_churn": lambda w: marts.geo_gender_churn(w.dim_customer),
    "revenue_at_risk": lambda w: marts.revenue_at_risk(w.dim_customer),
    "ltv_segments": lambda w: marts.ltv_segments(w.dim_customer),
    "monthly_churn_trend": lambda w: marts.monthly_churn_trend(w.fact_transactions, w.dim_date),
    "product_analysis": lambda w: marts.product_analysis(w.fact_transactions, w.dim_product),
    "at_risk_customers": lambda w: marts.at_risk_customers(w.dim_customer),
    "credit_tier_churn": lambda w: marts.credit_tier_churn(w.dim_customer),
    "member_status_churn": lambda w: marts.member_status_churn(w.dim_customer),
    "tenure_band_churn": lambda w: marts.tenure_band_churn(w.dim_customer),
    "executive_kpis": lambda w: marts.executive_kpis(w.dim_customer),
}


def export_reports(warehouse: Warehouse, out_dir: str, fmt="csv", names=None) -> list:
    """Write each report to ``out_dir/<name>``; an error stops the export.

    Reports are small and sorted, so each becomes one file.
    """
    written = []
    for name in names or REPORTS:
        path = f"{out_dir.rstrip('/')}/{name}"
        overwrite_files(REPORTS[name](warehouse).coalesce(1), path, fmt)
        written.append(path)
    return written
