"""Headline timings. Prints one JSON line.

Environment: BENCH_SF_DIR (folder of given tables), BENCH_CPUS, BENCH_REPEAT (best of n).
Feeds and the warehouse are built first, timed as ``build_*``; the report queries then read
the stored tables, as they do after a nightly load. Pipeline queries (staging, merge,
fact) are timed as whole jobs including what they write in between. ``value`` is the sum of
pipeline queries and reports, ``total_with_builds`` adds the builds.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnmart.plans.catalog import Bank, bank, queries
from churnmart.session import build_session, temporary_tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))

PIPELINE = ["stg_customers", "scd2_merge", "fact_transactions", "scd2_asof_fact"]
REPORTS = [f"q{i}" for i in range(1, 11)] + ["balance_rank_within_group"]
PROFILES = [
    "null_profile", "dup_profile", "describe_numeric", "outliers_iqr", "value_counts",
    "corr_matrix", "hist_balance", "box_credit_by_churn", "pivot_age_tenure", "quality_gate",
    "fk_orphans",
]


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main():
    spark = build_session(
        "churnmart-bench", master=f"local[{CPUS}]", shuffle_partitions=CPUS,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="churnmart-bench-")},
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()

    tables = ("raw", "dirty", "dirty_cleansed", "staged", "dimension", "incoming", "merged",
              "products", "transactions", "survey", "dim_customer", "dim_product", "dim_date",
              "dim_churn_reason", "fact")
    seconds = {}
    # Every repetition builds everything anew; the last set of tables serves the reports.
    for n in range(REPEAT):
        b = bank(spark, SF_DIR) if n == REPEAT - 1 else Bank(spark, SF_DIR)
        for table in tables:
            took = timed(lambda: getattr(b, table))
            name = f"build_{table}"
            seconds[name] = min(took, seconds.get(name, took))
    run = queries()
    for name in PIPELINE + REPORTS + PROFILES:
        # The bank's own tables exist by now; what a run writes for itself goes again.
        for _ in range(REPEAT):
            with temporary_tables(spark):
                took = timed(lambda: consume(run[name](spark, SF_DIR)))
            seconds[name] = min(took, seconds.get(name, took))
    headline = sum(seconds[name] for name in PIPELINE + REPORTS)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "pipeline_and_reports_total",
        "value": round(headline, 3),
        "unit": "sec",
        "total_with_builds": round(headline + sum(
            value for name, value in seconds.items() if name.startswith("build_")), 3),
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
