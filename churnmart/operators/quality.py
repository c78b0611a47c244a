"""Data-quality profiles and gates. Reports are rows, not text."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from churnmart import constants as C
from churnmart.functions.exprs import add_up, col, quoted, round_even, share_pct
from churnmart.operators.joins import HotKeys, repeat_rows, salted_join
from churnmart.operators.ordering import wide_quantiles


def _rows(stats: DataFrame, entries) -> DataFrame:
    """Turn the one row of ``stats`` into one row per entry (name -> column)."""
    return stats.select(F.inline(F.array(*[
        F.struct(*[value.alias(name) for name, value in entry.items()]) for entry in entries
    ])))


def column_inventory(df: DataFrame) -> DataFrame:
    """Position, name, type and a sample value (the smallest, so that it is stable)."""
    stats = df.agg(*[F.min(col(f.name)).cast("string").alias(f.name) for f in df.schema])
    return _rows(stats, [
        {
            "position": F.lit(i),
            "column": F.lit(f.name),
            "dtype": F.lit(f.dataType.simpleString()),
            "sample_value": F.coalesce(col(f.name), F.lit("N/A")),
        }
        for i, f in enumerate(df.schema, 1)
    ])


def schema_diff(df: DataFrame, expected=C.EXPECTED_RAW_COLUMNS) -> DataFrame:
    """Every expected or present column: ok, missing or unexpected, and its filled cells."""
    stats = df.agg(*[F.count(col(c)).alias(c) for c in df.columns])
    present = [
        {
            "column": F.lit(c),
            "status": F.lit("ok" if c in expected else "unexpected"),
            "non_null": col(c),
        }
        for c in df.columns
    ]
    missing = [
        {
            "column": F.lit(c),
            "status": F.lit("missing"),
            "non_null": F.lit(0).cast("long"),
        }
        for c in expected if c not in df.columns
    ]
    return _rows(stats, present + missing)


def profile_nulls(df: DataFrame) -> DataFrame:
    """NULL count, percentage and status per column, one pass."""
    stats = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(col(c).isNull()).alias(c) for c in df.columns],
    )
    return _rows(stats, [
        {
            "column": F.lit(c),
            "null_count": col(c),
            "null_pct": share_pct(col(c), F.col("__rows"), 2),
            "status": F.when(col(c) == 0, "OK").otherwise("NEEDS TREATMENT"),
        }
        for c in df.columns
    ])


def profile_duplicates(df: DataFrame, key=C.RAW_KEY) -> DataFrame:
    """Rows that repeat an earlier row, and rows that repeat an earlier key.

    Copies collapse into counts before each shuffle; the key level builds on the row level.
    """
    rows = df.groupBy(*quoted(df.columns)).agg(F.count(F.lit(1)).alias("__n"))
    keys = rows.groupBy(col(key)).agg(
        F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__distinct")
    )
    return keys.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("__n") - F.col("__distinct")), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """All members of every group of identical rows."""
    counted = df.groupBy(*quoted(df.columns)).agg(F.count(F.lit(1)).alias("__n"))
    return repeat_rows(counted.where("__n > 1"), "__n")


def duplicate_keys(df: DataFrame, key=C.RAW_KEY, shown=(C.RAW_ORDER, "Surname")) -> DataFrame:
    """All rows (key and ``shown`` columns) whose key occurs more than once, by key."""
    wanted = [key, *shown]
    rows = df.groupBy(*quoted(wanted)).agg(F.count(F.lit(1)).alias("__n"))
    repeated = rows.groupBy(col(key)).agg(F.sum("__n").alias("__m")).where("__m > 1").select(key)
    members = salted_join(
        rows, repeated, key, F.xxhash64(*[col(c) for c in shown]), "inner",
        hot=HotKeys(df, key),
    )
    return repeat_rows(members, "__n").select(*quoted(wanted)).orderBy(key, *shown)


def churn_distribution(df: DataFrame) -> DataFrame:
    """Class balance of the churn flag, one row."""
    stats = df.agg(F.count(F.lit(1)).alias("total"), F.sum("Exited").alias("churned"))
    active = F.col("total") - F.col("churned")
    ratio = F.try_divide(F.col("churned").cast("double"), active.cast("double"))
    return stats.select(
        "total", "churned", active.alias("active"),
        share_pct(active, F.col("total"), 1).alias("active_pct"),
        share_pct(F.col("churned"), F.col("total"), 1).alias("churned_pct"),
        round_even(ratio, 2).alias("churn_to_active_ratio"),
        (ratio < C.IMBALANCE_RATIO).cast("int").alias("imbalanced"),
    )


def outliers_iqr(df: DataFrame, columns=C.OUTLIER_COLUMNS) -> DataFrame:
    """Tukey fences per column, rows outside, and the column's extremes."""
    found = wide_quantiles(df, columns, [0.25, 0.75], statistics={
        "least": "min({v})", "most": "max({v})",
    })
    quartiles = {r["column"]: r for r in found.collect()}
    fences = {
        c: (r.q0 - C.IQR_FENCE * (r.q1 - r.q0), r.q1 + C.IQR_FENCE * (r.q1 - r.q0))
        for c, r in quartiles.items()
    }
    stats = df.agg(F.count(F.lit(1)).alias("__rows"), *[
        F.count_if((col(c) < low) | (col(c) > high)).alias(f"n_{c}") for c, (low, high) in fences.items()
    ])
    return _rows(stats, [
        {
            "column": F.lit(c),
            "lower_fence": F.lit(low),
            "upper_fence": F.lit(high),
            "outliers": col(f"n_{c}"),
            "outlier_pct": share_pct(col(f"n_{c}"), F.col("__rows"), 1),
            "min_value": F.lit(quartiles[c].least),
            "max_value": F.lit(quartiles[c].most),
        }
        for c, (low, high) in fences.items()
    ])


def quality_gate(staged: DataFrame, source_count: Column) -> DataFrame:
    """All staging checks, with the ``gate`` decided by retention, mandatory values and keys.

    ``source_count`` is a literal or scalar subquery with the row count of the raw feed.
    """
    stats = staged.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(col(c).isNull()).alias(f"null_{c}") for c in C.MANDATORY_COLUMNS],
        F.count_if(~F.col("is_current").eqNullSafe(F.lit(1))).alias("not_current"),
        F.count_if(~F.coalesce(F.col("churn_flag").isin(0, 1), F.lit(False))).alias("not_binary"),
    )
    repeats = duplicates_of(staged, "customer_sk")
    current = staged.where("is_current = 1")
    # Every part below is exactly one row.
    stats = stats.select(
        "*",
        repeats.scalar().alias("sk_repeats"),
        duplicates_of(current, "customer_id").scalar().alias("current_repeats"),
        source_count.alias("__source"),
    )
    lost = F.greatest(F.lit(0).cast("long"), F.ceil(
        F.col("__source") * F.lit(C.MIN_RETENTION_PCT) / 100).cast("long") - F.col("__rows"))
    checks = [("row_retention", lost)]
    checks += [(f"mandatory_{c}", col(f"null_{c}")) for c in C.MANDATORY_COLUMNS]
    checks += [("surrogate_key_unique", F.col("sk_repeats"))]
    gate = reduce(lambda a, b: a & b, [bad == 0 for _, bad in checks])
    informational = [
        ("all_current", F.col("not_current")),
        ("churn_flag_binary", F.col("not_binary")),
        ("one_current_row_per_customer", F.col("current_repeats")),
    ]
    entries = [(n, b, 1) for n, b in checks] + [(n, b, 0) for n, b in informational]
    rows = _rows(stats, [
        {
            "check": F.lit(name),
            "violations": bad,
            "status": F.when(bad == 0, "OK").otherwise("FAIL"),
            "decides_gate": F.lit(decides),
            "gate": F.when(gate, "PASSED").otherwise("FAILED"),
        }
        for name, bad, decides in entries
    ])
    return rows


def duplicates_of(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per key, one row."""
    counted = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"))


def _report(parts) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _section(stats: DataFrame, section: str, metrics: dict) -> DataFrame:
    return _rows(stats, [
        {
            "section": F.lit(section),
            "metric": F.lit(name),
            "value": value.cast("double"),
        }
        for name, value in metrics.items()
    ])


def validation_report(df: DataFrame, key=C.RAW_KEY) -> DataFrame:
    """Raw-data validation as (section, metric, value) rows."""
    n = F.col("__rows")
    nulls = {c: col(c) for c in df.columns}
    stats = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        F.sum("Exited").alias("__churned"),
        *[F.count_if(col(c).isNull()).alias(c) for c in df.columns],
    )
    with_nulls = add_up([F.when(v > 0, 1).otherwise(0) for v in nulls.values()])
    dups = profile_duplicates(df, key)
    return _report([
        _section(stats, "dataset", {
            "total_rows": n,
            "total_columns": F.lit(len(df.columns)),
            "columns_with_nulls": with_nulls,
            "churn_rate_pct": share_pct(F.col("__churned"), n, 1),
        }),
        _section(dups, "duplicates", {
            "duplicate_rows": F.col("duplicate_rows"),
            "duplicate_customer_ids": F.col("duplicate_keys"),
        }),
        _section(stats, "nulls", nulls),
    ])


def etl_quality_report(staged: DataFrame, source_count: Column) -> DataFrame:
    """Staging result as (section, metric, value) rows."""
    n = F.col("__rows")
    stats = staged.agg(
        F.count(F.lit(1)).alias("__rows"),
        F.sum("churn_flag").alias("churned"),
        F.count_if(F.col("churn_flag") == 0).alias("active"),
        *[
            F.count_if(F.col("risk_category") == c).alias(c) for c in C.RISK_CATEGORIES.labels
        ],
    ).withColumn("__source", source_count)
    gate = quality_gate(staged, source_count).agg(
        F.min((F.col("gate") == "PASSED").cast("int")).alias("passed")
    )
    return _report([
        _section(stats, "volume", {
            "source_rows": F.col("__source"),
            "staging_rows": n,
            "retention_pct": share_pct(n, F.col("__source"), 1),
            "staging_columns": F.lit(len(staged.columns)),
        }),
        _section(gate, "gate", {"passed": F.col("passed")}),
        _section(stats, "churn", {
            "churned": F.col("churned"),
            "active": F.col("active"),
            "churned_pct": share_pct(F.col("churned"), n, 1),
        }),
        _section(stats, "risk", {c: col(c) for c in C.RISK_CATEGORIES.labels}),
    ])
