"""Per-column and per-group profiles, the data behind the exploratory plots.

Group keys that are NULL are left out here (marts keep them).
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from churnmart import constants as C
from churnmart.functions.exprs import (
    adjusted_skew,
    bin_label,
    col,
    correlation_label,
    round_even,
    share_pct,
)
from churnmart.operators.ordering import exact_quantiles, wide_quantiles
from churnmart.session import materialize


# Rows a typical value of a column is taken from, and the share of a sum of squares that is rounding.
_TYPICAL_ROWS, _ROUNDING = 1000, 1e-12


def numeric_columns(df: DataFrame) -> list:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe_numeric(df: DataFrame, columns=None, digits=2) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    columns = columns or numeric_columns(df)
    found = wide_quantiles(df, columns, [0.25, 0.5, 0.75], statistics={
        "mean": "avg({v})", "std": "stddev_samp({v})", "min": "min({v})", "max": "max({v})",
    })
    return found.select(
        "column",
        F.col("n").alias("count"),
        *[
            round_even(F.col(c), digits).alias(name)
            for c, name in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q0", "p25"),
                            ("q1", "p50"), ("q2", "p75"), ("max", "max"))
        ],
    )


def univariate_stats(df: DataFrame, columns) -> DataFrame:
    """min, max, mean, median, std and bias-corrected skew per column."""
    found = wide_quantiles(df, columns, [0.5], statistics={
        "min": "min({v})", "max": "max({v})", "mean": "avg({v})", "std": "stddev_samp({v})", "g1": "skewness({v})",
    })
    skew = adjusted_skew(F.col("n"), F.col("g1"), F.col("min") == F.col("max"))
    return found.select(
        "column", "min", "max", round_even(F.col("mean"), 1).alias("mean"), round_even(F.col("q0"), 1).alias("median"),
        round_even(F.col("std"), 1).alias("std"), round_even(skew, 3).alias("skew"),
    )


def _row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery: for files it is read from their footers."""
    return df.select(F.count(F.lit(1))).scalar()


def churn_table(df: DataFrame, key: str | Column, name: str, flag="Exited", share=False) -> DataFrame:
    """Customers, churned and churn rate (percent, one digit) per key."""
    group = col(key) if isinstance(key, str) else key
    grouped = (
        df.select(group.alias(name), col(flag).alias("__flag"))
        .where(col(name).isNotNull())
        .groupBy(name)
        .agg(F.count("__flag").alias("total"), F.sum("__flag").alias("churned"))
        .withColumn("churn_rate_pct", share_pct(F.col("churned"), F.col("total"), 1))
    )
    if share:
        grouped = grouped.withColumn(
            "pct_of_customers", share_pct(F.col("total"), _row_count(df), 1)
        )
    return grouped.orderBy(name)


def _all_bins(df: DataFrame, bands: C.Bands) -> DataFrame:
    """Ordinal and label of every band: a few literal rows."""
    pairs = [F.struct(F.lit(i).alias("ordinal"), F.lit(b).alias("label"))
             for i, b in enumerate(bands.labels, 1)]
    return df.sparkSession.range(1).select(F.inline(F.array(*pairs)))


def banded_churn(df: DataFrame, column: str, bands: C.Bands) -> DataFrame:
    """Churn table per band in band order; empty bands show 0 customers and no rate."""
    found = (
        df.select(bin_label(col(column), bands).alias("label"), "Exited")
        .where("label is not null").groupBy("label")
        .agg(F.count("Exited").alias("total"), F.sum("Exited").alias("churned"))
    )
    return _all_bins(df, bands).join(found, "label", "left").select(
        "ordinal",
        "label",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("churned", F.lit(0)).alias("churned"),
        share_pct(F.col("churned"), F.col("total"), 1).alias("churn_rate_pct"),
    ).orderBy("ordinal")


def banded_counts(df: DataFrame, column: str, bands: C.Bands) -> DataFrame:
    """Rows per band in band order, with the share of all rows (unbanded ones included)."""
    counted = (
        df.groupBy(bin_label(col(column), bands).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _all_bins(df, bands).join(counted, "label", "left").select(
        "ordinal",
        "label",
        F.coalesce("n", F.lit(0)).alias("customers"),
        share_pct(F.coalesce("n", F.lit(0)), _row_count(df), 1).alias("pct"),
    ).orderBy("ordinal")


def value_counts(df: DataFrame, columns=C.CATEGORICAL_COLUMNS) -> DataFrame:
    """Count per value, and its share of all rows, for several columns in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns
    ]
    counted = (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    # NULL cells count as rows, not as a value.
    return (
        counted.withColumn("pct", share_pct(F.col("n"), _row_count(df), 1))
        .where("value is not null")
        .orderBy("column", F.col("n").desc(), "value")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).where(col(column).isNotNull()).distinct().orderBy(col(column))


def balance_segments(df: DataFrame) -> DataFrame:
    """Zero, non-zero and high-value balances, one row."""
    balance = col("Balance")
    positive, high = balance > 0, balance > C.HIGH_VALUE_BALANCE
    rows = F.count(F.lit(1))
    stats = df.agg(
        rows.alias("customers"),
        F.count_if(balance == 0).alias("zero_balance"),
        share_pct(F.count_if(balance == 0), rows, 1).alias("zero_balance_pct"),
        round_even(F.avg(F.when(positive, balance)), 0).alias("nonzero_mean"),
        F.count_if(high).alias("high_value"),
        share_pct(F.sum(F.when(high, F.col("Exited"))), F.count(F.when(high, F.col("Exited"))), 1)
        .alias("high_value_churn_rate_pct"),
    )
    positive_rows = df.where(positive).select(balance.alias("value"))
    found = exact_quantiles(positive_rows, "value", [0.5])
    median = found.select(round_even(F.col("q0"), 0))
    return stats.withColumn("nonzero_median", median.scalar())


def correlations(df: DataFrame, pairs, digits: int) -> DataFrame:
    """Pearson correlation per pair, incomplete observations left out pair by pair.

    One scan and one aggregate. Rows are grouped by which of the columns are NULL, few patterns
    in practice; a pattern sums its values and their products, with NULL as zero, and a pair
    adds up the patterns that have both sides. Values are taken from a typical one of the
    column, so that the squares of large numbers do not swallow the spread. NULL where a side
    is constant or no row has both.
    """
    pairs = list(pairs)
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: i for i, c in enumerate(columns)}
    values = df.select(*[col(c).cast("double").alias(f"v{i}") for c, i in at.items()])
    # Any value would do; of the first rows the middle one is no outlier.
    typical = values.limit(_TYPICAL_ROWS).agg(*[F.percentile_approx(v, 0.5).alias(v) for v in values.columns]).first()
    near = values.select(
        F.expr(f"concat({', '.join(f'int({v} IS NOT NULL)' for v in values.columns)})").alias("p"),
        *[F.coalesce(F.col(v) - F.lit(typical[v] or 0.0), F.lit(0.0)).alias(v) for v in values.columns],
    )
    # As SQL text: as many calls would take longer than the query.
    products = dict.fromkeys([(i, i) for i in at.values()] + [tuple(sorted((at[x], at[y]))) for x, y in pairs])
    patterns = near.groupBy("p").agg(F.expr("count(1) AS n"), *[
        F.expr(f"sum(v{i}) AS s{i}") for i in at.values()
    ], *[F.expr(f"sum(v{i} * v{j}) AS s{i}_{j}") for i, j in products])
    rows = []
    for k, (x, y) in enumerate(pairs):
        i, j = at[x], at[y]
        named = {"n": "n", "x": f"s{i}", "y": f"s{j}", "xx": f"s{i}_{i}", "yy": f"s{j}_{j}", "xy": f"s{min(i, j)}_{max(i, j)}"}
        both = f"substring(p, {i + 1}, 1) = '1' AND substring(p, {j + 1}, 1) = '1'"
        sums = ", ".join(f"'{name}', CASE WHEN {both} THEN {c} END" for name, c in named.items())
        rows.append(f"named_struct('k', {k}, {sums})")
    each = patterns.select(F.expr(f"inline(array({', '.join(rows)}))"))
    total = each.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    spread_x, spread_y = (F.col(s + s) - F.col(s) * F.col(s) / F.col("n") for s in "xy")
    varies = (spread_x > F.col("xx") * _ROUNDING) & (spread_y > F.col("yy") * _ROUNDING)
    both = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    corr = F.when(varies, F.try_divide(both, F.sqrt(spread_x) * F.sqrt(spread_y)))
    sides = [F.element_at(F.array(*map(F.lit, side)), F.col("k") + 1) for side in zip(*pairs)]
    return total.select(sides[0].alias("x"), sides[1].alias("y"), round_even(corr, digits).alias("corr"))


def correlation_matrix(df: DataFrame, columns=C.CORRELATION_COLUMNS, digits=2) -> DataFrame:
    """The full matrix in long form (both triangles and the diagonal)."""
    columns = list(columns)
    upper = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    half = correlations(df, upper, digits)
    both = F.when(
        F.col("x") == F.col("y"), F.array(F.struct("x", "y", "corr"))
    ).otherwise(F.array(
        F.struct("x", "y", "corr"),
        F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "corr"),
    ))
    return half.select(F.inline(both)).orderBy("x", "y")


def correlation_with_target(df: DataFrame, columns=C.CORRELATION_COLUMNS, target="Exited",
                            digits=2) -> DataFrame:
    """Each column's correlation with the target, strongest first."""
    pairs = [(c, target) for c in columns if c != target]
    return correlations(df, pairs, digits).select(
        F.col("x").alias("column"), "corr", correlation_label(F.col("corr")).alias("label")
    ).orderBy(F.abs("corr").desc(), "column")


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width histogram over the column's range, empty bins included.

    Bins are right-open, the last one closed; values are binned as they are. With ``by``
    each group has its own range.
    """
    keys = [by] if by else []
    values = df.where(col(column).isNotNull()).select(
        *[col(k) for k in keys], col(column).cast("double").alias("v")
    )
    ranges = values.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo is not null")
    # A constant column gets a range of one unit around its value.
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        *keys, F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    # One row per group, written: used twice, and the join is planned from its true size.
    ranges = materialize(ranges, "histogram-ranges")
    if keys:
        joined = values.join(ranges, keys)
    else:
        edges = ranges.select(F.struct("lo", "hi")).scalar()
        joined = values.withColumn("__r", edges).select("v", "__r.*")
    slot = F.floor((F.col("v") - F.col("lo")) * F.lit(bins) / (F.col("hi") - F.col("lo")))
    bin_no = F.least(slot, F.lit(bins - 1)).cast("int")
    # Counts combine before the shuffle: a few rows per bin and task.
    filled = joined.groupBy(*keys, (bin_no + 1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))

    def edge(i):
        return round_even(F.col("lo") + (F.col("hi") - F.col("lo")) * i / F.lit(float(bins)), 4)

    return every.join(filled, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        edge(F.col("bin") - 1).alias("lower"),
        edge(F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("customers"),
    ).orderBy(*keys, "bin")


def box_stats(df: DataFrame, column: str, by="Exited") -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR) and outlier count per group."""
    values = df.where(col(column).isNotNull() & col(by).isNotNull()).select(
        col(by), col(column).cast("double").alias("v")
    )
    quartiles = exact_quantiles(values, "v", [0.25, 0.5, 0.75], [by])
    reach = (F.col("q2") - F.col("q0")) * C.IQR_FENCE
    fences = quartiles.withColumns({"lo": F.col("q0") - reach, "hi": F.col("q2") + reach})
    # Written: three uses, and the join is planned from its true size.
    fenced = values.join(materialize(fences, "fences"), by)
    inside = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
    return fenced.groupBy(by).agg(
        F.max("q0").alias("q1"),
        F.max("q1").alias("median"),
        F.max("q2").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    ).orderBy(by)
