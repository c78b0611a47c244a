"""Staging steps T2-T5: impute, deduplicate, standardise, cap.

Statistics are a bounded handful of numbers, fitted once and applied as literals, so the
row-wise steps fuse into one projection without joins or subqueries.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from churnmart import constants as C
from churnmart.functions.exprs import clip, col, round_even, strip_ws, title_case
from churnmart.operators.ordering import modes, wide_quantiles

MEDIAN_FILLED = ("CreditScore", "EstimatedSalary", "Age", "Tenure")
WHOLE_MEDIAN_FILLED = ("Age", "Tenure")
MODE_FILLED = ("HasCrCard", "IsActiveMember", "Geography", "Gender")


@dataclass(frozen=True)
class FillValues:
    """What a NULL becomes, per column."""

    values: dict


@dataclass(frozen=True)
class Caps:
    """Lower and upper cap per column."""

    limits: dict


def fit_fill_values(df: DataFrame) -> FillValues:
    """Medians and modes over all rows, duplicates included (imputation precedes dedup)."""
    values = {"Balance": 0.0}
    for row in wide_quantiles(df, MEDIAN_FILLED, [0.5]).collect():
        values[row["column"]] = int(row.q0) if row["column"] in WHOLE_MEDIAN_FILLED else row.q0
    for row in modes(df, MODE_FILLED).collect():
        values[row["column"]] = row.text if row.number is None else int(row.number)
    return FillValues(values)


def impute(df: DataFrame, fill: FillValues) -> DataFrame:
    """T2: NULLs to zero, median or mode; columns without any value stay NULL."""
    present = {c: fill.values[c] for c in fill.values if c in df.columns}
    # A median can be fractional where the column holds integers.
    widened = {
        c: F.coalesce(
            col(c).cast("double") if isinstance(v, float) else col(c), F.lit(v)
        )
        for c, v in present.items()
    }
    return df.withColumns(widened)


def deduplicate(df: DataFrame, key=C.RAW_KEY, order=C.RAW_ORDER) -> DataFrame:
    """T3: one row per key, the one that comes last. The order column is kept: it still
    numbers the surrogate keys and is dropped after that.

    Exact copies agree on key and order, so keeping the last row per key covers them as
    well. Each task keeps one row per key before the shuffle (a limit inside the window).
    """
    return last_per_key(df, key, order)


def last_per_key(df: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per ``key``: the last by ``order``, then the largest in the other columns."""
    rest = [c for c in df.columns if c not in (key, order)]
    last = Window.partitionBy(col(key)).orderBy(*[
        col(c).desc() for c in ([order] if order else []) + rest])
    numbered = df.withColumn("__n", F.row_number().over(last))
    return numbered.where("__n = 1").drop("__n")


def standardize(df: DataFrame) -> DataFrame:
    """T4: integers truncated, money to two digits, text stripped and title-cased."""
    steps = {c: col(c).cast("bigint" if c == C.RAW_KEY else "int") for c in C.INTEGER_COLUMNS}
    steps |= {c: round_even(col(c), 2) for c in C.MONEY_COLUMNS}
    steps |= {c: title_case(strip_ws(col(c))) for c in C.TEXT_COLUMNS}
    return df.withColumns({c: e for c, e in steps.items() if c in df.columns})


def fit_caps(df: DataFrame) -> Caps:
    """1st and 99th percentile of each capped column, exact."""
    found = wide_quantiles(df, C.CAPPED_COLUMNS, C.CAP_PROBABILITIES)
    return Caps({row["column"]: (row.q0, row.q1) for row in found.collect()})


def _domain_limits(caps: Caps) -> dict:
    return {
        **{c: caps.limits[c] for c in C.CAPPED_COLUMNS if c in caps.limits},
        "Age": (C.AGE_MIN, C.AGE_MAX),
        "Tenure": (C.TENURE_MIN, C.TENURE_MAX),
    }


def cap_outliers(df: DataFrame, caps: Caps) -> DataFrame:
    """T5: limit to the caps and to the domain ranges of age and tenure; no row is lost."""
    return df.withColumns({
        c: clip(col(c).cast("double") if c in caps.limits else col(c), low, high)
        for c, (low, high) in _domain_limits(caps).items()
    })


def cap_counts(df: DataFrame, caps: Caps) -> DataFrame:
    """Caps and number of values they change, per column, in one pass over ``df``."""
    limits = _domain_limits(caps)
    counts = df.agg(*[
        F.count_if((col(c) < low) | (col(c) > high)).alias(c) for c, (low, high) in limits.items()
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(low)).alias("lower_cap"),
            F.lit(float(high)).alias("upper_cap"),
            col(c).alias("values_capped"),
        )
        for c, (low, high) in limits.items()
    ])))
