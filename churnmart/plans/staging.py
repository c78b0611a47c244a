"""Raw customers to staged customers: T2 .. T8 as one chain."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from churnmart import constants as C
from churnmart.operators.cleanse import (
    cap_outliers,
    deduplicate,
    fit_caps,
    fit_fill_values,
    impute,
    standardize,
)
from churnmart.functions.exprs import quoted
from churnmart.operators.derive import derive_columns, risk_score
from churnmart.operators.ordering import surrogate_key
from churnmart.session import materialize


_COPIES = "__copies"


@dataclass(frozen=True)
class Cleansing:
    """T2-T4 of a feed as written tables: its different rows, and one clean row per key."""

    raw: DataFrame
    different: DataFrame
    rows: DataFrame


def cleanse_feed(raw: DataFrame) -> Cleansing:
    """T2-T4. Both tables are written once; the caps are fitted on the last, and later steps read it.

    Copies combine before the shuffle; each different row keeps the number of its copies, so
    that the rows of every step can be counted on what this run has written.
    """
    filled = impute(raw, fit_fill_values(raw))
    counted = filled.groupBy(*quoted(filled.columns)).agg(F.count(F.lit(1)).alias(_COPIES))
    different = materialize(counted, "different")
    rows = standardize(deduplicate(different.drop(_COPIES)))
    return Cleansing(raw, different, materialize(rows, "cleansed"))


def cleansed(raw: DataFrame) -> DataFrame:
    return cleanse_feed(raw).rows


def enrich(standardized: DataFrame) -> DataFrame:
    """T5-T7 in one projection."""
    capped = cap_outliers(standardized, fit_caps(standardized))
    return risk_score(derive_columns(capped))


def to_warehouse_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(C.WAREHOUSE_NAMES)


def initial_versions(df: DataFrame, load_date: date) -> DataFrame:
    """T8 without the key: every row is the open first version from ``load_date`` on."""
    return df.withColumns({
        "effective_start_date": F.lit(load_date),
        "effective_end_date": F.lit(C.HIGH_DATE),
        "is_current": F.lit(1),
        "record_version": F.lit(1),
    })


def feed_rows(raw: DataFrame) -> DataFrame:
    """A cleaned and enriched feed in warehouse names, with its order column ``RowNumber``."""
    return to_warehouse_names(enrich(cleansed(raw)))


def stage_cleansed(standardized: DataFrame, load_date: date) -> DataFrame:
    """T5-T8 on a cleansed feed; keys follow the order of the feed."""
    versions = initial_versions(to_warehouse_names(enrich(standardized)), load_date)
    keyed = surrogate_key(versions, "customer_sk", [C.RAW_ORDER, "customer_id"])
    return keyed.drop(C.RAW_ORDER)


def stage_customers(raw: DataFrame, load_date: date) -> DataFrame:
    """Staged customer dimension of an initial load, T2-T8."""
    return stage_cleansed(cleansed(raw), load_date)


@dataclass(frozen=True)
class StagingRun:
    """Staged customers, a written table, and the rows before and after each step of that run."""

    customers: DataFrame
    steps: DataFrame


def run_staging(raw: DataFrame, load_date: date) -> StagingRun:
    """T2-T8 with step counts, both from one run."""
    done = cleanse_feed(raw)
    customers = materialize(stage_cleansed(done.rows, load_date), "staged")
    return StagingRun(customers, step_counts(done, customers))


def step_counts(done: Cleansing, staged: DataFrame) -> DataFrame:
    """Rows before and after each staging step, counted on the tables that the run wrote.

    A finished table counts each row once, however often its tasks had to run. Standardisation
    belongs to the pass that writes one row per key, capping to that which writes ``staged``.
    """
    rows = F.count(F.lit(1))
    per_key, ended = done.rows.select(rows), staged.select(rows)
    seen = done.raw.select(rows.alias("0")).select(
        "*",
        done.different.select(F.coalesce(F.sum(_COPIES), F.lit(0))).scalar().alias("1"),
        done.different.select(rows).scalar().alias("2"),
        per_key.scalar().alias("3"),
        per_key.scalar().alias("4"),
        ended.scalar().alias("5"),
    )
    return seen.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(str(i - 1)).alias("rows_before"),
            F.col(str(i)).alias("rows_after"), (F.col(str(i - 1)) - F.col(str(i))).alias("rows_removed"),
        )
        for i, name in enumerate(C.STAGING_STEPS, 1)
    ])))
