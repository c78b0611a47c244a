"""Slowly changing dimension, type 2.

The feed and the dimension meet on the business key, where both sides are unique (current
version, latest feed row), so the joins cannot skew. Unchanged feed rows are dropped
before anything is written. What remains keeps the current version beside the feed row: the
versions it closes and opens follow from that one written table, without another join.
"""

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from churnmart.constants import HIGH_DATE, TRACKED_COLUMNS
from churnmart.functions.exprs import add_up, col, quoted
from churnmart.operators.cleanse import last_per_key
from churnmart.operators.ordering import global_rank
from churnmart.session import materialize

KEY = "customer_id"
# What stands before the columns of the current version beside a feed row.
_OLD = "__old_"


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.where("is_current = 1")


def latest_per_key(feed: DataFrame, order=None) -> DataFrame:
    """One feed row per customer: the last under ``order`` (ties: the largest row)."""
    last = last_per_key(feed, KEY, order)
    return last.drop(order) if order else last


def classify(dimension: DataFrame, feed: DataFrame, tracked=TRACKED_COLUMNS) -> DataFrame:
    """Feed rows with ``status`` new, changed or unchanged and the current version beside.

    Adds ``old_<column>`` per tracked column, ``old_sk``, ``old_version`` and ``old_start``. ``feed`` holds
    one row per customer. Values compare NULL-safe and typed.
    """
    current = current_versions(dimension).select(
        col(KEY).alias("__key"),
        F.col("customer_sk").alias("old_sk"),
        F.col("record_version").alias("old_version"),
        F.col("effective_start_date").alias("old_start"),
        *[col(c).alias(f"old_{c}") for c in tracked],
    )
    differs = add_up([
        F.when(col(c).eqNullSafe(col(f"old_{c}")), 0).otherwise(1) for c in tracked
    ])
    status = (
        F.when(F.col("__key").isNull(), "new").when(differs > 0, "changed").otherwise("unchanged")
    )
    joined = feed.join(current, col(KEY) == F.col("__key"), "left")
    return joined.withColumn("status", status).drop("__key")


def change_log(classified: DataFrame, load_date: date, tracked=TRACKED_COLUMNS) -> DataFrame:
    """One row per changed column of a changed customer."""
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_changed"),
            col(f"old_{c}").cast("string").alias("old_value"),
            col(c).cast("string").alias("new_value"),
            (~col(c).eqNullSafe(col(f"old_{c}"))).alias("differs"),
        )
        for c in tracked
    ])
    changed = classified.where("status = 'changed'").select(
        KEY, F.inline(F.filter(entries, lambda e: e["differs"]))
    )
    return changed.select(
        KEY, "column_changed", "old_value", "new_value", F.lit(load_date).alias("load_date")
    )


def largest_key(dimension: DataFrame) -> int:
    return dimension.agg(F.coalesce(F.max("customer_sk"), F.lit(0))).first()[0]


def changes(current: DataFrame, feed: DataFrame, load_date: date,
            tracked=TRACKED_COLUMNS, last_key: int | None = None) -> DataFrame:
    """What ``feed`` does to the current versions: the rows it closes and the rows it opens.

    New keys are one contiguous run after ``last_key`` (by default the largest in
    ``current``): versions first, then new customers, each in customer order. Customers absent
    from the feed, and unchanged ones, have no row here. A change on the day a version was
    opened replaces that version, so that no validity ends before it starts: nothing is closed
    then. Feed rows without a key are refused (``ValueError``).
    """
    keyless = feed.where(col(KEY).isNull()).count()
    if keyless:
        raise ValueError(f"{keyless} feed rows without {KEY}")
    # A feed row that comes twice closes its customer's version once.
    nth = F.row_number().over(Window.partitionBy(KEY, f"{_OLD}customer_sk").orderBy(f"{_OLD}customer_sk"))
    delta = beside(current, feed, tracked).where("status <> 'unchanged'").withColumn("__nth", nth)
    delta = materialize(delta, "scd2-delta")
    if last_key is None:
        last_key = largest_key(current)
    closed = ended(delta.where("__nth = 1"), load_date)
    return closed.unionByName(opened(delta.drop("__nth"), load_date, last_key), allowMissingColumns=True)


def beside(current: DataFrame, feed: DataFrame, tracked=TRACKED_COLUMNS) -> DataFrame:
    """Feed rows with ``status`` (see ``classify``) and the whole current version, as ``__old_<column>``.

    The rows that a feed closes and opens follow from it without another join.
    """
    versions = current_versions(current)
    old = versions.select(*[col(c).alias(f"{_OLD}{c}") for c in versions.columns])
    differs = add_up([
        F.when(col(c).eqNullSafe(col(f"{_OLD}{c}")), 0).otherwise(1) for c in tracked
    ])
    status = (
        F.when(col(f"{_OLD}{KEY}").isNull(), "new").when(differs > 0, "changed").otherwise("unchanged")
    )
    return feed.join(old, col(KEY) == col(f"{_OLD}{KEY}"), "left").withColumn("status", status)


def old_versions(rows: DataFrame) -> DataFrame:
    """The versions beside the feed rows of ``beside``, under their own names."""
    names = [c for c in rows.columns if c.startswith(_OLD)]
    return rows.select(*[col(c).alias(c.removeprefix(_OLD)) for c in names])


def _same_day(load_date: date):
    return col(f"{_OLD}effective_start_date") >= F.lit(load_date)


def ended(delta: DataFrame, load_date: date) -> DataFrame:
    """The versions that the changed rows of ``delta``, see ``beside``, close."""
    ending = delta.where("status = 'changed'").where(~_same_day(load_date)).where(col(f"{_OLD}customer_sk").isNotNull())
    return old_versions(ending).withColumns({
        "effective_end_date": F.lit(load_date - timedelta(days=1)), "is_current": F.lit(0),
    })


def opened(delta: DataFrame, load_date: date, last_key: int) -> DataFrame:
    """The versions that the changed and new rows of ``delta``, a written table of ``beside``, open."""
    version = f"{_OLD}record_version"
    kept = [c for c in delta.columns if not c.startswith(_OLD) and c != "status"]
    rows = delta.select(
        *quoted(kept), (F.col("status") == "new").cast("int").alias("__new"), version, f"{_OLD}effective_start_date")
    ranked = global_rank(rows, ["__new", KEY], "customer_sk", start=last_key)
    return ranked.withColumns({
        "effective_start_date": F.lit(load_date),
        "effective_end_date": F.lit(HIGH_DATE),
        "is_current": F.lit(1),
        "record_version": F.when(_same_day(load_date), col(version))
        .otherwise(F.coalesce(col(version), F.lit(0)) + 1),
    }).drop("__new", version, f"{_OLD}effective_start_date")


def merge(dimension: DataFrame, feed: DataFrame, load_date: date,
          tracked=TRACKED_COLUMNS, last_key: int | None = None) -> DataFrame:
    """The dimension after ``feed``: expired versions, new versions, new customers.

    The whole dimension as a plan, for those who go on with it; a stored dimension takes
    only the ``changes``, see ``DimensionVersions``. Customers absent from the feed stay as
    they are; the same feed again changes nothing. ``dimension`` is read, never overwritten;
    only its current rows meet the feed, closed ones pass through.
    """
    if last_key is None:
        last_key = largest_key(dimension)
    delta = changes(current_versions(dimension), feed, load_date, tracked, last_key)
    opened = delta.where("is_current = 1").select(col(KEY).alias("__key"))
    kept = current_versions(dimension).join(opened, col(KEY) == F.col("__key"), "left_anti")
    closed = dimension.where(~F.col("is_current").eqNullSafe(F.lit(1)))
    return closed.unionByName(kept).unionByName(delta, allowMissingColumns=True)


def load(versions, feed: DataFrame, load_date: date, base: int | None = None) -> int:
    """Merges ``feed`` into a stored dimension (``DimensionVersions``); returns the new version.

    Only the changed and new rows are written. ``base`` is the version to start from, by
    default the latest.
    """
    base = versions.latest() if base is None else base
    delta = changes(versions.current(base), feed, load_date, last_key=versions.last_key(base))
    return versions.change(delta, base=base)


def verify(dimension: DataFrame) -> DataFrame:
    """Row, version and customer counts as one row."""
    historical = F.col("is_current") == 0
    return dimension.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_current") == 1).alias("current_rows"),
        F.count_if(historical).alias("historical_rows"),
        F.count_distinct(F.when(historical, col(KEY))).alias("multi_version_customers"),
    )


def history(dimension: DataFrame, customer_id=None) -> DataFrame:
    """Versions in order, of one customer or (None) of every customer with history."""
    shown = [
        KEY, "geography", "num_of_products", "is_active_member", "effective_start_date",
        "effective_end_date", "is_current", "record_version",
    ]
    if customer_id is not None:
        versions = dimension.where(col(KEY) == customer_id)
    else:
        versioned = dimension.where("is_current = 0").select(KEY).distinct()
        versions = dimension.join(versioned, KEY, "left_semi")
    return versions.select(*shown).orderBy(KEY, "record_version")

