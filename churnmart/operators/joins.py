"""Joins and expansions that hold up when one key owns a large part of the rows."""

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from churnmart.functions.exprs import col, quoted

_CHUNK = 100_000
# Items a frequency sketch keeps per partition of the shuffle, and the most Spark allows.
_TRACKED, _MOST_TRACKED, _MOST_HOT = 16, 1_000_000, 10_000


def hot_keys(df: DataFrame, *keys: str) -> list[dict]:
    """For each key column: its hot values (NULL among them) and the tasks each deserves.

    A value is hot if it has more rows than a shuffle partition gets on average, so there
    are fewer hot values than partitions. One pass over all rows fills a mergeable sketch
    per column; nothing is shuffled but the sketches.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(_MOST_TRACKED, max(1024, _TRACKED * parts))
    found = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k(`{k}`, {min(parts, _MOST_HOT)}, {tracked})").alias(f"k{i}")
          for i, k in enumerate(keys)],
    ).first()
    share = max(1.0, found.n / parts)
    return [
        {item["item"]: math.ceil(item["count"] / share)
         for item in found[f"k{i}"] if item["count"] > share}
        for i in range(len(keys))
    ]


class HotKeys:
    """Hot values of some key columns of a table, looked for when a join first needs one of them."""

    def __init__(self, df: DataFrame, *keys: str):
        self._df, self._keys, self._found = df, keys, None

    def of(self, key: str) -> dict:
        if self._found is None:
            self._found = dict(zip(self._keys, hot_keys(self._df, *self._keys)))
        return self._found[key]


def is_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst knows ``df`` to be small enough to send it whole to every task."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def salted_join(left: DataFrame, right: DataFrame, on: str, salt_by: Column, how="left",
                condition=None, hot: "dict | HotKeys | None" = None) -> DataFrame:
    """Equi-join on ``on`` (plus an optional extra ``condition``) that splits hot left keys.

    Rows of a hot key are spread over as many salts as it deserves tasks by ``salt_by``, a
    hash that differs between the rows of the key; only the right rows of those keys are
    repeated, once per salt. Other keys keep salt 0. The hot keys and their salts are a table
    of at most ``_MOST_HOT`` rows that each side looks up. No other side is broadcast by hint:
    Catalyst and AQE choose from real sizes. ``hot`` is what ``hot_keys`` found for the key, on
    a table rather than a long plan where possible, or ``HotKeys`` to look only if needed: a
    right side that Catalyst broadcasts by its size moves no left row, so nothing is looked for.
    By default ``left`` is looked at.
    """
    if not isinstance(hot, dict):
        hot = {} if is_broadcast(right) else (hot or HotKeys(left, on)).of(on)
    r_key, r_salt = f"__r_{on}", "__r_salt"
    renamed = right.withColumnRenamed(on, r_key)
    if not hot:
        match = col(on) == F.col(f"`{r_key}`")
        left_side, right_side = left, renamed
    else:
        # NULL keys find no partner, but an outer join must still carry their rows.
        named = [(k, n) for k, n in hot.items() if k is not None]
        key_type = left.schema[on].dataType
        schema = T.StructType([T.StructField("__hot", key_type), T.StructField("__salts", T.IntegerType())])
        table = F.broadcast(left.sparkSession.createDataFrame(named, schema))

        def looked_up(side, key):
            return side.join(table, F.col(f"`{key}`") == F.col("__hot"), "left") if named else side.withColumn("__salts", F.lit(None))

        salts = F.coalesce("__salts", F.when(col(on).isNull(), hot.get(None, 1)), F.lit(1))
        left_side = looked_up(left, on).withColumn("__salt", F.pmod(salt_by, salts).cast("int")).drop("__hot", "__salts")
        every = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
        right_side = looked_up(renamed, r_key).withColumn(r_salt, F.explode(every)).drop("__hot", "__salts")
        match = (col(on) == F.col(f"`{r_key}`")) & (F.col("__salt") == F.col(r_salt))
    if condition is not None:
        match = match & condition
    return left_side.join(right_side, match, how).drop("__salt", r_salt, r_key)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times over; large counts are spread over tasks in chunks."""
    chunks = F.sequence(F.lit(0), F.floor((col(times) - 1) / F.lit(_CHUNK)))
    split = df.where(col(times) > 0).withColumn("__chunk", F.explode(chunks))
    size = F.least(F.lit(_CHUNK).cast("long"), col(times) - F.col("__chunk") * F.lit(_CHUNK))
    split = split.withColumn("__size", size)
    if_large = F.when(col(times) > _CHUNK, F.col("__chunk")).otherwise(F.lit(0))
    # A fixed number of partitions: by bytes AQE would merge rows that are about to multiply.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = split.repartition(parts, F.xxhash64(*quoted(df.columns)), if_large)
    rows = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__size")))
    return spread.withColumn("__row", rows).drop("__chunk", "__size", "__row", times)
