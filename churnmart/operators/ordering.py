"""Global order without a single-task window: ranks, tiles, exact quantiles.

An unpartitioned window moves every row to one task. Here Spark range-partitions on the
*whole* sort key, so neither a hot leading value nor a hot group can fill one task, and
each row only needs its position inside its own partition plus the sizes of the
partitions before it. Sampled range bounds may differ between executions, therefore the
placement is written once and everything after reads the written table.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from churnmart.functions.exprs import col, count_bits, key_bits, key_bucket, quoted
from churnmart.session import materialize

_POS, _PART, _IDX, _TIE = "__pos", "__part", "__idx", "__tie"
# Keys that are sampled for each partition of an explicit order.
_SAMPLED = 50
# Layout of monotonically_increasing_id (partition above, row below).
_ROW_BITS = 33
# Rows of a block of an explicit order at most, about: few enough to be sorted in memory.
_BLOCK_ROWS = 500_000
# One over the error of the sketch of a column, and how far from a quantile its bracket ends.
_ACCURACY = 10_000
_NEAR, _FAR, _FEW = 2.5 / _ACCURACY, 0.02, 200
_NO_ENTRIES = "CAST(array() AS array<struct<__j: int, __v: double, __n: bigint>>)"
# Cells a bracket is cut into if it holds more different values than are sorted.
_CELLS, _SORTED = 1024, 100_000


def _direction(key):
    return key if isinstance(key, Column) else F.col(f"`{key}`").asc()


def _place(df: DataFrame, order, label: str, key_source: DataFrame | None = None) -> DataFrame:
    """Globally sorted, written once, with (partition, index in partition) per row.

    Rows that tie on the full key are spread by a random last key: any order among them
    is right, and a large group of copies does not end up in one task.
    """
    position = F.monotonically_increasing_id()
    if key_source is None:
        ordered = df.orderBy(*[_direction(k) for k in order], F.rand(17))
    else:
        ordered = _placed_by(df, order, key_source)
    placed = ordered.withColumn(_POS, position)
    placed = placed.withColumn(_PART, F.shiftright(_POS, _ROW_BITS).cast("int"))
    placed = placed.withColumn(_IDX, F.col(_POS).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    return materialize(placed.drop(_POS), label)


def _bounds(key_source: DataFrame, order) -> tuple[Column, Column, int]:
    """The first keys of all blocks but the first, their first columns, and the number of blocks.

    Keys are those of a sample of ``key_source``, with a random last one. The array is written:
    all who use it see the same.
    """
    rows = key_source.count()
    # As many as the rows need, also where the session has few shuffle partitions.
    parts = max(int(key_source.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // _BLOCK_ROWS))
    # A few dozen keys per partition.
    sample = key_source.select(*quoted(order)).sample(min(1.0, _SAMPLED * parts / max(1, rows)), seed=17)
    key = F.struct(*[col(c) for c in order], F.col(_TIE))
    keys = sample.withColumn(_TIE, F.rand(18)).agg(F.array_sort(F.collect_list(key)).alias("keys"))
    bounds = keys.select(F.transform(
        F.sequence(F.lit(1), F.lit(max(1, parts - 1))), lambda i: F.get("keys", F.floor(i * F.size("keys") / parts).cast("int"))
    ).alias("bounds"))
    firsts = F.transform("bounds", lambda b: b[order[0]]).alias("firsts")
    written = materialize(bounds.select("bounds", firsts), "bounds")
    return written.select("bounds").scalar(), written.select("firsts").scalar(), parts


def _with_block(df: DataFrame, name: str, parts: int, reached) -> DataFrame:
    """``df`` with ``name``: the number of the ``parts - 1`` leading bounds that are ``reached``, by position.

    A binary search, a column after the other: higher-order functions are not compiled. A step
    names the column before it twice and no more, as planning takes them all for one expression:
    with four times it took longer than the rows once there were some hundred bounds. ``reached``
    is NULL beyond the last bound.
    """
    found, at = df.withColumn(name, F.lit(0)), F.col(name)
    for step in (1 << i for i in reversed(range(max(1, parts - 1).bit_length()))):
        found = found.withColumn(name, at + F.when(reached(at + (step - 1)), step).otherwise(0))
    return found


def _in_blocks(df: DataFrame, order, bounds: Column, parts: int) -> DataFrame:
    """``df`` with a random last key ``__tie``, each row in its ``__block``, a partition."""
    key = F.struct(*[col(c) for c in order], F.col(_TIE))
    keyed = df.withColumn(_TIE, F.rand(17)).withColumns({"__bounds": bounds, "__key": key})
    placed = _with_block(keyed, "__block", parts, lambda i: F.get("__bounds", i) <= F.col("__key"))
    return placed.drop("__bounds", "__key").repartitionById(parts, "__block")


def _placed_by(df: DataFrame, order, key_source: DataFrame) -> DataFrame:
    """``df`` sorted by the columns ``order``, with bounds from a sample of ``key_source``.

    A sort of ``df`` itself would run all of its plan once more to sample it.
    """
    bounds, _, parts = _bounds(key_source, order)
    placed = _in_blocks(df, order, bounds, parts)
    return placed.sortWithinPartitions(*quoted(order), _TIE).drop("__block", _TIE)


def ranked_join(df: DataFrame, partner: DataFrame, on: str, order, name: str, columns: dict,
                key_source: DataFrame) -> DataFrame:
    """The inner join of ``df`` and ``partner`` by the first column of ``order``, ranked by ``order``.

    Result: the rank ``name`` (as in ``global_rank``), then ``columns``: name and expression
    over both sides. ``order`` names columns of ``df``, which lie in the table ``key_source``;
    ``on`` is the key of ``partner``.

    ``df`` is shuffled once, to the blocks of the order, and ``partner`` goes to the block that
    has its key: rows meet where they are sorted. A hot key of ``df`` spans many blocks, and
    its rows of ``partner`` go to each. Only ``columns`` are written, and a row for each block: the
    result adds the two up and may be read as often as a written table.
    """
    present = col(order[0]).isNotNull()
    bounds, firsts, parts = _bounds(key_source.where(present), order)
    left = _in_blocks(df.where(present), order, bounds, parts)
    spans = partner.where(col(on).isNotNull()).withColumn("__firsts", firsts)
    spans = _with_block(spans, "__low", parts, lambda i: F.get("__firsts", i) < col(on))
    spans = _with_block(spans, "__high", parts, lambda i: F.get("__firsts", i) <= col(on))
    spans = spans.withColumn("__to", F.explode(F.sequence("__low", "__high"))).drop("__firsts", "__low", "__high")
    right = spans.repartitionById(parts, "__to")
    # Sorts compare first keys by a prefix beside the row pointer: the key leads, for the block is
    # the same for a whole partition. Blocks are ranges of the order, so each stays in one piece.
    met = left.join(right, (col(order[0]) == col(on)) & (F.col("__block") == F.col("__to")))
    ordered = met.sortWithinPartitions(*quoted(order), _TIE)
    placed = ordered.select(F.col("__block").alias(_PART), F.monotonically_increasing_id().alias(_IDX),
                            *[e.alias(c) for c, e in columns.items()])
    placed = materialize(placed, f"rank-{name}")
    return _numbered(placed, name, list(columns), written=True).select(name, *quoted(columns))


def dense_start(df: DataFrame, key: str) -> int | None:
    """The smallest ``key`` if the keys of ``df`` are one run without gaps, copies or NULLs, else None.

    Keys are set in bitmaps that combine before the shuffle.
    """
    buckets = df.groupBy(key_bucket(key)).agg(
        key_bits(key), F.count(F.lit(1)).alias("__n"), F.min(col(key)).alias("__least"), F.max(col(key)).alias("__most"),
    )
    found = buckets.agg(
        F.sum("__n").alias("n"), count_bits().alias("different"),
        F.min("__least").alias("least"), F.max("__most").alias("most"),
    ).first()
    if found.n is None or found.least is None:
        return None
    return found.least if found.n == found.different == found.most - found.least + 1 else None


def global_rank(df: DataFrame, order, name: str, within=(), total=None, start=0,
                key_source: DataFrame | None = None) -> DataFrame:
    """Dense ``start + 1 .. start + N`` position of every row under ``order``.

    ``order`` holds column names or sort expressions and should end in a unique key.
    ``within`` restarts the count per group (a hot group still spans many tasks).
    ``total`` names an extra column with the number of rows counted.
    One range shuffle of the rows, then a broadcast join with the block offsets. Where ``df``
    is costly and ``order`` holds columns that lie in a table, ascending, ``key_source`` is
    that table: it is sampled for the ranges instead, and ``df`` runs once.
    """
    within = list(within)
    placed = _place(df, [*within, *order], f"rank-{name}", key_source)
    return _numbered(placed, name, df.columns, within, total, start)


def _numbered(placed: DataFrame, name: str, columns, within=(), total=None, start=0, written=False) -> DataFrame:
    """``columns`` of written rows in blocks, with their rank ``name``.

    ``written`` blocks are counted once, however often the result is read.
    """
    blocks = placed.groupBy(_PART, *quoted(within)).agg(
        F.count(F.lit(1)).alias("__n"), F.min(_IDX).alias("__first"), F.max(_IDX).alias("__last")
    )
    whole = F.col("__last") - F.col("__first") + 1 == F.col("__n")
    # One row per (partition, group): a few rows per shuffle partition, never the data.
    ordered = Window.partitionBy(*within).orderBy(_PART)
    blocks = blocks.select(
        F.col(_PART).alias("__b_part"),
        *[col(c).alias(f"__b_{c}") for c in within],
        # Positions count inside a block: it has to lie in one piece.
        F.when(whole, F.col("__first")).otherwise(F.raise_error(F.lit("a block in pieces")).cast("long"))
        .alias("__first"),
        F.coalesce(F.sum("__n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("__before"),
        F.sum("__n").over(Window.partitionBy(*within)).alias("__total"),
    )
    match = F.col(_PART) == F.col("__b_part")
    for c in within:
        match = match & col(c).eqNullSafe(F.col(f"`__b_{c}`"))
    if within:
        # Written, so that the join is planned from the true size of the block table.
        blocks = materialize(blocks, "blocks")
    else:
        # At most one row per shuffle partition.
        blocks = F.broadcast(materialize(blocks, "blocks") if written else blocks)
    rank = F.col("__before") + F.col(_IDX) - F.col("__first") + F.lit(1 + start)
    extra = [F.col("__total").alias(total)] if total else []
    return placed.join(blocks, match).select(
        *quoted(columns), rank.cast("long").alias(name), *extra
    )


def ntile_from_rank(rank: Column, total: Column, n: int) -> Column:
    """NTILE(n) from a rank and the row count: the first ``total % n`` tiles get one more."""
    size = F.floor(total / F.lit(n))
    larger = total - size * n
    in_larger = larger * (size + 1)
    return (
        F.when(rank <= in_larger, F.ceil(rank / (size + 1)))
        .otherwise(larger + F.ceil(F.try_divide(rank - in_larger, size)))
        .cast("int")
    )


def surrogate_key(df: DataFrame, name: str, order, start=0, key_source: DataFrame | None = None) -> DataFrame:
    """``df`` with a dense key ``name`` in front, counted on from ``start``; see ``global_rank``."""
    keyed = global_rank(df, order, name, start=start, key_source=key_source)
    return keyed.select(name, *quoted(df.columns))


def exact_quantiles(df: DataFrame, value: str, probabilities, keys=()) -> DataFrame:
    """Exact linear-interpolated quantiles ``q0, q1, ...`` of ``value`` per key, and ``n``.

    Without keys there is one row, of NULLs if there are no values. See ``wide_quantiles``.
    """
    found = wide_quantiles(df, [value], probabilities, keys).drop("column")
    if keys:
        return found
    return found.agg(*[F.max(c).alias(c) for c in found.columns])


def wide_quantiles(df: DataFrame, columns, probabilities, keys=(), statistics=None) -> DataFrame:
    """Exact linear-interpolated quantiles of many columns, one row per key and column.

    Built-in ``percentile`` keeps every distinct value of a group in one buffer. Here one pass
    fills a mergeable sketch per column, whose error is bounded: it gives two values with the
    wanted positions between them. The second pass counts what lies below and keeps only the
    values in between, a few in ten thousand; their counts are sorted. No row is repeated and
    no value outside a bracket leaves the scan. Should a bracket turn out to miss its position,
    its pass is done again from the smallest to the largest value.

    Result: the keys, column, ``n``, the aggregates that ``statistics`` names (SQL text with
    ``{v}`` for the value), computed in the first pass, and ``q0, q1, ...``. NULL values are
    left out, NaN is larger than any number; columns without values have no row. Without keys
    the result is a few numbers, which are fetched at once.
    """
    keys, columns, probabilities = list(keys), list(columns), [float(p) for p in probabilities]
    values = df.select(*quoted(keys), *[col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)])
    sketched = _sketched(values, len(columns), probabilities, keys, statistics or {})
    if keys:
        summary, few = materialize(sketched, "summary"), False
    else:
        row = sketched.first()
        summary = df.sparkSession.createDataFrame([row], sketched.schema)
        # So few rows that no near bracket can hold more values than are sorted.
        few = max(c["__n"] for c in row) * (2 * _NEAR + 4 / _ACCURACY) < _SORTED
    widened = False
    while True:
        brackets = _brackets(summary, len(columns), probabilities, keys, widened)
        lanes, number = _lanes(brackets, len(columns), len(probabilities), keys)
        wanted = _wanted(summary, columns, probabilities, keys, number)
        entries, missed = _entries(values, brackets, lanes, keys), 0
        if not few or widened:
            entries = materialize(entries, "entries")
            widest, missed = _widest(entries, wanted, keys)
            while not missed and widest > _SORTED:
                entries, before = materialize(_thinned(entries, wanted, keys), "entries"), widest
                widest, _ = _widest(entries, wanted, keys)
                # Values that arithmetic cannot tell apart end the search as well.
                if widest == before:
                    break
        if not missed:
            found = _interpolated(entries, wanted, len(probabilities), keys)
            if keys:
                return found.drop("__missed")
            # A row per column.
            rows = found.collect()
            present = sum(c["__n"] > 0 for c in row)
            if len(rows) == present and not any(r["__missed"] for r in rows):
                return df.sparkSession.createDataFrame(rows, found.schema).drop("__missed")
        widened = True


# The plans below have an expression for each column and probability: they are put together as
# SQL text, which takes a fraction of the time that as many calls would.


def _sketched(values, n_columns, probabilities, keys, statistics):
    """One row per key with a struct per column: count, ends, values around the quantiles, statistics."""
    around = [min(max(p + s, 0.0), 1.0) for p in probabilities for s in (-_NEAR, _NEAR, -_FAR, _FAR)]

    named = {"__n": "count({v})", "__least": "min({v})", "__most": "max({v})",
             "__around": f"percentile_approx({{v}}, array({', '.join(f'{p!r}D' for p in around)}), {_ACCURACY})", **statistics}
    fields = ", ".join(f"'{name}', {e}" for name, e in named.items())
    return values.groupBy(*quoted(keys)).agg(*[
        F.expr(f"named_struct({fields.replace('{v}', f'__v{i}')})").alias(f"__c{i}") for i in range(n_columns)
    ])


def _brackets(summary, n_columns, probabilities, keys, widened):
    """Per key the lower and upper ends, ``__lo`` and ``__hi``, of column 0 probability 0, 1, ..., column 1 ...

    Near ends where the values are many enough for the sketch's error and rounding to fit in
    between, far ones for fewer, the smallest and largest value for few.
    """
    def end(i, number, p, side):
        c, outer = f"__c{i}", f"__c{i}.__{'most' if side else 'least'}"
        if widened:
            return outer

        def at(reach, offset):
            beyond = p + reach >= 1 if side else p - reach <= 0
            return outer if beyond else f"{c}.__around[{4 * number + offset + side}]"

        return f"CASE WHEN {c}.__n >= {2 * _ACCURACY} THEN {at(_NEAR, 0)} WHEN {c}.__n >= {_FEW} THEN {at(_FAR, 2)} ELSE {outer} END"

    every = [(i, number, p) for i in range(n_columns) for number, p in enumerate(probabilities)]
    return summary.select(*quoted(keys), *[
        F.expr(f"array({', '.join(end(*one, side) for one in every)})").alias(name) for side, name in enumerate(("__lo", "__hi"))
    ])


def _lanes(brackets, n_columns, per_column, keys):
    """The brackets to count, (value, low, high, whether they may differ), and the lane of each.

    Without keys the ends are numbers, and equal brackets of a column are one lane.
    """
    if keys:
        every = [(f"__v{j // per_column}", f"__lo[{j}]", f"__hi[{j}]", True) for j in range(n_columns * per_column)]
        return every, list(range(len(every)))
    ends = brackets.first()
    lanes: dict = {}
    number = []
    for j in range(n_columns * per_column):
        low, high = (f"CAST({'NULL' if x is None else repr(str(x))} AS DOUBLE)" for x in (ends["__lo"][j], ends["__hi"][j]))
        number.append(lanes.setdefault((f"__v{j // per_column}", low, high, low != high), len(lanes)))
    return list(lanes), number


def _entries(values, brackets, lanes, keys):
    """(keys, __j, __v, __n): counts of the values in each bracket, ends included; NULL: how many are below.

    A task folds its rows into one row of counts and the few values strictly inside.
    """
    if keys:
        renamed = brackets.withColumnsRenamed({k: f"__r_{k}" for k in keys})
        match = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"`__r_{k}`")) for k in keys])
        values = values.join(renamed, match)
    inside = [
        f"named_struct('__j', {j}, '__v', CASE WHEN {v} > {lo} AND {v} < {hi} THEN {v} END, '__n', 1L)"
        for j, (v, lo, hi, wide) in enumerate(lanes) if wide
    ]
    end = (lambda x: f"any_value({x})") if keys else (lambda x: x)
    counts = [
        f"named_struct('__j', {j}, '__v', {at}, '__n', count_if({where}))"
        for j, (v, lo, hi, wide) in enumerate(lanes)
        for at, where in [("CAST(NULL AS DOUBLE)", f"{v} < {lo}"), (end(lo), f"{v} = {lo}")]
        + ([(end(hi), f"{v} = {hi} AND {hi} > {lo}")] if wide else [])
    ]
    found = F.expr(f"filter(array({', '.join(inside)}), x -> x.__v IS NOT NULL)" if inside else _NO_ENTRIES)
    task = values.withColumns({"__task": F.spark_partition_id(), "__inside": found})
    folded = task.groupBy(*quoted(keys), "__task").agg(F.expr(
        f"concat(array({', '.join(counts)}), flatten(collect_list(CASE WHEN size(__inside) > 0 THEN __inside END)))"
    ).alias("__all"))
    each = folded.select(*quoted(keys), F.expr("inline(filter(__all, x -> x.__n > 0))"))
    return each.groupBy(*quoted(keys), "__j", "__v").agg(F.sum("__n").alias("__n"))


def _wanted(summary, columns, probabilities, keys, number):
    """(keys, __j, column, __i, __p, n, statistics, __first, __last): the positions of each quantile."""
    named = [f.name for f in summary.schema["__c0"].dataType if f.name not in ("__n", "__least", "__most", "__around")]
    rows = []
    for i, c in enumerate(columns):
        text = c.replace("\\", "\\\\").replace("'", "\\'")
        stats = ", ".join(f"'{name}', __c{i}.`{name}`" for name in named) or "'__none', 0"
        rows += [
            f"named_struct('__j', {number[i * len(probabilities) + at]}, 'column', '{text}', '__i', {at}, "
            f"'__p', CAST({p!r} AS DOUBLE), 'n', __c{i}.__n, '__stats', named_struct({stats}))"
            for at, p in enumerate(probabilities)
        ]
    at = F.col("__p") * (F.col("n") - 1).cast("double")
    return summary.select(*quoted(keys), F.expr(f"inline(array({', '.join(rows)}))")).where("n > 0").select(
        "*", F.floor(at).alias("__first"), F.ceil(at).alias("__last")
    )


def _on_bracket(left, right, keys, how="inner"):
    """Join by key (NULL is one) and bracket; both sides have a few rows per key."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in [*keys, "__j"]})
    match = F.col("__j") == F.col("__r___j")
    for k in keys:
        match = match & col(k).eqNullSafe(F.col(f"`__r_{k}`"))
    return left.join(renamed, match, how).drop(*[f"__r_{c}" for c in [*keys, "__j"]])


def _widest(entries, wanted, keys):
    """The most entries of a bracket, and how many brackets miss their positions."""
    held = entries.groupBy(*quoted(keys), "__j").agg(
        F.count("__v").alias("__values"), F.sum("__n").alias("__upto"),
        F.coalesce(F.sum(F.when(F.col("__v").isNull(), F.col("__n"))), F.lit(0)).alias("__below"),
    )
    missed = F.col("__upto").isNull() | (F.col("__below") > F.col("__first")) | (F.col("__upto") <= F.col("__last"))
    found = _on_bracket(wanted, held, keys, "left").agg(F.max("__values"), F.count_if(missed)).first()
    return found[0] or 0, found[1]


def _thinned(entries, wanted, keys):
    """The entries of each bracket in those of ``_CELLS`` equal cells that hold its positions."""
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    ends = entries.groupBy(*quoted(keys), "__j").agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    # Halves, so that no difference of two doubles overflows.
    share = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
    cell = F.coalesce(F.least(F.floor(F.nanvl(share, F.lit(0.0)) * _CELLS), F.lit(_CELLS - 1)), F.lit(0))
    celled = _on_bracket(entries, ends, keys).withColumn("__cell", F.when(v.isNull(), -1).otherwise(cell))
    # At most _CELLS + 1 rows per bracket.
    upto = F.sum("__n").over(Window.partitionBy(*quoted(keys), "__j").orderBy("__cell"))
    cells = celled.groupBy(*quoted(keys), "__j", "__cell").agg(F.sum("__n").alias("__n")).withColumn("__upto", upto)
    from_ = F.col("__upto") - F.col("__n")
    kept = _on_bracket(cells, wanted, keys).where(
        (F.col("__cell") >= 0) & (F.col("__first") < F.col("__upto")) & (F.col("__last") >= from_)
    ).groupBy(*quoted(keys), "__j").agg(
        F.min("__cell").alias("__from"), F.max("__cell").alias("__to"), F.min(from_).alias("__before")
    )
    inner = _on_bracket(celled, kept, keys).where("__cell BETWEEN __from AND __to")
    below = kept.where("__before > 0").select(
        *quoted(keys), "__j", F.lit(None).cast("double").alias("__v"), F.col("__before").alias("__n"))
    return inner.select(*quoted(keys), "__j", "__v", "__n").union(below)


def _interpolated(entries, wanted, n_probabilities, keys):
    # At most _SORTED rows per bracket.
    upto = F.sum("__n").over(Window.partitionBy(*quoted(keys), "__j").orderBy(F.col("__v").asc_nulls_first()))
    placed = _on_bracket(entries.withColumn("__upto", upto), wanted, keys).where("__v IS NOT NULL")

    def value_at(position):
        return F.min(F.when(F.col(position) < F.col("__upto"), F.col("__v")))

    target = ["column", "__i", "__p", "n", "__first"]
    picked = placed.groupBy(*quoted(keys), *target).agg(
        value_at("__first").alias("__low"), value_at("__last").alias("__high"), F.any_value("__stats").alias("__stats"),
        F.min(F.col("__upto") - F.col("__n")).alias("__below"),
    )
    low, high = F.col("__low"), F.col("__high")
    weight = F.col("__p") * (F.col("n") - 1).cast("double") - F.col("__first")
    # Interpolate from the nearer end, so that an exact hit stays exact.
    from_low = low + (high - low) * weight
    from_high = high - (high - low) * (F.lit(1.0) - weight)
    found = F.when(low == high, low).when(weight >= 0.5, from_high).otherwise(from_low)
    return picked.groupBy(*quoted(keys), "column").agg(
        F.max("n").alias("n"), F.any_value("__stats").alias("__stats"),
        *[F.max(F.when(F.col("__i") == i, found)).alias(f"q{i}") for i in range(n_probabilities)],
        ((F.count(F.lit(1)) < n_probabilities) | F.max(F.col("__high").isNull() | (F.col("__below") > F.col("__first"))))
        .alias("__missed"),
    ).select(*quoted(keys), "column", "n", "__stats.*", *[f"q{i}" for i in range(n_probabilities)], "__missed").drop("__none")


def modes(df: DataFrame, columns) -> DataFrame:
    """Most frequent non-NULL value per column, the smallest one on a tie."""
    numeric = {f.name for f in df.schema if f.dataType.typeName() != "string"}
    items = [
        F.struct(
            F.lit(c).alias("column"),
            (col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number"),
            (F.lit(None).cast("string") if c in numeric else col(c)).alias("text"),
        )
        for c in columns
    ]
    counted = (
        df.select(F.inline(F.array(*items)))
        .where("number is not null or text is not null")
        .groupBy("column", "number", "text")
        .count()
    )
    best = F.min_by(F.struct("number", "text"), F.struct(-F.col("count"), "number", "text"))
    return counted.groupBy("column").agg(best.alias("m")).select("column", "m.*")


def hash_sample(df: DataFrame, key: str, n: int, seed=42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same for any partitioning.

    The order is that of an MD5 over seed and key, which every SQL engine can repeat.
    """
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), col(key).cast("string")).cast("binary"))
    return df.orderBy(ticket, col(key)).limit(n)
