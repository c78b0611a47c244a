"""Exact top-k search by inner product, selected with score histograms.

Queries are taken in groups of bounded size, which are sent to all tasks; each task reads its
own rows and scores every one against the group, as matrix products. No vector is shuffled.
A pass counts, over all rows, how many scores of each query fall into each bin of a range
known to hold its kth score, and narrows the range to the bin that holds it. Scores are
integers, so the range ends as a single value. The last pass keeps what is above that value
and, of what equals it, the smallest ids. A task reports its highest bins down to its own kth
score: its lower bins cannot hold the kth score of all tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnmart.session import materialize, new_path

SCALE = 256
# Queries of a group, rows of a matrix product, bins of a query: bound what a task holds.
QUERY_GROUP, ROW_BLOCK, BINS = 2048, 1024, 4096
LONG = 2**63 - 1


def _products(queries, rows, most):
    """Integer inner products; as floats while ``most`` says they are exact, else as integers."""
    if most < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in v] for v in m], object).reshape(m.shape)
    return np.clip(whole(queries) @ whole(rows).T, -LONG, LONG).astype(np.int64)


def _scored(batches, group, most):
    """(numbers of queries, their scores, row ids, whether a row is another) of each block."""
    keys, vectors = group
    dims = np.array([len(v) for v in vectors])
    by_dim = {}
    for dim in set(dims.tolist()):
        numbers = np.nonzero(dims == dim)[0]
        by_dim[dim] = numbers, np.array([vectors[n] for n in numbers], float).reshape(len(numbers), dim)
    for batch in batches:
        row_keys, ids, lists = batch.columns
        row_keys, ids = row_keys.to_numpy(zero_copy_only=False), ids.to_numpy(zero_copy_only=False)
        lengths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        for dim in set(lengths.tolist()) & set(by_dim):
            numbers, queries = by_dim[dim]
            here = np.nonzero(lengths == dim)[0]
            for at in range(0, len(here), ROW_BLOCK):
                some = here[at : at + ROW_BLOCK]
                rows = flat[(ends[some] - dim)[:, None] + np.arange(dim)]
                yield numbers, _products(queries, rows, most), ids[some], keys[numbers][:, None] != row_keys[some][None, :]


def _widths(low, high):
    return np.maximum(1, np.array([-(-(int(h) - int(lo) + 1) // BINS) for lo, h in zip(low, high)], np.int64))


def _histograms(shared, most):
    def run(batches):
        keys, vectors, low, high, wanted = shared.value
        counts, width = np.zeros((len(keys), BINS), np.int64), _widths(low, high)
        for numbers, scores, _, other in _scored(batches, (keys, vectors), most):
            lo = low[numbers][:, None]
            inside = other & (scores >= lo) & (scores <= high[numbers][:, None])
            # The distance may pass a long only where ``inside`` is false.
            bins = np.where(inside, (scores - lo).view(np.uint64) // width[numbers][:, None].astype(np.uint64), 0).astype(np.int64)
            slots = (np.arange(len(numbers))[:, None] * BINS + bins)[inside]
            counts[numbers] += np.bincount(slots, minlength=len(numbers) * BINS).reshape(-1, BINS)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, found = np.nonzero((counts > 0) & (above < wanted[:, None]))
        columns = (query, found, counts[query, found])
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["query", "bin", "n"])

    return run


def _winners(shared, most, k):
    def run(batches):
        keys, vectors, low, _, _ = shared.value
        best = [np.zeros(0, np.int64) for _ in range(3)]
        for numbers, scores, ids, other in _scored(batches, (keys, vectors), most):
            i, j = np.nonzero(other & (scores >= low[numbers][:, None]))
            best = [np.concatenate(x) for x in zip(best, (numbers[i], scores[i, j], ids[j]))]
            # At most k in all are above the kth score, and no more than k of its equals win.
            order = np.lexsort((best[2], -best[1], best[0]))
            best = [x[order] for x in best]
            starts = np.searchsorted(best[0], best[0])
            best = [x[np.arange(len(starts)) - starts < k] for x in best]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["query", "score", "vec_id"])

    return run


def search(df: DataFrame, is_query, k=5, id_col="vec_id", vector_col="embedding", scale=SCALE) -> DataFrame:
    """The ``k`` rows with the highest scores for each query: query_id, rank, vec_id, score.

    Components x become floor(scale * x); the score is the integer inner product. ``is_query``
    is a condition on ``df``. A query's own row is no candidate, equal scores go to the
    smaller id, and with fewer candidates than ``k`` all are given.

    Vectors that are NULL or hold NULL or non-finite components, and rows with a NULL id, take
    no part. Vectors of different lengths have no score with each other; empty ones score 0.
    Repeated rows are queries and candidates of their own. Scores beyond a long become its
    ends. An empty table gives no rows. Other columns are not read, except by ``is_query``.
    """
    spark = df.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    # `floor` of a double is a long; larger values have no fraction left.
    whole = lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale)
    vectors = materialize(
        usable.select(
            F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"),
            F.transform(vector, whole).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )
    size = vectors.agg(
        F.count_if("asks").alias("n"), F.max(F.size("v")).alias("dim"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("top"),
    ).first()
    most = min(LONG, int((size["top"] or 0) ** 2) * (size["dim"] or 0))
    groups = max(1, -(-size["n"] // QUERY_GROUP))
    asked = materialize(
        vectors.where("asks").select("key", "id", "v", F.pmod(F.xxhash64("key"), groups).alias("part")), "queries", ("part",)
    )
    rows, results = vectors.select("key", "id", "v"), new_path(spark, "top")
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(results)
    for part in range(groups):
        # About ``QUERY_GROUP`` vectors.
        chosen = asked.where(F.col("part") == part).select("key", "id", "v").collect()
        if chosen:
            _search_group(spark, rows, chosen, k, most).write.mode("append").parquet(results)
    return spark.read.schema(schema).parquet(results)


def _search_group(spark, rows, chosen, k, most):
    keys = np.array([q["key"] for q in chosen], np.int64)
    vectors = [np.array(q["v"], float) for q in chosen]
    low, high = np.full(len(keys), -most, np.int64), np.full(len(keys), most, np.int64)
    wanted = np.full(len(keys), k, np.int64)
    share = spark.sparkContext.broadcast
    while (low < high).any():
        shared = share((keys, vectors, low, high, wanted))
        counts = rows.mapInArrow(_histograms(shared, most), "query long, bin long, n long")
        summed = counts.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        need = spark.createDataFrame([(i, int(w)) for i, w in enumerate(wanted)], "query long, wanted long")
        down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        reached = (
            summed.withColumn("upto", F.sum("n").over(down)).join(F.broadcast(need), "query").where("upto >= wanted")
            .groupBy("query").agg(F.max_by(F.struct("bin", "n", "upto"), "bin").alias("b")).select("query", "b.*")
        )
        # One row per query of the group; a query without one has fewer candidates than k.
        found = {r["query"]: r for r in reached.collect()}
        width = _widths(low, high)
        for i in range(len(keys)):
            if i not in found:
                low[i] = high[i] = -LONG
                continue
            start = int(low[i]) + found[i]["bin"] * int(width[i])
            wanted[i] -= found[i]["upto"] - found[i]["n"]
            low[i], high[i] = start, min(int(high[i]), start + int(width[i]) - 1)
    best = rows.mapInArrow(_winners(share((keys, vectors, low, high, wanted)), most, k), "query long, score long, vec_id long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    names = spark.createDataFrame([(i, q["id"]) for i, q in enumerate(chosen)], "query long, query_id long")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score")
