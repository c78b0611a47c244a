"""Customer changes as a file stream, merged into the dimension batch by batch."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from churnmart.functions.exprs import col
from churnmart.operators import scd2
from churnmart.operators.cleanse import last_per_key
from churnmart.schemas import clean_numbers
from churnmart.session import materialize
from churnmart.sources.history import SEEN, DimensionVersions

def merge_stream(spark: SparkSession, feed_dir: str, schema, versions: DimensionVersions,
                 load_date: date, order: str, checkpoint: str,
                 files_per_batch: int | None = None, prepare=None) -> int:
    """Merge all files waiting in ``feed_dir``; returns the version reached.

    ``prepare`` turns a raw batch into feed rows in warehouse names. The query stops when
    nothing is left (``availableNow``); started again on the same ``checkpoint`` it goes on
    with new files only, on another one it merges all files again, which changes nothing.
    Batches go on from the latest finished version. ``order`` counts over all batches: a row
    that arrives late, with a smaller order than the customer's current row reflects, is
    ignored. Rows without a key are set aside, see ``DimensionVersions.rejected``. A batch
    reads the buckets of its customers and writes the rows of its customers, no others.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    source = reader.parquet(feed_dir)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if versions.made_by(checkpoint, batch_id) is not None:
            return
        base = versions.latest()
        rows = clean_numbers(batch)
        rows = prepare(rows) if prepare else rows
        keyed = col(scd2.KEY).isNotNull()
        # At most as many rows as there are buckets, and one for keyless rows.
        held = rows.select(keyed, versions.bucket_of()).distinct().collect()
        if not all(r[0] for r in held):
            versions.reject(base + 1, rows.where(~keyed))
        newest = last_per_key(rows.where(keyed), scd2.KEY, order)
        before = versions.with_order(base, {r[1] for r in held if r[0]})
        met = scd2.beside(before, newest)
        # Stored as text, compared in the type of the feed.
        seen = col(f"__old_{SEEN}").cast(newest.schema[order].dataType)
        fresh = met.where(seen.isNull() | (col(order) >= seen)).withColumn(SEEN, col(order).cast("string")).drop(order)
        changed = F.max((F.col("status") != "unchanged").cast("int")).over(Window.partitionBy(scd2.KEY))
        # Written, so that the batch is parsed and meets the dimension once.
        fresh = materialize(fresh.withColumn("__changed", changed), "stream-batch")
        delta = fresh.where("status <> 'unchanged'").drop("__changed")
        opened = scd2.opened(delta, load_date, versions.last_key(base))
        closed = scd2.ended(delta, load_date).withColumn(SEEN, F.lit(None).cast("string"))
        # Unchanged rows reflect a later order from now on.
        same = fresh.where("__changed = 0")
        again = scd2.old_versions(same.withColumn(f"__old_{SEEN}", F.col(SEEN)))
        versions.change(closed.unionByName(opened, allowMissingColumns=True).unionByName(again, allowMissingColumns=True),
                        checkpoint, batch_id)

    query = (
        source.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return versions.latest()
