"""File and table sinks. Every task writes its own part; nothing passes the driver."""

import uuid

from pyspark.sql import DataFrame, functions as F

from churnmart.sources.readers import PUBLISHED, published_versions


def overwrite_files(df: DataFrame, path: str, fmt="parquet", partition_by=()) -> None:
    """Replace the files at ``path``; CSV gets a header and an empty cell for NULL.

    Never point this at a path that ``df`` itself reads: write to a new path instead.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("nullValue", "")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def publish_files(df: DataFrame, path: str, fmt="parquet", partition_by=(), keep=2) -> str:
    """Replace the table at ``path`` in one step; returns the folder of the new files.

    The rows are written aside, then one small file names their folder: before that, readers
    (``readers.published``) see the old table whole, after it the new one, and a job that
    fails in between changes nothing for them. ``df`` may read the table it replaces. The last
    ``keep`` published folders stay for readers that are under way, older ones are removed.
    """
    spark = df.sparkSession
    before = published_versions(spark, path)
    number = before[-1][0] + 1 if before else 0
    folder = f"data-{number:08d}-{uuid.uuid4().hex}"
    overwrite_files(df, f"{path}/{folder}", fmt, partition_by)
    note = spark.createDataFrame([(number, folder)], PUBLISHED)
    note.coalesce(1).write.mode("append").parquet(f"{path}/published")
    old = [name for _, name in before][: max(0, len(before) + 1 - keep)]
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    # Those before them went with earlier calls.
    for name in old[-1:]:
        gone = hadoop.Path(f"{path}/{name}")
        gone.getFileSystem(conf).delete(gone, True)
    return f"{path}/{folder}"


def append_files(df: DataFrame, path: str, fmt="parquet") -> None:
    """Add the rows of ``df`` to what is at ``path`` (created when missing)."""
    df.write.mode("append").format(fmt).save(path)


def append_table(df: DataFrame, table: str) -> None:
    """Add the rows of ``df`` by column position to a catalog table (created when missing)."""
    df.write.mode("append").saveAsTable(table)
