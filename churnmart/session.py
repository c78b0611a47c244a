"""Session defaults and the shared folder for tables that cut lineage."""

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Paths written inside the innermost ``temporary_tables`` block.
_written: ContextVar[list | None] = ContextVar("written", default=None)


def build_session(app_name="churnmart", master=None, shuffle_partitions=None, **conf):
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` and ``shuffle_partitions`` to ``spark-submit``: AQE
    merges small shuffle partitions and splits skewed ones from whatever is set there.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites of every column expression cost more than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session that names none uses its warehouse folder: on a cluster a machine-local
    folder would lose its files together with the executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def folder_state(spark: SparkSession, folder: str) -> int:
    """A number that changes when a table in ``folder`` is written anew."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return hash(tuple((str(f.getPath()), f.getModificationTime(), f.getLen()) for f in found or ()))


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written yet, below the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/churnmart/{app}/{label}-{uuid.uuid4().hex}"
    if (owned := _written.get()) is not None:
        owned.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession):
    """Deletes, at its end, the tables that operators wrote inside the block.

    Results are lazy: write or collect them inside the block. Without it the tables stay
    until the shared folder's retention rule removes them.
    """
    paths: list = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        # No DataFrame call deletes files; the folder may be in any Hadoop file system.
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(hadoop.Path, paths):
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str, partition_by=()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage with a durable columnar table: later passes prune columns, know the
    real size (so joins are planned from it) and survive the loss of executors.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # A partition column moves to the end on read; restore the order of ``df``.
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
