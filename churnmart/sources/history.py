"""A dimension stored as versions of small deltas, merged when read."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from churnmart.functions.exprs import col

KEY, SURROGATE = "customer_id", "customer_sk"
# Order of the last feed row that a current row reflects; kept with the data, not shown.
SEEN = "feed_order_seen"
_LOG = "version INT, stream STRING, batch LONG, last_key LONG"
_MANIFEST = "bucket INT, part STRING, version INT, rows LONG"
# Parts of a version: whole buckets, rows that replace those of their customers, closed rows.
_BASE, _DELTA, _CLOSED = "base", "delta", "closed"


class DimensionVersions:
    """A dimension as a series of versions; a finished version is never overwritten.

    Rows lie in buckets by customer. A change writes only its own rows: the new state of the
    customers it touches, in their buckets, and the versions it closes. Closed rows are never
    written again. A bucket is written whole again only when the deltas on it have grown to
    ``compact_at`` of its rows or to ``most_deltas``, so what is written in the long run is in
    proportion to the changes. The manifest of a version names all its parts, so a reader
    lists no other version's files, and a version may start from any earlier one.

    A version is finished once it is in the log, with the stream and micro-batch that made it
    and the largest key given so far. A batch replayed after a failure is recognised; what an
    unfinished attempt left is written anew, and readers never see it. Choose ``buckets`` so
    that a bucket is a few files.
    """

    def __init__(self, spark: SparkSession, root: str, buckets=16, compact_at=0.5, most_deltas=8):
        self.spark, self.root = spark, root
        self.buckets, self.compact_at, self.most_deltas = buckets, compact_at, most_deltas

    def path(self, version: int) -> str:
        return f"{self.root}/data/version={version}"

    def bucket_of(self, key=KEY):
        return F.pmod(F.xxhash64(col(key)), F.lit(self.buckets)).cast("int")

    # --- writing -----------------------------------------------------------------------

    def write(self, version: int, rows: DataFrame, stream: str | None = None, batch: int | None = None) -> None:
        """``rows`` (current and closed) as a version that needs no earlier one."""
        self._refuse(version)
        parts = self._put(version, _BASE, self._bucketed(rows).repartitionByRange("bucket", KEY))
        self._finish(version, parts, stream, batch, max((p["last_key"] or 0 for p in parts), default=0))

    def change(self, delta: DataFrame, stream: str | None = None, batch: int | None = None,
               base: int | None = None) -> int:
        """A new version: ``base`` (the latest) with the current and closed rows of ``delta``.

        A current row of ``delta`` takes the place of its customer's row. Returns the version.
        """
        version = self.latest() + 1
        base = version - 1 if base is None else base
        # One task holds a bucket's part of the delta: as many rows as the batch has there.
        rows = self._bucketed(delta).repartition("bucket")
        put = self._put(version, _DELTA, rows)
        added = [p for p in put if p["part"] == _DELTA]
        given = max((p["last_key"] or 0 for p in added), default=0)
        parts = self._compacted(version, self._manifest(base) + put, {p["bucket"] for p in added})
        self._finish(version, parts, stream, batch, max(given, self.last_key(base)))
        return version

    def _refuse(self, version):
        if version <= self.latest():
            raise ValueError(f"version {version} is finished")

    def _bucketed(self, rows):
        if SEEN not in rows.columns:
            rows = rows.withColumn(SEEN, F.lit(None).cast("string"))
        return rows.withColumn("bucket", self.bucket_of())

    def _put(self, version, part, rows) -> list:
        """Writes current rows as ``part`` and closed ones in one pass; returns the manifest entries.

        There is one per part and bucket that has rows. Replaces only what an unfinished attempt
        at this version may have left.
        """
        kind = F.when(F.col("is_current") == 1, part).when(F.col("is_current") == 0, _CLOSED)
        known = rows.withColumn("part", kind).where("part IS NOT NULL")
        known.write.mode("overwrite").partitionBy("part", "bucket").parquet(self.path(version))
        return self._entries(version, self._at(version))

    def _put_whole(self, version, rows) -> list:
        """Writes buckets whole, beside what the version has already."""
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path(version)}/part={_BASE}")
        return self._entries(version, self._at(version).where(F.col("part") == _BASE))

    def _entries(self, version, rows) -> list:
        counted = rows.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.max(SURROGATE).alias("last_key"))
        return [{**r.asDict(), "version": version} for r in counted.collect()]

    def _at(self, version):
        schema = self._schema()
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(self.path(version))

    def _schema(self):
        """Columns of the stored rows, from the first version's files."""
        if not hasattr(self, "_stored"):
            first = self.spark.read.option("basePath", f"{self.root}/data").parquet(f"{self.path(0)}/part={_BASE}")
            self._stored = first.schema
        return self._stored

    def _compacted(self, version, parts, touched) -> list:
        """``parts`` with those buckets written whole whose deltas have become many."""
        full = []
        for bucket in touched:
            own = [p for p in parts if p["bucket"] == bucket]
            deltas = [p for p in own if p["part"] == _DELTA]
            rows = sum(p["rows"] for p in own if p["part"] == _BASE)
            if len(deltas) > self.most_deltas or sum(p["rows"] for p in deltas) > self.compact_at * max(rows, 1):
                full.append(bucket)
        if not full:
            return parts
        rows = self._merged([p for p in parts if p["bucket"] in full])
        based = self._put_whole(version, rows.drop("version", "part").repartition("bucket"))
        return [p for p in parts if p["bucket"] not in full or p["part"] == _CLOSED] + based

    def _finish(self, version, parts, stream, batch, last_key):
        entries = self.spark.createDataFrame([(p["bucket"], p["part"], p["version"], p["rows"]) for p in parts], _MANIFEST)
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")
        done = self.spark.createDataFrame([(version, stream, batch, last_key)], _LOG)
        done.coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def reject(self, version: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/rejected/version={version}")

    # --- reading -----------------------------------------------------------------------

    def rejected(self) -> DataFrame:
        """Feed rows without a key, by the version whose batch brought them."""
        return self.spark.read.option("basePath", f"{self.root}/rejected").parquet(f"{self.root}/rejected")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def latest(self) -> int:
        """The highest finished version, -1 before the first."""
        try:
            return self._log().agg(F.max("version")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1

    def made_by(self, stream: str, batch: int) -> int | None:
        """The finished version of a micro-batch."""
        found = self._log().where((F.col("stream") == stream) & (F.col("batch") == batch))
        return found.agg(F.max("version")).first()[0]

    def last_key(self, version: int) -> int:
        """The largest surrogate key given up to ``version``."""
        return self._log().where(F.col("version") <= version).agg(F.max("last_key")).first()[0] or 0

    def _manifest(self, version) -> list:
        entries = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/version={version}")
        return [r.asDict() for r in entries.collect()]

    def _files(self, parts) -> DataFrame:
        """Rows of the named parts and no others."""
        paths = sorted(f"{self.path(p['version'])}/part={p['part']}/bucket={p['bucket']}" for p in parts)
        reader = self.spark.read.schema(self._schema()).option("basePath", f"{self.root}/data")
        if not paths:
            return self.spark.createDataFrame([], self._schema())
        return reader.parquet(*paths)

    def _merged(self, parts) -> DataFrame:
        """Current rows: of each customer the newest delta's, else the base's."""
        alone = {p["bucket"] for p in parts} - {p["bucket"] for p in parts if p["part"] == _DELTA}
        base = self._files([p for p in parts if p["part"] == _BASE and p["bucket"] in alone])
        mixed = [p for p in parts if p["part"] != _CLOSED and p["bucket"] not in alone]
        if not mixed:
            return base
        # The deltas of a bucket are later versions than its base, so all meet in one shuffle.
        newest = F.max("version").over(Window.partitionBy(KEY))
        keyless = col(KEY).isNull()
        rows = self._files(mixed).withColumn("__newest", newest).where(
            F.when(keyless, F.col("part") == _BASE).otherwise(F.col("version") == F.col("__newest")))
        return base.unionByName(rows.drop("__newest"))

    def with_order(self, version: int, buckets=None) -> DataFrame:
        """Current rows with the feed order they reflect; only those of ``buckets``, if given."""
        parts = [p for p in self._manifest(version) if buckets is None or p["bucket"] in buckets]
        return self._merged(parts).drop("version", "part", "bucket")

    def current(self, version: int) -> DataFrame:
        return self.with_order(version).drop(SEEN)

    def closed(self, version: int) -> DataFrame:
        parts = [p for p in self._manifest(version) if p["part"] == _CLOSED]
        return self._files(parts).drop("version", "part", "bucket", SEEN)

    def read(self, version: int) -> DataFrame:
        """Current and closed rows as of ``version``."""
        return self.current(version).unionByName(self.closed(version))
