"""Connected components of a graph given as pairs, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnmart.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reached.

    Each round replaces the links of a node by links to the smallest node it sees; paths
    shrink geometrically, and a node never gathers its neighbours in one place: minima are
    partial aggregates, and links meet them in joins that AQE can split. Every round is a
    written table. NULL nodes and loops are left out. No pairs give no rows.
    """
    edges = materialize(_oriented(edges.select("a", "b")), "links")
    seen = _fingerprint(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = _fingerprint(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        seen = now


def _oriented(edges):
    """Each link once, from the larger to the smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _fingerprint(edges):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _large_star(edges):
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _oriented(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.union(least.select("a", F.col("m").alias("b"))))
