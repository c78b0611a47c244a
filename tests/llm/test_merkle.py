"""Merkle manifests against a plain version over lists."""

import hashlib
import zlib

import pytest

from churnmart.llm import merkle
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def slow_tree(nodes, fanout):
    """Root, and for each leaf its siblings level by level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = i - i % fanout
            paths[leaf].append((nodes[run:i], nodes[i + 1 : run + fanout]))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def slow_drill(rows, fanout=16):
    def leaf(r, text):
        return h(*map(told, (r.doc_id, r.source, r.lang, r.n_chars, text)))

    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees[s] = slow_tree([leaf(r, r.text) for r in by_source[s]], fanout)
    root, tops = slow_tree([trees[s][0] for s in order], fanout)
    out = []
    for s, top in zip(order, tops):
        for r, path in zip(by_source[s], trees[s][1]):
            seen = r.text
            if seen is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                seen = "".join(c.lower() if "A" <= c <= "Z" else c for c in seen)
            node, siblings = leaf(r, seen), []
            for before, after in path + top:
                siblings += before + after
                node = h(*before, node, *after)
            out.append((r.doc_id, leaf(r, r.text), trees[s][0], root, h(*siblings), node, node == root))
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_whole_table_matches_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = merkle.drill(docs)
    assert found.columns == COLUMNS
    want = slow_drill(docs.collect())
    assert got(found) == sorted(want, key=str)
    assert 0 < sum(not w[-1] for w in want) < len(want) / 4


@pytest.mark.parametrize("sizes", [[1], [2], [16, 1], [17], [33, 16, 1], [257, 3], [1] * 18 + [40]])
def test_runs_of_all_lengths(spark, sizes):
    rows = [(100 * s + i * 7 % n, f"Text {i}", "en", f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert got(merkle.drill(docs)) == sorted(slow_drill(docs.collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_other_fanouts(spark, fanout):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = [w[:5] + (w[3], True) for w in slow_drill(docs.collect(), fanout)]
    assert got(merkle.prove(docs, fanout=fanout)) == sorted(want, key=str)


def test_any_changed_field_is_noticed(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wrong = F.when(F.col("doc_id") == 7, F.lit(None)).otherwise(F.col("lang"))
    failed = merkle.prove(docs, seen={"lang": wrong}).where("not verified").collect()
    assert [r.doc_id for r in failed] == [7]


def test_odd_rows(spark):
    rows = [(None, "A", "en", "s", 1), (None, None, None, None, None), (3, "", "", "", 0), (3, "", "", "", 0), (3, "x", "", "", 0),
            (0, "ABC É" * 60_000, "en", "s", 5), (5, "-", "-", "-", 1), (6, "1:-", "é", "-", 1), (7, "Z", "en", "~", 1), (8, "Z", "en", "é", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    more = docs.withColumn("digest", F.lit(1)).withColumn("tree", F.lit("x")).withColumn("path", F.lit("y"))
    assert got(merkle.drill(more)) == sorted(slow_drill(docs.collect()), key=str)
    empty = merkle.drill(docs.limit(0))
    assert empty.count() == 0 and empty.columns == COLUMNS


def test_a_join_key_has_few_rows(spark):
    """Both sides of the level join are keyed by tree and place, whatever the size of a tree."""
    nodes = spark.range(5000).selectExpr("'t' tree", "id idx", "5000L size", "unhex(sha2(cast(id as string), 256)) digest", "1 payload")
    text = merkle.shift_join(nodes, 16)._jdf.queryExecution().toString()
    assert "Window" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
