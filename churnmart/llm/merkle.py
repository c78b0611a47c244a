"""Merkle manifest of a dataset: a tree per source, a tree over the sources, proofs per row.

A digest H is the lowercase hex SHA-256 of its inputs' text. Each tree is built level by level
with one self-join: a node computes the places of its siblings (the XOR of its place with one in
binary trees, else its slot moved on by every offset within its run of ``fanout`` nodes) and an
equijoin fetches their digests. The row in slot zero of each run then emits the parent.

All trees take a level in the same step. Places come from a range sort by (source, id), so that
a source with a third of all rows spreads over many tasks like any other; a join key has at
most ``fanout`` rows on either side. The siblings of a level are written once; a proof is put
together from the root down, so that what a run shares is joined to its members, not repeated
in the tables. Digests travel as 32 bytes and become text where they are hashed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnmart.operators.ordering import global_rank
from churnmart.session import materialize

FANOUT = 16
_PATH = "array<struct<before:binary,after:binary>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values) -> Column:
    """H of the fields of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _text(digests: Column) -> Column:
    """Bytes of one or more digests as the text that is hashed."""
    return F.lower(F.hex(digests))


def _h(digests: Column) -> Column:
    return F.unhex(F.sha2(_text(digests), 256))


def _joined(run: Column, keep) -> Column:
    """Digests of the nodes of a run that ``keep`` takes, one after the other."""
    return F.aggregate(
        F.filter(run, lambda node: keep(node["at"])), F.lit(b""), lambda all_, node: F.concat(all_, node["digest"])
    )


def _siblings(fanout: int) -> Column:
    """Places of a node and its siblings; those beyond the last node of the tree fall out later."""
    idx = F.col("idx")
    if fanout == 2:
        return F.array(idx, idx.bitwiseXOR(F.lit(1).cast("long")))
    first = idx - idx % fanout
    return F.array(idx, *[first + (idx + offset) % fanout for offset in range(1, fanout)])


def shift_join(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with the digests of their siblings: ``before`` and ``after`` their own.

    ``nodes`` holds tree, idx (0 to size - 1 in each tree), size, digest and payload, and only
    trees of two nodes or more.
    """
    wanted = nodes.select("tree", "idx", "size", F.explode(_siblings(fanout)).alias("at")).where("at < size")
    theirs = nodes.select("tree", F.col("idx").alias("at"), "digest", "payload")
    met = wanted.join(theirs, ["tree", "at"])
    # A run of at most ``fanout`` nodes; the node itself brings its payload.
    run = F.array_sort(F.collect_list(F.struct("at", "digest")))
    own = F.max(F.when(F.col("at") == F.col("idx"), F.struct("digest", "payload")))
    found = met.groupBy("tree", "idx", "size").agg(run.alias("run"), own.alias("own"))
    return found.select(
        "tree", "idx", "size", "own.digest", "own.payload",
        _joined(F.col("run"), lambda at: at < F.col("idx")).alias("before"),
        _joined(F.col("run"), lambda at: at > F.col("idx")).alias("after"),
    )


def climb(nodes: DataFrame, fanout: int) -> list:
    """[(nodes with siblings or None, finished nodes)] per level, leaves first.

    A tree is finished at the level where it has one node, its root. ``nodes`` is a written
    table; so are the siblings of each level.
    """
    levels, largest = [], nodes.agg(F.max("size")).first()[0] or 0
    while largest > 0:
        done = nodes.where("size = 1")
        if largest == 1:
            levels.append((None, done))
            break
        runs = materialize(shift_join(nodes.where("size > 1"), fanout), "siblings")
        levels.append((runs, done))
        nodes = runs.where(F.col("idx") % fanout == 0).select(
            "tree",
            F.floor(F.col("idx") / fanout).alias("idx"),
            F.ceil(F.col("size") / fanout).alias("size"),
            _h(F.concat("before", "digest", "after")).alias("digest"),
            F.lit(None).cast(runs.schema["payload"].dataType).alias("payload"),
        )
        largest = -(-largest // fanout)
    return levels


def roots(levels) -> DataFrame:
    """(tree, digest) of the root of every tree."""
    found = levels[0][1].select("tree", "digest")
    for _, done in levels[1:]:
        found = found.union(done.select("tree", "digest"))
    return found


def descend(levels, fanout: int, above: DataFrame | None = None) -> DataFrame:
    """The leaves (digest, payload) with the columns of ``above`` for their tree.

    ``above`` holds tree and path, an array of (before, after); each level going down puts its
    own siblings in front. Without it paths end at the roots of the trees.
    """
    carried = [c for c in above.columns if c not in ("tree", "path")] if above is not None else []
    below = None
    for runs, done in reversed(levels):
        ends = done.join(above, "tree") if above is not None else done.withColumn("path", F.array().cast(_PATH))
        here = ends.select("tree", "idx", "digest", "payload", *carried, "path")
        if runs is not None:
            parents = below.select("tree", F.col("idx").alias("parent"), *carried, F.col("path").alias("rest"))
            joined = runs.withColumn("parent", F.floor(F.col("idx") / fanout)).join(parents, ["tree", "parent"])
            path = F.concat(F.array(F.struct("before", "after")), F.col("rest")).alias("path")
            here = here.union(joined.select("tree", "idx", "digest", "payload", *carried, path))
        below = here
    return below


def prove(docs: DataFrame, fields=FIELDS, seen=None, id_col="doc_id", source_col="source", fanout=FANOUT) -> DataFrame:
    """Leaf, roots, proof and the outcome of checking it for every row of ``docs``.

    Each row of ``docs`` is a leaf, of the columns ``fields``. Per source the leaves ascend by
    id, NULL first, rows of one id by their digest. ``seen`` replaces columns by expressions
    for what a checker finds in place of the row; NULL, empty and very long values are digested
    whole. Repeated rows are leaves of their own and get proofs by some order among them. NULL
    is a source of its own, the first. An empty table gives no rows. Columns not in ``fields``
    are not read, so their names cannot clash.

    Returns ``id_col``, leaf, subroot (of the source), root (of all), proof_sha256 (H of the
    siblings from the leaf up, left to right), folded_root (from what was seen and the proof)
    and verified.
    """
    changed = [(seen or {}).get(c, F.col(f"`{c}`")) for c in fields]
    leaf = leaf_of(F.col(f"`{c}`") for c in fields)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        leaf.alias("digest"),
        (leaf_of(changed) if seen else F.lit(None).cast("binary")).alias("seen"),
    )
    placed = global_rank(rows, ["id", "digest"], "place", within=["source"], total="size")
    tree = F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("-"))
    leaves = materialize(placed.select(
        tree.alias("tree"), (F.col("place") - 1).alias("idx"), "size", "digest", F.struct("id", "seen").alias("payload")
    ), "leaves")
    levels = climb(leaves, fanout)
    if not levels:
        nothing = F.lit(None).cast("string")
        return docs.limit(0).select(
            F.col(f"`{id_col}`"), *[nothing.alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
            F.lit(None).cast("boolean").alias("verified"),
        )
    source = F.when(F.col("tree") != "-", F.col("tree"))
    ranked = global_rank(roots(levels).withColumn("source", source), ["source"], "place", total="size")
    sources = materialize(ranked.select(
        F.lit("").alias("tree"), (F.col("place") - 1).alias("idx"), "size", "digest", F.struct("tree").alias("payload")
    ), "sources")
    top = climb(sources, fanout)
    root = roots(top).first()["digest"]
    ends = descend(top, fanout)
    above = ends.select(F.col("payload.tree").alias("tree"), F.col("digest").alias("subroot"), "path")
    found = descend(levels, fanout, above).select(
        F.col("payload.id").alias("id"), "digest", "subroot", "path",
        F.coalesce("payload.seen", "digest").alias("seen"),
    )
    siblings = F.aggregate("path", F.lit(b""), lambda all_, step: F.concat(all_, step["before"], step["after"]))
    folded = F.aggregate("path", F.col("seen"), lambda node, step: _h(F.concat(step["before"], node, step["after"])))
    checked = found.select("*", siblings.alias("proof"), folded.alias("folded"))
    return checked.select(
        F.col("id").alias(id_col),
        _text(F.col("digest")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        F.lit(bytes(root).hex()).alias("root"),
        F.sha2(_text(F.col("proof")), 256).alias("proof_sha256"),
        _text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.lit(bytes(root))).alias("verified"),
    )


def lower_ascii(text: Column) -> Column:
    """``text`` with only A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def drill(docs: DataFrame) -> DataFrame:
    """``prove`` where the checker finds every fifth text (by the id's crc32) with A-Z lower-cased."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    seen = F.when(picked, lower_ascii(F.col("text").cast("string"))).otherwise(F.col("text").cast("string"))
    return prove(docs, seen={"text": seen})
