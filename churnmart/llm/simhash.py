"""Near-duplicates by SimHash, found around the anchors of a covering code.

Two fingerprints of 64 bits link at ``DISTANCE`` or fewer differing bits. The bits are cut
into three parts; the differences of a linked pair in its two closest parts are at most two
thirds of the distance. For each pair of parts the anchors are the pairs of codewords of the
perfect binary Golay code [23, 12], whose covering radius is 3 for each part. A point halfway
between two linked fingerprints lies within that radius of some anchor, so both fingerprints
are copied to every anchor within covering radius plus half the threshold, and meet there.
That is about 33 copies for each *distinct* fingerprint and 3 * 2^24 anchors.

An anchor with more than ``MOST`` fingerprints is not compared in one task: its fingerprints
are cut into blocks instead. Of n blocks at most ``DISTANCE`` hold a difference, so a linked
pair agrees in some n - ``DISTANCE`` blocks, and meets under the bits of that choice. First
eight blocks are taken (70 choices of 32 bits), and for what is crowded still, sixteen (1820
choices of 48 bits): the 16 bits left over allow 2^16 = ``MOST`` fingerprints, so nothing can
be crowded after that, and no link is lost.
"""

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnmart.llm.common import text_or_empty
from churnmart.llm.components import connected_components
from churnmart.session import materialize

DISTANCE = 4
SHINGLE = 4
SEED = 42
# Bits of the three parts; each is read as a word of 23 bits.
PARTS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
RADIUS = 3
# Generator polynomial of the Golay code, as bits.
GOLAY = 0b101011100011
# Most fingerprints that are compared in one place, and the blocks that crowded ones are cut
# into: the last leave at most ``MOST`` fingerprints to a choice.
MOST = 1 << 16
BLOCKS = (8, 16)


def golay_words() -> np.ndarray:
    words = np.zeros(4096, np.uint32)
    for bit in range(12):
        words[(np.arange(4096) >> bit & 1).astype(bool)] ^= np.uint32(GOLAY << bit)
    return words


def fingerprint_of(text: str, shingle=SHINGLE) -> int:
    """The unsigned SimHash of one text; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[-n:]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        spans = zip(starts[at : min(at + 65536, n)].tolist(), ends[at : at + 65536].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], ">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprint(text_col="text"):
    """Column expression: the fingerprint of a text as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t) for t in texts], np.uint64).view(np.int64))

    return of(text_or_empty(text_col))


def _near_words(part, words, most):
    """(row, codeword number, distance) of all codewords within ``most`` (per row) of ``part``."""
    distance = np.bitwise_count(part[:, None] ^ words[None, :])
    row, word = np.nonzero(distance <= most[:, None])
    return row, word, distance[row, word].astype(np.int64)


def anchors_of(prints: np.ndarray, distance=DISTANCE):
    """(row number, anchor) for all anchors of an array of fingerprints (uint64)."""
    words, slack = golay_words(), (2 * distance // 3 + 1) // 2
    parts, shift = [], np.uint64(0)
    for bits in PARTS:
        parts.append(((prints >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32))
        shift += np.uint64(bits)
    least = [np.bitwise_count(p[:, None] ^ words[None, :]).min(axis=1).astype(np.int64) for p in parts]
    rows, anchors = [], []
    for number, (i, j) in enumerate(PAIRS):
        reach = 2 * RADIUS + slack
        row, word, far = _near_words(parts[i], words, reach - least[j])
        row2, word2, far2 = _near_words(parts[j], words, reach - least[i])
        counts = np.bincount(row2, minlength=len(prints))
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        times = counts[row]
        left = np.repeat(np.arange(len(row)), times)
        right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first[row[left]]
        keep = far[left] + far2[right] <= reach
        left, right = left[keep], right[keep]
        rows.append(row[left])
        anchors.append((np.int64(number) << 24) + (word[left] << 12) + word2[right])
    return np.concatenate(rows), np.concatenate(anchors)


def bucket_links(prints: np.ndarray, distance=DISTANCE):
    """Links that join what is linked among the fingerprints of one anchor.

    Of all pairs within the distance only those are given that connect fingerprints not yet
    connected: fewer links than fingerprints, the same components.
    """
    label, links = np.arange(len(prints)), []
    for i in range(len(prints) - 1):
        hits = np.nonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= distance)[0] + i + 1
        if not len(hits):
            continue
        others, first = np.unique(label[hits], return_index=True)
        fresh = others != label[i]
        if fresh.any():
            links += [(prints[i], prints[j]) for j in hits[first[fresh]]]
            label[np.isin(label, others[fresh])] = label[i]
    return links


def _replicate(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 512):
            some = prints[at : at + 512]
            row, anchor = anchors_of(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(some[row].view(np.int64))], ["anchor", "fp"]
            )


def pieces_of(prints: np.ndarray, blocks: int, distance=DISTANCE):
    """(choice, bits of each print) for every choice of ``blocks`` - ``distance`` blocks of the prints."""
    width = 64 // blocks
    for choice, kept in enumerate(combinations(range(blocks), blocks - distance)):
        mask = np.uint64(sum((1 << width) - 1 << width * k for k in kept))
        yield choice, prints & mask


def _split(blocks):
    """Task: the fingerprints under every choice of blocks, with a key for choice and bits."""

    def run(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for choice, bits in pieces_of(prints.view(np.uint64), blocks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bits), choice, np.int64)), pa.array(bits.view(np.int64)), pa.array(prints)],
                    ["choice", "bits", "fp"],
                )

    return run


def _compare(keys: int, most: float, distance=DISTANCE):
    """Task: (a, b) links inside each bucket; (fp, NULL) for the fingerprints of a crowded one.

    Rows come sorted by the ``keys`` columns that name the bucket, which may span batches; no
    more than ``most`` fingerprints and a batch are held.
    """

    def links(fp, size):
        starts = np.cumsum(size) - size
        two = starts[size == 2]
        close = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
        found = [np.stack([fp[close], fp[close + 1]], axis=1)]
        for n in np.nonzero(size > 2)[0]:
            if pairs := bucket_links(fp[starts[n] : starts[n] + size[n]], distance):
                found.append(np.array(pairs, np.uint64))
        pairs = np.unique(np.concatenate(found), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def crowd(fp):
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64())], ["a", "b"])

    def run(batches):
        # ``held`` is the bucket that may go on in the next batch; of a crowded one nothing is held.
        name, held, crowded = None, np.zeros(0, np.uint64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)], axis=1)
            fp = batch.column(keys).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.concatenate(([0], np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1, [len(fp)]))
            if name is not None and name == tuple(key[0]):
                first = cuts[1]
                if crowded or len(held) + first > most:
                    yield crowd(np.concatenate((held, fp[:first])))
                    crowded, held = True, held[:0]
                else:
                    held = np.concatenate((held, fp[:first]))
                cuts = cuts[1:]
                if len(cuts) == 1:
                    continue
            # Here ``held`` is whole: the rows from ``cuts[0]`` on belong to later buckets.
            sizes = np.concatenate(([len(held)], np.diff(cuts)[:-1]))
            whole = np.concatenate((held, fp[cuts[0] : cuts[-2]]))
            for n in np.nonzero(sizes > most)[0]:
                at = int(sizes[:n].sum())
                yield crowd(whole[at : at + sizes[n]])
            if (sizes > most).any():
                whole = whole[np.repeat(sizes <= most, sizes)]
                sizes = sizes[sizes <= most]
            if len(whole):
                yield links(whole, sizes)
            name, held, crowded = tuple(key[-1]), fp[cuts[-2] :], False
            if len(held) > most:
                yield crowd(held)
                crowded, held = True, held[:0]
        if len(held):
            yield links(held, np.array([len(held)]))

    return run


def links_between(prints: DataFrame, most=MOST) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the distance.

    ``prints`` holds distinct, non-NULL fingerprints in its only column, as longs. A bucket of
    more than ``most`` is split by blocks; what the last split leaves is compared whatever its
    size, which is ``MOST`` at most.
    """
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(copies, keys, most):
        met = copies.repartition(partitions, *keys).sortWithinPartitions(*keys, "fp")
        return materialize(met.mapInArrow(_compare(len(keys), most), "a long, b long"), "near_fingerprints")

    found = compared(prints.mapInArrow(_replicate, "anchor long, fp long"), ["anchor"], most)
    links = found.where("b IS NOT NULL")
    for blocks in BLOCKS:
        crowded = found.where("b IS NULL").select("a").distinct()
        if crowded.isEmpty():
            break
        pieces = crowded.repartition(partitions).mapInArrow(_split(blocks), "choice long, bits long, fp long")
        found = compared(pieces, ["choice", "bits"], most if blocks != BLOCKS[-1] else float("inf"))
        links = links.union(found.where("b IS NOT NULL"))
    return links


def groups(rows: DataFrame, order: str) -> DataFrame:
    """(fp, first): for each fingerprint in ``rows`` the smallest ``order`` of its component.

    ``rows`` holds a column ``fp``; it is read twice and must be a written table. Copies
    collapse in a partial aggregate before anything else is done.
    """
    distinct = materialize(rows.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    roots = connected_components(links_between(distinct.select("fp")))
    found = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    found = materialize(found.withColumn("root", F.coalesce("root", "fp")), "roots")
    firsts = found.groupBy("root").agg(F.min("first").alias("first"))
    return found.select("fp", "root").join(firsts, "root").select("fp", "first")


def near_duplicates(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Every row of ``df`` as (id, fingerprint as 16 hex digits, component_id).

    ``component_id`` is the smallest id reachable over links. NULL and empty texts have
    fingerprint zero, which links like any other. Rows with NULL or repeated ids keep their
    rows; a component of NULL ids alone has a NULL ``component_id``. An empty table gives no
    rows. Other columns are not read, so their names cannot clash.
    """
    rows = materialize(df.select(F.col(id_col).alias("id"), fingerprint(text_col).alias("fp")), "simhash")
    return rows.join(groups(rows, "id"), "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def keep_one(df: DataFrame, key: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows of ``df``, one of each component: that of the smallest id, then the smallest key.

    ``key`` is a unique long per row of the written table ``df``.
    """
    order = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(key).alias("key"))
    rows = materialize(df.select(order.alias("place"), fingerprint(text_col).alias("fp")), "simhash")
    firsts = groups(rows, "place").select(F.col("first.key").alias("kept_key")).distinct()
    return df.join(firsts, df[key] == firsts["kept_key"], "left_semi")
