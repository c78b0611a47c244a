"""Benchmark decontamination by spaced seeds.

A text shares a passage with a benchmark item if, along one alignment, a window of ``WINDOW``
words (the whole item, if it is shorter) has at least ``SIMILAR`` of its words equal. Each
mask fixes which of a few neighbouring words are hashed and which are ignored. A window of
five words with at most one replaced word always has four equal words under one of the
masks, and any window with a fifth of its words replaced contains such a five: no passage
escapes. Items of fewer than five words are no evidence and match nothing.
"""

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnmart.llm.common import id_type, struct, text_or_empty
from churnmart.session import materialize

# Offsets of the hashed words; the words between are ignored.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4))
WINDOW, SHORTEST, SIMILAR = 20, 5, 0.8
# The bits of a map of seed hashes: fixed size, 8 MiB, whatever the size of the benchmark.
MAP_BITS = 26
PIECE_BITS = 16
# Characters whose words are hashed at once, about: short texts go together, long ones in pieces.
CHUNK = 1 << 17
ROWS = 4096

_WORDS = re.compile(r"[^\W_]+").findall
_BREAK = re.compile(r"[\W_]").search
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_BASE = 0xA0761D6478BD642F


@cache
def _in_word():
    """For each code point whether it belongs to a word."""
    table = np.zeros(0x110000, bool)
    every = np.arange(len(table), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for run in re.finditer(r"[^\W_]+", every):
        table[run.start() : run.end()] = True
    return table


class Seeds:
    """Words of a lower-case text: where they start and end, and their hashes under each mask.

    A word's hash is a polynomial in its code points modulo 2^64, so that all words of a piece
    are hashed at once: sums of code points times powers of their places, moved to place zero.
    """

    def __init__(self):
        self._powers = self._inverse = np.zeros(0, np.uint64)

    def words(self, text):
        """(starts, ends, hashes) of the words of ``text``; a piece never ends inside a word."""
        pieces, at = [], 0
        while at < len(text):
            end = _BREAK(text, at + CHUNK)
            end = end.start() if end else len(text)
            pieces.append(self._piece(text[at:end], at))
            at = end
        none = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)]
        return [np.concatenate(c) for c in zip(none, *pieces)]

    def _piece(self, text, offset):
        codes = np.frombuffer(f"\n{text}\n".encode("utf-32-le", "surrogatepass"), "<u4")
        if len(codes) > len(self._powers):
            size = max(len(codes), 2 * CHUNK)
            self._powers, self._inverse = (
                np.full(size, b, np.uint64).cumprod() for b in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        inside = _in_word()[codes]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        if not len(edges):
            return starts, ends, np.zeros(0, np.uint64)
        sums = np.add.reduceat(codes * self._powers[: len(codes)], edges)[::2]
        hashes = sums * self._inverse[starts] * _ODD[0]
        hashes ^= hashes >> np.uint64(32)
        return starts - 1 + offset, ends - 1 + offset, hashes

    @staticmethod
    def masked(hashes, number, mask):
        n = len(hashes) - mask[-1]
        if n < 1:
            return np.zeros(0, np.uint64)
        mixed = np.full(n, number, np.uint64)
        for offset, odd in zip(mask, _ODD):
            mixed = (mixed ^ hashes[offset : offset + n]) * odd
            mixed ^= mixed >> np.uint64(29)
        return mixed


def _groups(texts):
    """(first, end) of runs of texts with about ``CHUNK`` characters, or one long text, each."""
    first = size = 0
    for at, text in enumerate(texts):
        if at > first and size + len(text) > CHUNK:
            yield first, at
            first, size = at, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def _hits(seeds, texts, bits):
    """(text, seed, place of its first word, words of the text, near, place of the seed in near) of each seed.

    ``near`` holds the words that any window over the seed may hold. Yields lists of arrays,
    for at most ``ROWS`` seeds each. Seeds that the map ``bits`` cannot hold are left out.
    """
    # A line end is no part of a word: texts are read as one, then seeds over two are dropped.
    whole = "\n".join(texts)
    starts, ends, hashes = seeds.words(whole)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, begins)
    n_words = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), n_words)
    for number, mask in enumerate(MASKS):
        some = seeds.masked(hashes, number, mask)
        slot = some >> np.uint64(64 - MAP_BITS)
        found = np.arange(len(some)) if bits is None else np.flatnonzero(
            bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1
        )
        text = owner[found]
        kept = (text == owner[found + mask[-1]]) & (n_words[text] >= SHORTEST)
        for at in range(0, len(found), ROWS):
            rows = found[at : at + ROWS][kept[at : at + ROWS]]
            mine = owner[rows]
            first = np.maximum(bounds[mine], rows - WINDOW + 1)
            last = np.minimum(bounds[mine + 1], rows + WINDOW) - 1
            near = [" ".join(_WORDS(whole[i:j])) for i, j in zip(starts[first].tolist(), ends[last].tolist())]
            yield [mine, some[rows].view(np.int64), rows - bounds[mine], n_words[mine], near, rows - first]


def _seed_rows(df, id_col, text_col, extra, bitmap=None):
    """(id, extra, seed, at, near, place): every seed of every text that the map may hold."""
    schema = struct(
        **{c: id_type(df, c) for c in (id_col, *extra)}, seed=T.LongType(), at=T.LongType(),
        n_words=T.LongType(), near=T.StringType(), place=T.IntegerType(),
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    out, width = to_arrow_schema(schema), 1 + len(extra)

    def run(batches):
        seeds, bits = Seeds(), bitmap.value if bitmap is not None else None
        for batch in batches:
            texts = [t.lower() for t in batch.column(width).to_pylist()]
            for first, end in _groups(texts):
                for mine, *found in _hits(seeds, texts[first:end], bits):
                    if len(mine):
                        keys = [batch.column(c).take(pa.array(mine + first)) for c in range(width)]
                        yield pa.RecordBatch.from_arrays(
                            [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                             for c, f in zip((*keys, *found), out)], schema=out
                        )

    columns = [F.col(c) for c in (id_col, *extra)]
    return df.select(*columns, text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def _map_of(seeds: DataFrame) -> np.ndarray:
    """Bit map over the leading bits of all seeds, put together from pieces of fixed size."""
    slot = F.shiftrightunsigned("seed", 64 - MAP_BITS).alias("slot")
    pieces = seeds.select(slot).distinct().groupBy(F.shiftright("slot", PIECE_BITS).alias("piece"))

    def piece(key, frame):
        bits = np.zeros(1 << PIECE_BITS, np.uint8)
        bits[frame["slot"].to_numpy() & (1 << PIECE_BITS) - 1] = 1
        return type(frame)({"piece": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    whole = np.zeros(1 << MAP_BITS - 3, np.uint8)
    step = 1 << PIECE_BITS - 3
    for row in pieces.applyInPandas(piece, "piece long, bits binary").collect():
        whole[row["piece"] * step : (row["piece"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    return whole


def best_window(text_near, text_place, item_near, item_place, item_words):
    """(equal words, window words, offset of the window from the seed) of the best window.

    Windows lie along the alignment that puts the two seeds onto each other and hold the
    seed's first word; None if no window is similar enough.
    """
    a, b = text_near.split(" "), item_near.split(" ")
    size = min(WINDOW, item_words)
    first = -min(text_place, item_place)
    last = min(len(a) - text_place, len(b) - item_place)
    same = np.array([a[text_place + i] == b[item_place + i] for i in range(first, last)], int)
    if len(same) < size:
        return None
    sums = np.convolve(same, np.ones(size, int), "valid")
    best = int(np.argmax(sums))
    if sums[best] < SIMILAR * size:
        return None
    return int(sums[best]), size, first + best


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", extra=()) -> DataFrame:
    """(id, ``extra`` columns, item_id, n_equal, n_window, first_word) for each text and item it shares a passage with.

    The window with the most equal words counts, then the first. NULL and empty texts, and
    items of fewer than five words, share nothing. Rows with NULL or repeated ids are
    reported under that id, equal (id, item) pairs once. Two empty tables give no rows. Only
    the named columns are read.
    """
    spark = docs.sparkSession
    items = materialize(_seed_rows(benchmark.select("item_id", "text").distinct(), "item_id", "text", ()), "items")
    # Fixed size, so it may be broadcast; false hits are ended by the join.
    bitmap = spark.sparkContext.broadcast(_map_of(items))
    hits = _seed_rows(docs, id_col, text_col, extra, bitmap)
    theirs = items.select(
        "item_id", "seed", F.col("near").alias("item_near"), F.col("place").alias("item_place"),
        F.col("n_words").alias("item_words"),
    )
    keys = [id_col, *extra]
    pairs = hits.join(theirs, "seed").select(*keys, "at", "near", "place", "item_id", "item_near", "item_place", "item_words")
    found = "n_equal long, n_window long, first_word long"
    types = ", ".join(f"`{c}` {id_type(docs, c).simpleString()}" for c in keys)
    item_type = id_type(benchmark, "item_id").simpleString()

    def verify(batches):
        width = len(keys)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            rows = []
            for row in zip(*columns):
                at, near, place, item, item_near, item_place, item_words = row[width:]
                best = best_window(near, place, item_near, item_place, item_words)
                if best:
                    rows.append((*row[:width], item, best[0], best[1], at + best[2]))
            out = zip(*rows) if rows else [[]] * (width + 4)
            schema = [*(batch.schema.field(i).type for i in range(width)), batch.schema.field(width + 3).type, *[pa.int64()] * 3]
            names = [*keys, "item_id", "n_equal", "n_window", "first_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, schema)], names)

    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("first"), "n_window")).alias("best")
    return (
        pairs.mapInArrow(verify, f"{types}, item_id {item_type}, {found}")
        .groupBy(*keys, "item_id").agg(best)
        .select(*keys, "item_id", "best.n_equal", "best.n_window", (-F.col("best.first")).alias("first_word"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str, text_col="text") -> DataFrame:
    """Rows of ``docs`` that share no passage with the benchmark; ``key`` is unique per row."""
    taken = overlaps(docs.select(key, text_col), benchmark, key, text_col).select(F.col(key).alias("taken_key")).distinct()
    return docs.join(taken, docs[key] == taken["taken_key"], "left_anti")
