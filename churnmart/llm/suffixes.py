"""Removal of repeated byte strings with a sparse, hash-compared suffix sort.

Every window of ``WINDOW`` bytes is assigned to an anchor: the place in it where a hash of
``GRAM`` bytes is smallest. Equal windows have equal anchors, so a repeated window shows in
two occurrences of its anchor. An occurrence's context is the bytes of all its windows.

1. Anchors are counted by hash, and the contexts of those that occur twice. An anchor that
   occurs once has no repeated window, a context that occurs twice has only repeated ones.
   What remains are anchors with differing contexts.
2. Those contexts are sorted twice within each anchor, by what follows and by what precedes
   it. Two suffixes are compared by their longest common extension, found by binary search
   over prefix polynomial hashes, in a merge sort whose steps run on all suffixes at once;
   the bytes of neighbours are compared at the end, so a collision cannot pass here. Windows are
   equal if they lie in one class of both orders, at depths that add up to the window.
   An anchor with more than ``MOST_CONTEXTS`` contexts is not gathered: its windows are
   counted by hash over all tasks.
3. Occurrences meet the outcome of their context in joins, and each text its intervals.

Sorted contexts are verified by their bytes where they meet. What meets only in an aggregate,
contexts that occur twice and windows of crowded anchors, is verified by a second, unrelated
hash of all its bytes (XXH3): the aggregate holds its smallest and largest value, and where
they differ the job ends with an error instead of a wrong cut.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnmart.llm.common import id_type, struct, text_or_empty
from churnmart.session import materialize

WINDOW, GRAM = 200, 50
# Contexts of one anchor that a task sorts: 7 MB of text.
MOST_CONTEXTS = 20_000
# Bytes of a text that are hashed at a time.
STRETCH = 1 << 19
# Contexts that are sorted at a time, whole anchors each.
SORTED = 1 << 13

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mix(h):
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PrefixHashes:
    """Polynomial hashes, modulo 2^64, of all substrings of a byte array.

    Prefix sums of byte * base^-i; a difference times base^end no longer depends on where
    the substring stands.
    """

    _powers = {}

    def __init__(self, data: np.ndarray, base=_BASES[0]):
        self.up, down = self._tables(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=self.sums[1:])

    @classmethod
    def _tables(cls, base, size):
        found = cls._powers.get(int(base))
        if found is None or len(found[0]) < size:
            size = 1 << int(size).bit_length()
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            found = cls._powers[int(base)] = tuple(
                np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size, x, np.uint64)))) for x in (base, inverse)
            )
        return found

    def of(self, start, end):
        return (self.sums[end] - self.sums[start]) * self.up[end]


def _sliding_min(x, width):
    """Smallest of each ``width`` neighbours."""
    n = len(x)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    padded = padded.reshape(rows, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors_of(data: np.ndarray):
    """(place, low, high, anchor hash, context hash) of the anchors of a text.

    The windows of an anchor at ``place`` start between place - high and place - low; its
    context is data[place - high : place - low + WINDOW].
    """
    found, last = [], len(data) - WINDOW
    mask = np.uint64(2 * STRETCH - 1)
    for first in range(0, last + 1, STRETCH):
        # Windows that start in this stretch; the next stretch may continue an anchor.
        part = data[first : min(first + STRETCH, last + 1) + WINDOW - 1]
        hashes = PrefixHashes(part)
        at = np.arange(len(part) - GRAM + 1)
        grams = _mix(hashes.of(at, at + GRAM))
        least = _sliding_min((grams & ~mask) | at.astype(np.uint64), WINDOW - GRAM + 1)
        place = (least & mask).astype(np.int64)
        starts = np.concatenate(([0], np.nonzero(np.diff(place))[0] + 1))
        ends = np.concatenate((starts[1:], [len(place)])) - 1
        place = place[starts]
        context = _mix(hashes.of(starts, ends + WINDOW))
        low, high = place - ends, place - starts
        context = _mix(context ^ (low << 20 | high).astype(np.uint64))
        found.append((place + first, low, high, grams[place], context))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _identity(key, text: bytes):
    """128 bits that name a row of the input by what it holds."""
    import xxhash

    name = xxhash.xxh3_128(repr(key).encode("utf-8", "surrogatepass") + b"\0" + text).intdigest()
    return (name >> 64) - (1 << 63), (name & (1 << 64) - 1) - (1 << 63)


def _texts(batch):
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        yield key, text.encode("utf-8", "surrogatepass")


def _signed(x):
    return np.ascontiguousarray(x).view(np.int64)


def _batches(schema, parts, rows=1 << 15):
    """Record batches from tuples of arrays, gathered until there are ``rows`` rows."""
    names, waiting, n = schema.names, [], 0
    for part in parts:
        if len(part[0]):
            waiting.append(part)
            n += len(part[0])
        if n >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=f.type) for c, f in zip(zip(*waiting), schema)], names)
            waiting, n = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=f.type) for c, f in zip(zip(*waiting), schema)], names)


_ANCHOR = struct(anchor=T.LongType(), n=T.IntegerType())
_COUNTED = struct(
    anchor=T.LongType(), context=T.LongType(), n=T.LongType(), where=T.LongType(), least_check=T.LongType(), most_check=T.LongType()
)


def _checks(text: bytes, start, end):
    """Signed XXH3 of each text[start:end]."""
    import xxhash

    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(text[a:b]) for a, b in zip(start.tolist(), end.tolist())]), np.int64)


def _verified(n, what):
    """Column ``n``, or an error where the second hashes of what was counted as equal differ."""
    return F.when(F.col("least_check") == F.col("most_check"), F.col(n)).otherwise(
        F.raise_error(F.lit(f"different {what} with one hash")).cast("long")
    ).alias(n)


def _count_anchors(batches):
    """(anchor, n): the anchors of each batch, counted."""

    def parts():
        for batch in batches:
            found = [anchors_of(np.frombuffer(text, np.uint8))[3] for _, text in _texts(batch)]
            anchor, n = np.unique(np.concatenate(found), return_counts=True)
            yield _signed(anchor), n

    yield from _batches(to_arrow_schema(_ANCHOR), parts())


def _count_contexts(shared):
    """Task: contexts of the anchors in the map, with how often and, by hash, where they occur."""

    def run(batches):
        bits = shared.value

        def parts():
            for batch in batches:
                found = []
                for key, text in _texts(batch):
                    place, low, high, anchor, context = anchors_of(np.frombuffer(text, np.uint8))
                    hit = _in_map(bits, anchor)
                    if hit.any():
                        place, low, high = place[hit], low[hit], high[hit]
                        check = _checks(text, place - high, place - low + WINDOW) ^ (low << 20 | high)
                        found.append((anchor[hit], context[hit], _where(key, text, place), check))
                if not found:
                    continue
                anchor, context, where, check = map(np.concatenate, zip(*found))
                order = np.lexsort((where, context, anchor))
                anchor, context, where, check = anchor[order], context[order], where[order], check[order]
                new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(context) != 0)))
                starts = np.nonzero(new)[0]
                yield (
                    _signed(anchor[starts]), _signed(context[starts]), np.diff(np.append(starts, len(anchor))), where[starts],
                    np.minimum.reduceat(check, starts), np.maximum.reduceat(check, starts),
                )

        yield from _batches(to_arrow_schema(_COUNTED), parts())

    return run


def _where(key, text, place):
    return _signed(_mix(np.uint64(_identity(key, text)[0] + (1 << 63)) + place.astype(np.uint64)))


_OCCURRENCE = struct(
    k1=T.LongType(), k2=T.LongType(), anchor=T.LongType(), context=T.LongType(), place=T.LongType(), low=T.IntegerType(),
    high=T.IntegerType(),
)


def _occurrences(shared):
    """Task: occurrences of the anchors in the map of repeated ones (and some more)."""
    schema = to_arrow_schema(_OCCURRENCE)

    def run(batches):
        bits = shared.value

        def parts():
            for batch in batches:
                for key, text in _texts(batch):
                    place, low, high, anchor, context = anchors_of(np.frombuffer(text, np.uint8))
                    hit = _in_map(bits, anchor)
                    if n := int(hit.sum()):
                        k1, k2 = _identity(key, text)
                        yield np.full(n, k1), np.full(n, k2), _signed(anchor[hit]), _signed(context[hit]), place[hit], low[hit], high[hit]

        yield from _batches(schema, parts())

    return run


_CONTEXT = struct(anchor=T.LongType(), context=T.LongType(), low=T.LongType(), high=T.LongType(), bytes=T.BinaryType())


def _context_bytes(shared, crowded, wanted):
    """Task: the bytes of the contexts to compare, of anchors that are crowded or that are not.

    A false hit of the map adds a context that occurs: more to compare, never another result.
    """
    schema = to_arrow_schema(_CONTEXT)

    def run(batches):
        bits, many = shared.value, crowded.value

        def parts():
            for batch in batches:
                for key, text in _texts(batch):
                    place, low, high, anchor, context = anchors_of(np.frombuffer(text, np.uint8))
                    where = _where(key, text, place)
                    hit = np.nonzero(_in_map(bits, _mix(context + where.view(np.uint64))) & (np.isin(anchor, many) == wanted))[0]
                    if len(hit):
                        spans = zip((place - high)[hit].tolist(), (place - low)[hit].tolist())
                        cut = np.empty(len(hit), object)
                        cut[:] = [text[s : e + WINDOW] for s, e in spans]
                        yield _signed(anchor[hit]), _signed(context[hit]), low[hit], high[hit], cut

        yield from _batches(schema, parts(), 4096)

    return run


# A bit map over hashes has a fixed size, 32 MiB: it may be sent to every task. It only thins
# out what is shuffled; the joins after it decide.
MAP_BITS, PIECE_BITS = 28, 18


def _slot(h):
    return h >> np.uint64(64 - MAP_BITS)


def _in_map(bits, hashes):
    slot = _slot(hashes)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _map_of(hashes: DataFrame):
    """Broadcast bit map of the column ``h``, put together from pieces of fixed size."""
    slot = F.shiftrightunsigned("h", 64 - MAP_BITS).alias("slot")
    pieces = hashes.select(slot).distinct().groupBy(F.shiftright("slot", PIECE_BITS).alias("piece"))

    def piece(key, frame):
        bits = np.zeros(1 << PIECE_BITS, np.uint8)
        bits[frame["slot"].to_numpy() & (1 << PIECE_BITS) - 1] = 1
        return type(frame)({"piece": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    whole, step = np.zeros(1 << MAP_BITS - 3, np.uint8), 1 << PIECE_BITS - 3
    for row in pieces.applyInPandas(piece, "piece long, bits binary").collect():
        whole[row["piece"] * step : (row["piece"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(whole)


class Suffixes:
    """Strings in one buffer, sorted within their groups by hash-compared merging."""

    def __init__(self, strings, group):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.hashes = PrefixHashes(self.data)
        self.order = self._sort(np.asarray(group))
        a, b = self.order[:-1], self.order[1:]
        same = np.asarray(group)[a] == np.asarray(group)[b]
        # Common extension with the string before; -1 at the first of a group.
        self.common = np.full(len(strings), -1, np.int64)
        self.common[1:][same] = self.extension(a[same], b[same])
        self._verify(a[same], b[same], self.common[1:][same])

    def extension(self, a, b):
        """Length of the longest common prefix of each pair: binary search over hashes."""
        low, high = np.zeros(len(a), np.int64), np.minimum(self.lengths[a], self.lengths[b])
        sa, sb = self.starts[a], self.starts[b]
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.hashes.of(sa, sa + middle) == self.hashes.of(sb, sb + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def before(self, a, b):
        """Whether each string a sorts before b; equal strings by number."""
        n = self.extension(a, b)
        ended_a, ended_b = n == self.lengths[a], n == self.lengths[b]
        last = len(self.data) - 1
        letter = lambda x: self.data[np.minimum(self.starts[x] + n, last)] if last >= 0 else n
        return np.where(ended_a & ended_b, a < b, ended_a | (~ended_b & (letter(a) < letter(b))))

    def _sort(self, group):
        """Bottom-up merge sort; all runs of all groups are merged in the same steps."""
        order = np.argsort(group, kind="stable")
        sorted_group = group[order]
        first = np.searchsorted(sorted_group, sorted_group)
        size = np.searchsorted(sorted_group, sorted_group, side="right") - first
        inside = np.arange(len(order)) - first
        width = 1
        while width < size.max(initial=0):
            run = inside // width
            other = first + (run ^ 1) * width
            other_end = np.minimum(other + width, first + size)
            at = np.nonzero(other < first + size)[0]
            low, high = other[at].copy(), np.maximum(other, other_end)[at]
            mine = order[at]
            while (low < high).any():
                open_ = low < high
                middle = (low + high) // 2
                theirs = order[np.minimum(middle, len(order) - 1)]
                less = np.zeros(len(at), bool)
                less[open_] = self.before(theirs[open_], mine[open_])
                low, high = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, high)
            place = np.arange(len(order))
            # Own rank in the run plus rank in the other one, from where the pair of runs starts.
            pair = first[at] + (run[at] // 2) * 2 * width
            place[at] = pair + inside[at] % width + low - other[at]
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, 2 * width
        return order

    def _verify(self, a, b, n):
        """Bytes of neighbours agree for their common extension and no further, or a hash lied."""
        if not len(self.data):
            return
        for at in range(0, len(a), 4096):
            x, y, m = a[at : at + 4096], b[at : at + 4096], n[at : at + 4096]
            step = np.arange(int(m.max(initial=0)) + 1)
            near = lambda s, step=step: self.data[np.minimum(self.starts[s][:, None] + step, len(self.data) - 1)]
            equal = near(x) == near(y)
            inside = step < m[:, None]
            ends = (step == m[:, None]) & (m < np.minimum(self.lengths[x], self.lengths[y]))[:, None]
            if (inside & ~equal).any() or (ends & equal).any():
                raise ArithmeticError("a polynomial hash collided; choose another base")

    def classes(self, depth):
        """Number of each string's class of equal prefixes of ``depth`` bytes."""
        number = np.empty(len(self.order), np.int64)
        number[self.order] = np.cumsum(self.common < depth)
        return number


def repeated_windows(group, low, high, contexts):
    """(least, most) offset of the windows that two contexts of a group share; -1 if none.

    A window at offset ``a`` takes ``a`` bytes before the anchor and the rest from it on.
    """
    n = len(contexts)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    after = Suffixes([c[h:] for c, h in zip(contexts, high.tolist())], group)
    ahead = Suffixes([c[:h][::-1] for c, h in zip(contexts, high.tolist())], group)
    for offset in range(int(low.min(initial=0)), int(high.max(initial=-1)) + 1):
        some = np.nonzero((low <= offset) & (offset <= high))[0]
        key = after.classes(WINDOW - offset)[some] * (n + 1) + ahead.classes(offset)[some]
        order = np.argsort(key, kind="stable")
        equal = np.diff(key[order]) == 0
        shared = np.zeros(len(some), bool)
        shared[order[1:][equal]] = shared[order[:-1][equal]] = True
        hit = some[shared]
        least[hit] = np.where(least[hit] < 0, offset, least[hit])
        most[hit] = offset
    return least, most


_OUTCOME = struct(anchor=T.LongType(), context=T.LongType(), least=T.LongType(), most=T.LongType())


def _compare_contexts(batches):
    """Windows that contexts of an anchor share; rows come sorted by anchor, whole anchors are compared."""
    schema = to_arrow_schema(_OUTCOME)

    def outcome(table):
        anchor, context, low, high = (table.column(c).to_numpy() for c in ("anchor", "context", "low", "high"))
        least, most = repeated_windows(anchor, low, high, table.column("bytes").to_pylist())
        hit = least >= 0
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (anchor, context, least, most)], schema.names)

    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        if n >= SORTED:
            table = pa.Table.from_batches(waiting)
            whole = int(np.searchsorted(table.column("anchor").to_numpy(), table.column("anchor")[-1].as_py()))
            if whole:
                yield outcome(table.slice(0, whole))
            waiting = table.slice(whole).combine_chunks().to_batches()
            n = table.num_rows - whole
    if n:
        yield outcome(pa.Table.from_batches(waiting))


_WINDOWS = struct(
    anchor=T.LongType(), context=T.LongType(), offset=T.LongType(), w1=T.LongType(), w2=T.LongType(), check=T.LongType()
)


def _list_windows(batches):
    """(anchor, context, offset, w1, w2, check): every window of the contexts, by its hashes."""

    def parts():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "context", "low", "high", "bytes")]
            for anchor, context, low, high, text in zip(*columns):
                data, offset = np.frombuffer(text, np.uint8), np.arange(low, high + 1)
                n, start = len(offset), high - offset
                w1, w2 = (_signed(_mix(PrefixHashes(data, b).of(start, start + WINDOW))) for b in _BASES)
                yield np.full(n, anchor), np.full(n, context), offset, w1, w2, _checks(text, start, start + WINDOW)

    yield from _batches(to_arrow_schema(_WINDOWS), parts())


def _marks(batches):
    for batch in batches:
        context, where = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(_signed(_mix(context + where)))], ["h"])


def repeated_intervals(rows: DataFrame, most_contexts=MOST_CONTEXTS) -> DataFrame:
    """(k1, k2, spans): the byte intervals to remove from each text of ``rows`` (key, text)."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = rows.mapInArrow(_count_anchors, _ANCHOR).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    anchors = _map_of(totals.select(F.col("anchor").alias("h")))
    counts = rows.mapInArrow(_count_contexts(anchors), _COUNTED).groupBy("anchor", "context")
    bounds = F.min("least_check").alias("least_check"), F.max("most_check").alias("most_check")
    counts = counts.agg(F.sum("n").alias("n"), F.min("where").alias("where"), *bounds)
    counts = materialize(counts.select("anchor", "context", _verified("n", "contexts"), "where"), "contexts")

    # A context is compared with the others of its anchor from one of its occurrences.
    several = counts.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    several = materialize(several, "anchors")
    compared = counts.join(several, "anchor").select("context", "where")
    marked = _map_of(compared.mapInArrow(_marks, "h long"))
    crowded = _crowded(several, most_contexts)

    def bytes_of(wanted):
        found = rows.mapInArrow(_context_bytes(marked, crowded, wanted), _CONTEXT)
        # One row for each context, however many texts hold it or hit the map by chance: copies
        # combine before the shuffle, and an anchor meets its contexts, not their occurrences.
        one = F.min(F.struct("low", "high", "bytes")).alias("one")
        return found.groupBy("anchor", "context").agg(one).select("anchor", "context", "one.*")

    sorted_ = (
        bytes_of(False).repartition(partitions, "anchor").sortWithinPartitions("anchor", "context")
        .mapInArrow(_compare_contexts, _OUTCOME)
    )
    outcome = sorted_
    if len(crowded.value):
        windows = materialize(bytes_of(True).mapInArrow(_list_windows, _WINDOWS), "windows")
        window = ["anchor", "offset", "w1", "w2"]
        bounds = F.min("check").alias("least_check"), F.max("check").alias("most_check")
        twice = windows.groupBy(*window).agg(F.count("*").alias("n"), *bounds).where("n > 1")
        twice = twice.select(*window, _verified("n", "windows")).where("n > 1").drop("n")
        shared = windows.join(twice, window).groupBy("anchor", "context")
        outcome = sorted_.union(shared.agg(F.min("offset").alias("least"), F.max("offset").alias("most")))
    outcome = outcome.groupBy("anchor", "context").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    known = counts.select("anchor", "context", "n").join(outcome, ["anchor", "context"], "left").where("n > 1 OR least IS NOT NULL")
    known = materialize(known.select("anchor", "context", F.when(F.col("n") == 1, F.col("least")).alias("least"), "most"), "outcomes")

    # Without ``least`` all windows of the occurrence are repeated.
    places = rows.mapInArrow(_occurrences(anchors), _OCCURRENCE).join(known, ["anchor", "context"])
    start = F.col("place") - F.when(F.col("least").isNull(), F.col("high")).otherwise(F.col("most"))
    end = F.col("place") - F.coalesce("least", "low") + WINDOW
    spans = places.select("k1", "k2", F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")).alias("span"))
    # As many as a text has anchors, whatever its copies.
    return spans.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"))


def _crowded(several: DataFrame, most_contexts):
    """Broadcast of the anchors with too many contexts for one task.

    Each has over ``most_contexts`` windows' worth of text, so they are far fewer than texts:
    at most one for every 20,000 contexts.
    """
    found = several.where(F.col("m") > most_contexts).select("anchor").collect()
    return several.sparkSession.sparkContext.broadcast(np.array([r["anchor"] for r in found], np.int64).view(np.uint64))


def _named(key_type):
    schema = struct(key=key_type, text=T.StringType(), k1=T.LongType(), k2=T.LongType())
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            names = [_identity(key, text) for key, text in _texts(batch)]
            k1, k2 = zip(*names) if names else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], out.names)

    return run, schema


def merged(spans):
    """Maximal runs of (start, end) intervals; touching ones are one run."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def deduplicate(docs: DataFrame, id_col="doc_id", text_col="text", most_contexts=MOST_CONTEXTS) -> DataFrame:
    """Every whole text without its repeated bytes: id, n_bytes, n_removed, n_spans, kept.

    A byte is removed if a string of ``WINDOW`` bytes that covers it also starts elsewhere, in
    this text or another; strings are judged on the input. ``kept`` is binary: a cut may fall
    inside a character. NULL and empty texts have no bytes, texts shorter than ``WINDOW`` keep
    all. Rows with NULL or repeated ids and repeated rows each count as texts of their own, so
    a repeated row loses all its windows. An empty table gives no rows. Other columns are not
    read.
    """
    rows = docs.select(F.col(id_col).alias("key"), text_or_empty(text_col).alias("text"))
    run, schema = _named(id_type(docs, id_col))
    named = rows.mapInArrow(run, schema).join(repeated_intervals(rows, most_contexts), ["k1", "k2"], "left")
    out = struct(
        **{id_col: id_type(docs, id_col)}, n_bytes=T.LongType(), n_removed=T.LongType(), n_spans=T.LongType(), kept=T.BinaryType()
    )
    arrow = to_arrow_schema(out)

    def cut(batches):
        for batch in batches:
            lines = []
            for (key, text), spans in zip(_texts(batch), batch.column(2).to_pylist()):
                runs = merged((s["start"], s["end"]) for s in spans or ())
                ends = [0, *(x for r in runs for x in r), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
                lines.append((key, len(text), len(text) - len(kept), len(runs), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*lines) if lines else [[]] * 5, arrow)], arrow.names)

    return named.select("key", "text", "spans").mapInArrow(cut, out)


def digest(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``deduplicate`` with the SHA-256 of what is kept in its place."""
    return deduplicate(docs, id_col, text_col).select(
        id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
