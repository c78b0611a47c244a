"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a tree of byte contexts of up to ``DEPTH`` bytes, with counts over every
document learnt from. A byte is coded in the longest context that the tree holds; a byte that
this context has not seen costs an escape (method C: as likely as the number of different
bytes seen there) and is coded in the next shorter context, without the bytes already ruled
out, at last evenly among the bytes the language never had. So the probabilities of all 256
bytes add up to one, and the code length of a text is exact. The statistics are frozen: scoring
changes nothing, and a text's length depends on no other text.

Counts are partial per task and summed by a shuffle. Only the frozen trees travel: per language
the contexts seen most often, with a bound on their number that does not depend on the corpus.
A text is read as if ``DEPTH`` zero bytes stood before it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnmart.llm.common import arrow_map, id_type, struct
from churnmart.session import materialize

DEPTH = 4
# The trees: entries a language has at most, languages, and entries times languages of all.
TREE_ENTRIES = 1 << 18
MOST_LANGUAGES = 256
MODEL_CELLS = 1 << 25
UNDECIDED = "und"

# Bytes that are looked up at once, and counts that a task holds before it hands them on.
_CHUNK = 1 << 18
_HELD = 1 << 21


def _mask(n_bytes):
    return np.uint64((1 << 8 * n_bytes) - 1)


def chunks(texts, size=_CHUNK):
    """(rows, pieces) of whole texts, about ``size`` bytes at a time.

    A piece starts with the ``DEPTH`` bytes before it, so that a long text can be cut.
    """
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        padded = bytes(DEPTH) + text
        for at in range(0, len(text), size):
            rows.append(row)
            parts.append(padded[at : at + size + DEPTH])
            held += len(parts[-1]) - DEPTH
            if held >= size:
                yield rows, parts
                rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


def codes_of(parts):
    """For every byte of the pieces, itself (lowest) and the ``DEPTH`` bytes before it as one number."""
    sizes = np.array([len(p) - DEPTH for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    codes = data[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        codes |= data[DEPTH - back : -back] << np.uint64(8 * back)
    return codes[np.arange(sizes.sum()) + np.repeat(DEPTH * np.arange(len(parts)), sizes)], sizes


def _merged(held):
    codes, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    counts = np.zeros(len(codes), np.int64)
    np.add.at(counts, where, np.concatenate([n for _, n in held]))
    return [(codes, counts)]


def _count(batches):
    """Partial counts of each language's codes; what a task holds is bounded."""
    held: dict = {}

    def rows(lang):
        codes, counts = held.pop(lang)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(counts)],
            ["lang", "code", "n"],
        )

    for batch in batches:
        langs, texts = (c.to_pylist() for c in batch.columns)
        for lang in set(langs):
            for _, parts in chunks(t for t, of in zip(texts, langs) if of == lang):
                held.setdefault(lang, []).append(np.unique(codes_of(parts)[0], return_counts=True))
                if sum(len(c) for c, _ in held[lang]) > _HELD // 2:
                    held[lang] = _merged(held[lang])
            if sum(len(c) for all_of in held.values() for c, _ in all_of) > _HELD:
                for full in sorted(held):
                    held[full] = _merged(held[full])
                    yield rows(full)
    for lang in sorted(held):
        held[lang] = _merged(held[lang])
        yield rows(lang)


def context_counts(texts: DataFrame) -> DataFrame:
    """(lang, depth, code, n) of every context of up to ``DEPTH`` bytes with its next byte.

    ``texts`` holds lang and text (bytes), neither NULL. The deepest codes are counted in the
    texts; each shallower one is the sum of those that end like it.
    """
    deepest = texts.select("lang", "text").mapInArrow(_count, "lang string, code long, n long")
    deepest = deepest.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    each = F.explode(F.array(*[
        F.struct(F.lit(d).cast("byte").alias("depth"), F.col("code").bitwiseAND(F.lit(int(_mask(d + 1)))).alias("code"))
        for d in range(DEPTH + 1)
    ])).alias("e")
    return deepest.select("lang", each, "n").groupBy("lang", "e.depth", "e.code").agg(F.sum("n").alias("n"))


class Codes:
    """Row number of known codes, by open addressing; -1 for others."""

    def __init__(self, codes):
        self._bits = max(4, int(2 * len(codes) + 1).bit_length())
        size = 1 << self._bits
        self._known, self._rows = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        codes, left = codes + np.uint64(1), np.arange(len(codes), dtype=np.int32)
        at = self._first(codes)
        while len(left):
            free = self._rows[at] < 0
            self._rows[at[free]] = left[free]
            placed = self._rows[at] == left
            self._known[at[placed]] = codes[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & (size - 1)

    def _first(self, codes):
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, codes):
        codes = codes + np.uint64(1)
        at = self._first(codes)
        known = self._known[at]
        rows = np.where(known == codes, self._rows[at], np.int32(-1))
        open_ = np.nonzero((known != codes) & (known != 0))[0]
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self._rows) - 1)
            known = self._known[at[open_]]
            hit = known == codes[open_]
            rows[open_[hit]] = self._rows[at[open_[hit]]]
            open_ = open_[~hit & (known != 0)]
        return rows


class Trees:
    """Frozen context trees of several languages; code lengths in bits."""

    def __init__(self, languages, lang, depth, code, n):
        """One entry (number of its language, depth, code, count) each; every suffix of an entry is one too."""
        self.languages = languages
        self._grams, self._counts = [], []
        for d in range(DEPTH + 1):
            of = depth == d
            grams, row = np.unique(code[of], return_inverse=True)
            counts = np.zeros((len(grams), len(languages)))
            counts[row, lang[of]] = n[of]
            self._grams.append(grams)
            self._counts.append(counts)
        self._weigh()
        self._index()

    def _weigh(self):
        """Per context and language: log2 of the total, and what an escape costs, coming in directly or by an escape."""
        self._contexts, self._direct, self._escaped = [], [], []
        totals, kinds = [], []
        for d, (grams, counts) in enumerate(zip(self._grams, self._counts)):
            contexts, starts = np.unique(grams >> np.uint64(8), return_index=True)
            total = np.add.reduceat(counts, starts) if len(starts) else counts
            kind = np.add.reduceat((counts > 0).astype(float), starts) if len(starts) else counts
            self._contexts.append(contexts)
            self._direct.append(_costs(total, kind, kind))
            if d:
                # What the longer context has seen is no longer possible in the shorter one.
                shorter = np.searchsorted(self._grams[d - 1], grams & _mask(d))
                ruled_out = np.add.reduceat(np.where(counts > 0, self._counts[d - 1][shorter], 0), starts) if len(starts) else counts
                parent = np.searchsorted(self._contexts[d - 1], contexts & _mask(d - 1))
                self._escaped.append(_costs(totals[-1][parent] - ruled_out, kinds[-1][parent] - kind, kinds[-1][parent]))
            totals.append(total)
            kinds.append(kind)
        seen = kinds[0][0] if len(kinds[0]) else np.zeros(len(self.languages))
        self._never = np.log2(np.maximum(256 - seen, 1)).astype(np.float32)
        with np.errstate(divide="ignore"):
            self._counts = [np.where(c > 0, np.log2(c), np.nan).astype(np.float32) for c in self._counts]

    def _index(self):
        self._gram_rows = [Codes(g) for g in self._grams]
        self._context_rows = [Codes(c) for c in self._contexts]
        self._deepest = self.lengths(self._grams[-1]).astype(np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_gram_rows", "_context_rows", "_deepest")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._index()

    def lengths(self, codes):
        """Bits of each code's last byte after the bytes before it, one column per language."""
        shape = len(codes), len(self.languages)
        bits, open_, longer, entered = np.zeros(shape), np.ones(shape, bool), None, np.zeros(shape, bool)
        for d in range(DEPTH, -1, -1):
            context = self._context_rows[d].find((codes >> np.uint64(8)) & _mask(d))
            log_n = _rows(self._counts[d], self._gram_rows[d].find(codes & _mask(d + 1)))
            total, escape = (_rows(c, context) for c in self._direct[d])
            known = ~np.isnan(total)
            if d < DEPTH:
                total, escape = (
                    np.where(entered, _rows(c, longer), direct) for c, direct in zip(self._escaped[d], (total, escape))
                )
            here = open_ & known
            found = here & ~np.isnan(log_n)
            bits += np.where(found, total - log_n, np.where(here, escape, 0))
            open_ &= ~found
            if not open_.any():
                return bits
            longer, entered = context, known
        return bits + np.where(open_, self._never, 0)

    def code_lengths(self, texts):
        """Bits of each whole text (bytes), one column per language."""
        bits = np.zeros((len(texts), len(self.languages)))
        for rows, parts in chunks(texts):
            codes, sizes = codes_of(parts)
            row = self._gram_rows[-1].find(codes)
            each = self._deepest[row] if len(self._deepest) else np.zeros((len(codes), len(self.languages)), np.float32)
            other = np.nonzero(row < 0)[0]
            if len(other):
                distinct, where = np.unique(codes[other], return_inverse=True)
                each[other] = self.lengths(distinct)[where]
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            np.add.at(bits, rows, np.add.reduceat(each, starts, axis=0, dtype=np.float64))
        return bits


def _rows(table, at):
    """Rows of ``table``, NaN where ``at`` is -1."""
    if not len(table):
        return np.full((len(at), table.shape[1]), np.nan, np.float32)
    return np.where((at >= 0)[:, None], table[at], np.float32(np.nan))


def _costs(total, kinds, of):
    """(log2 of the total with escapes, bits of an escape); NaN for contexts a language lacks.

    ``of`` is the number of different bytes the context has seen: with all 256 there is
    nothing to escape to. A context whose bytes are all ruled out costs nothing to pass.
    """
    weight = total + np.where(of == 256, 0, kinds)
    log_total = np.log2(np.where(weight > 0, weight, 1))
    escape = np.where(kinds > 0, log_total - np.log2(np.where(kinds > 0, kinds, 1)), 0)
    known = of > 0
    return [np.where(known, x, np.nan).astype(np.float32) for x in (log_total, escape)]


def fold(id_col="doc_id"):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def learn(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", where=None) -> Trees:
    """Context trees of the languages in ``docs``.

    Counts cover every row with a text and a language that ``where`` keeps, copies too. Each
    language keeps the entries seen at least some power of two times: the smallest one that
    leaves at most ``TREE_ENTRIES`` of them (fewer with very many languages, ``MODEL_CELLS``).
    Of more than ``MOST_LANGUAGES`` languages those with the most text are learnt. No rows to
    learn from give trees without languages.
    """
    known = F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()
    chosen = docs.where(known if where is None else known & where)
    texts = chosen.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    counts = materialize(context_counts(texts), "contexts")
    power = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy("lang", power.alias("power")).agg(
        F.count("*").alias("entries"), F.sum(F.when(F.col("depth") == 0, F.col("n"))).alias("bytes")
    )
    most = sizes.groupBy("lang").agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), "lang").limit(MOST_LANGUAGES)
    languages = sorted(r["lang"] for r in most.collect())
    # At most 64 rows for each of the chosen languages.
    found = sizes.where(F.col("lang").isin(languages)).select("lang", "power", "entries").collect() if languages else []
    most_entries = min(TREE_ENTRIES, MODEL_CELLS // max(1, len(languages)) ** 2)
    least = []
    for number, lang in enumerate(languages):
        entries = {r["power"]: r["entries"] for r in found if r["lang"] == lang}
        power = 0
        while sum(n for p, n in entries.items() if p >= power) > most_entries:
            power += 1
        least.append((lang, number, 1 << power))
    if not least:
        nothing = np.zeros(0, np.int64)
        return Trees([], nothing, nothing, nothing.astype(np.uint64), nothing)
    # At most MOST_LANGUAGES rows.
    least = F.broadcast(docs.sparkSession.createDataFrame(least, "lang string, number int, least long"))
    kept = counts.join(least, "lang").where("n >= least").select("number", "depth", "code", "n").toArrow()
    number, depth, code, n = (c.to_numpy() for c in kept.columns)
    return Trees(languages, number, depth, code.astype(np.uint64), n)


def predict(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Every row of ``docs`` as (id, held_out, lang_pred, score).

    The language is the one whose tree codes the whole text in the fewest bits (the first by
    name on a tie), the score its share of the probability with all languages equally likely
    before. Learns from the rows outside fold 0 that have a text and a language. A text that
    is NULL, empty or without any letter is ``und`` with score 0, and so is every text when no
    language could be learnt. Rows with NULL ids are neither learnt from nor held out; repeated
    rows count as often as they occur and get equal results. An empty table gives no rows.
    Other columns are not read, so their names cannot clash.
    """
    trees = learn(docs, id_col, text_col, lang_col, fold(id_col) != 0)
    # Bounded by MODEL_CELLS, whatever the size of the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = struct(id=id_type(docs, id_col), held_out=T.BooleanType(), lang_pred=T.StringType(), score=T.DoubleType())
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"),
        F.when(text.rlike(r"\p{L}"), text.cast("binary")).alias("text"),
    )

    def task(batches):
        trees = shared.value
        for ids, held_out, texts in batches:
            known = [i for i, t in enumerate(texts) if t is not None and trees.languages]
            langs, scores = [UNDECIDED] * len(ids), [0.0] * len(ids)
            bits = trees.code_lengths([texts[i] for i in known])
            for i, best, row in zip(known, bits.argmin(axis=1) if known else (), bits):
                langs[i] = trees.languages[best]
                scores[i] = float(1 / np.exp2(row[best] - row).sum())
            yield ids, held_out, langs, scores

    return arrow_map(rows, schema, task).withColumnRenamed("id", id_col)
