"""Sparse linear models: hashed text features, FTRL-proximal updates, ordinal thresholds."""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnmart.llm.common import arrow_map, slices, struct, text_or_empty

BITS = 20
# Bucket that every text has: the intercept.
ALWAYS = 0
# Distinct words a task remembers the hash of.
REMEMBERED = 400_000

_TOKENS = re.compile(r"[^\W_]+|[^\w\s]+|_+").findall
_WORDS = re.compile(r"[^\W_]+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Value of each distinct word, computed once for as long as it is remembered."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, word):
        value = self[word] = self._make(word)
        return value

    def of(self, words, dtype):
        found = np.frombuffer(b"".join(map(self.__getitem__, words)), dtype)
        if len(self) > REMEMBERED:
            self.clear()
        return found


def _hash(*texts) -> bytes:
    import xxhash

    return b"".join(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")).to_bytes(8, "little") for t in texts)


class WordNgrams:
    """Hashed words, word pairs and repeats of a word, by damped counts of unit length.

    Case and runs of symbols stay apart: both tell clean prose from debris.
    """

    def __init__(self):
        self._hashes = _Hashes(_hash)

    def __call__(self, text):
        words = self._hashes.of(_TOKENS(text), np.uint64)
        pairs = (words[:-1] * _MIX + words[1:]) * _MIX
        pairs[words[:-1] == words[1:]] = np.uint64(1 << 63)
        buckets, counts = np.unique(np.concatenate((words, pairs)) >> np.uint64(64 - BITS), return_counts=True)
        values = 1 + np.log(counts)
        values /= max(np.sqrt((values**2).sum()), 1)
        return np.append(buckets, ALWAYS).astype(np.uint32), np.append(values, 1).astype(np.float32)


class WordStems:
    """Which words, and which first three to seven letters of words, a text has."""

    def __init__(self):
        self._hashes = _Hashes(lambda w: _hash(w, *(w[:n] + "*" for n in range(3, 8) if len(w) > n)))

    def __call__(self, text):
        buckets = np.unique(self._hashes.of(set(_WORDS(text.lower())), np.uint64) >> np.uint64(64 - BITS))
        return np.append(buckets, ALWAYS).astype(np.uint32), np.ones(len(buckets) + 1, np.float32)


class Ftrl:
    """Follow the regularised leader, with a learning rate for each weight."""

    def __init__(self, alpha, beta, l1, l2, least=-np.inf):
        """``least`` bounds the weights from below."""
        self.alpha, self.beta, self.l1, self.l2, self.least = alpha, beta, l1, l2, least
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(self, at):
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == ALWAYS, 0.0, self.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return np.maximum(-shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), self.least)

    def update(self, at, gradient, weights):
        n = self.n[at]
        grown = n + gradient**2
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = grown

    def dense(self):
        return self.weights(np.arange(1 << BITS)).astype(np.float32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, features, rows: int, where=None) -> DataFrame:
    """Features of at most ``rows`` labelled documents, in one partition, in hash order.

    ``rows`` bounds what a model learns from, whatever the size of the corpus: the labelled
    ids with the smallest hashes. Ids are chosen before any text is read. Unlabelled rows
    and NULL ids teach nothing.
    """
    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    chosen = known.where(where if where is not None else F.lit(True)).select(
        F.col("doc_id").alias("id"), place.alias("place"), F.col(target).cast("int").alias("y")
    ).orderBy("place", "id", "y").limit(rows)
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), text_or_empty().alias("text"))
    # ``chosen`` has at most ``rows`` rows of three numbers.
    joined = texts.join(F.broadcast(chosen), "id").select("place", "id", "y", "text")
    schema = struct(place=T.LongType(), id=texts.schema["id"].dataType, y=T.IntegerType(), at=T.BinaryType(), value=T.BinaryType())

    def task(batches):
        extract = features()
        for batch in batches:
            for places, ids, ys, texts in slices(batch, 256):
                found = [extract(t) for t in texts]
                yield places, ids, ys, [a.tobytes() for a, _ in found], [v.tobytes() for _, v in found]

    return arrow_map(joined, schema, task).orderBy("place", "id", "y", "at").limit(rows).coalesce(1)


def fit(sample: DataFrame, learn) -> tuple[np.ndarray, np.ndarray]:
    """(weights, other parameters) of ``learn(features, labels)`` in one task over ``sample``."""
    schema = struct(at=T.BinaryType(), weight=T.BinaryType(), other=T.BinaryType())

    def task(batches):
        xs, ys = [], []
        for _, _, y, at, value in batches:
            xs += [(np.frombuffer(a, np.uint32), np.frombuffer(v, np.float32)) for a, v in zip(at, value)]
            ys += y
        if xs:
            weights, other = learn(xs, np.array(ys))
            at = np.nonzero(weights)[0].astype(np.uint32)
            yield [at.tobytes()], [weights[at].tobytes()], [np.asarray(other, float).tobytes()]

    weights = np.zeros(1 << BITS, np.float32)
    row = arrow_map(sample, schema, task).first()
    if row is None:
        return weights, np.zeros(0)
    weights[np.frombuffer(row["at"], np.uint32)] = np.frombuffer(row["weight"], np.float32)
    return weights, np.frombuffer(row["other"])


def sums(docs: DataFrame, weights: np.ndarray, features, text_col="text"):
    """Column expression: the sparse dot product of each whole text with ``weights``."""
    # 2^20 weights of four bytes, whatever the size of the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        extract, w = features(), shared.value
        for texts in parts:
            yield pd.Series([float(w[at] @ value) for at, value in map(extract, texts)], dtype="float64")

    return of(text_or_empty(text_col))
