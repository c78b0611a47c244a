"""Quality and toxicity models: held-out accuracy, updates and scores by brute force, odd rows."""

import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnmart.llm import linear, quality, toxicity

LARGER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    read = spark.read.parquet
    try:
        return read(f"{LARGER}/documents.parquet"), read(f"{LARGER}/labels.parquet")
    except Exception:
        pytest.skip(f"no tables at {LARGER}")


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    pos = label.sum()
    return (rank[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos))


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    some = labels.join(docs, "doc_id").select("doc_id", "text")
    got = quality.score(some, labels).join(labels, "doc_id").toPandas()
    assert len(got) == labels.count()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert auc(held.score.values, held.quality.values) > 0.99


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    some = labels.join(docs, "doc_id").select("doc_id", "text")
    got = toxicity.score(some, labels, where=quality.fold() != 1)
    got = got.join(labels.withColumnRenamed("toxic", "label"), "doc_id").where(quality.fold() == 1).toPandas()
    assert auc(got.severity.values, got.label.values) > 0.95
    assert got[got.label == 0].toxic.mean() < 0.02 and got[got.label == 1].toxic.mean() > 0.75
    assert set(got.grade) <= {0, 1, 2} and got.severity.between(0, 2).all()


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(i, "good words here" if i % 2 else "$$$ bad !!", i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(quality.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.score(docs, labels).collect() == quality.score(docs, flipped).collect()


def test_sample_is_bounded_and_the_same_each_time(spark):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(50)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    sample = linear.labelled_sample(docs, labels, "quality", linear.WordNgrams, 7)
    assert sample.rdd.getNumPartitions() == 1
    assert [r.id for r in sample.collect()] == [r.id for r in sample.collect()] and sample.count() == 7


def test_word_ngrams_count_words_and_pairs():
    at, value = linear.WordNgrams()("a b a b !!")
    assert len(at) == 6 + 1 and at[-1] == linear.ALWAYS  # a, b, !!, (a b), (b a), (b !!)
    assert np.isclose((value[:-1] ** 2).sum(), 1, atol=1e-5)
    assert len(linear.WordNgrams()("")[0]) == 1


def test_word_stems_ignore_case_and_repeats():
    one, two = linear.WordStems()("Abcd abcd"), linear.WordStems()("abcd")
    assert one[0].tolist() == two[0].tolist() and len(two[0]) == 3


def test_ordinal_fit_orders_thresholds_and_grades():
    rng = np.random.default_rng(3)
    xs, ys = [], []
    for _ in range(600):
        marks = rng.choice(np.arange(1, 9), rng.integers(0, 7), replace=False)
        noise = rng.choice(np.arange(20, 60), 5, replace=False)
        xs.append((np.append(np.concatenate((marks, noise)), 0).astype(np.uint32), np.ones(len(marks) + 6, np.float32)))
        ys.append(0 if len(marks) < 2 else 1 if len(marks) < 5 else 2)
    weights, thresholds = toxicity.fit_ordinal(xs, ys, 3)
    assert thresholds[0] < thresholds[1] and weights.min() >= 0
    z = np.array([weights[a] @ v for a, v in xs])
    grade = (z[:, None] > thresholds).sum(axis=1)
    assert (grade == ys).mean() > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (None, "some text", 5), (4, "idiot " * 30_000, 5), (4, "x", 5), (4, "x", 5)],
        "doc_id long, text string, z int",
    )
    labels = spark.createDataFrame(
        [(1, 1, 0), (4, 0, 1), (4, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )
    for got in (quality.score(docs, labels), toxicity.score(docs, labels)):
        rows = got.collect()
        assert len(rows) == 6
        assert len({r for r in rows if r.doc_id in (1, 2)}) == 2
    blank = quality.score(docs, labels).where("doc_id in (1, 2)").collect()
    assert blank[0].score == blank[1].score
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.toxic for r in toxicity.score(docs, labels.limit(0)).collect()} == {0}
    assert quality.score(docs.limit(0), labels).count() == toxicity.score(docs.limit(0), labels).count() == 0


class SlowFtrl:
    """Follow the regularised leader one weight at a time, as the method is published."""

    def __init__(self, alpha, beta, l1, l2, least=-math.inf):
        self.alpha, self.beta, self.l1, self.l2, self.least = alpha, beta, l1, l2, least
        self.z, self.n = {}, {}

    def weight(self, i):
        z, n = self.z.get(i, 0.0), self.n.get(i, 0.0)
        l1 = 0.0 if i == linear.ALWAYS else self.l1
        if abs(z) <= l1:
            return max(0.0, self.least)
        return max(-(z - math.copysign(l1, z)) / ((self.beta + math.sqrt(n)) / self.alpha + self.l2), self.least)

    def update(self, i, g):
        n, w = self.n.get(i, 0.0), self.weight(i)
        rate = (math.sqrt(n + g * g) - math.sqrt(n)) / self.alpha
        self.z[i] = self.z.get(i, 0.0) + g - rate * w
        self.n[i] = n + g * g


def slow_sigmoid(x):
    return 1 / (1 + math.exp(-x))


def sparse_rows(n, seed):
    rng = np.random.default_rng(seed)
    return [
        (np.append(rng.choice(np.arange(1, 40), 6, replace=False), linear.ALWAYS).astype(np.uint32),
         np.append(rng.random(6), 1).astype(np.float32))
        for _ in range(n)
    ]


def test_quality_updates_match_the_plain_method():
    xs, ys = sparse_rows(80, 1), np.random.default_rng(2).integers(0, 2, 80)
    slow = SlowFtrl(0.5, 1.0, 0.3, 0.5)
    for _ in range(quality.EPOCHS):
        for (at, value), y in zip(xs, ys):
            p = slow_sigmoid(sum(slow.weight(int(i)) * float(v) for i, v in zip(at, value)))
            for i, w in [(int(i), (p - y) * float(v)) for i, v in zip(at, value)]:
                slow.update(i, w)
    got, _ = quality._learn(xs, ys)
    want = np.array([slow.weight(i) for i in range(40)])
    assert np.allclose(got[:40], want, atol=1e-5) and not got[40:].any()
    assert 0 < np.count_nonzero(want[1:]) < 39


def likelihood(z, thresholds, grade):
    over = [1.0, *(slow_sigmoid(z - t) for t in thresholds), 0.0]
    return math.log(over[grade] - over[grade + 1])


def test_ordinal_updates_follow_the_slope_of_the_likelihood():
    xs, ys = sparse_rows(60, 3), np.random.default_rng(4).integers(0, 3, 60)
    slow, parts, squares, h = SlowFtrl(0.3, 1.0, 2.0, 0.1, 0.0), [1.0, 0.0], [1e-8, 1e-8], 1e-5

    def thresholds(first, gap):
        return [first, first + math.exp(gap)]

    for _ in range(2):
        for (at, value), y in zip(xs, ys):
            pairs = [(int(i), float(v)) for i, v in zip(at[:-1], value[:-1])]
            z, t = sum(slow.weight(i) * v for i, v in pairs), thresholds(*parts)
            slope = -(likelihood(z + h, t, y) - likelihood(z - h, t, y)) / (2 * h)
            steps = []
            for k in range(2):
                up, down = ([p + d * (i == k) for i, p in enumerate(parts)] for d in (h, -h))
                steps.append(-(likelihood(z, thresholds(*up), y) - likelihood(z, thresholds(*down), y)) / (2 * h))
            for i, v in pairs:
                slow.update(i, slope * v)
            for k, step in enumerate(steps):
                squares[k] += step * step
                parts[k] -= 0.1 * step / math.sqrt(squares[k])
    weights, got = toxicity.fit_ordinal(xs, ys, 3, epochs=2)
    want = np.array([0.0] + [slow.weight(i) for i in range(1, 40)])
    assert np.allclose(weights[:40], want, atol=1e-4) and want.any() and (want >= 0).all()
    assert np.allclose(got, thresholds(*parts), atol=1e-3)


def test_scores_are_dot_products_of_hashed_ngrams(spark):
    mix, size = 0x9E3779B97F4A7C15, 1 << 64
    texts = ["", "a b a b !!", "Some words, some_more; words words", "é é x " * 30]
    weights = np.random.default_rng(6).normal(size=1 << linear.BITS).astype(np.float32)

    def slow(text):
        words = [xxhash.xxh64_intdigest(w.encode()) for w in re.findall(r"[^\W_]+|[^\w\s]+|_+", text)]
        pairs = [1 << 63 if a == b else (a * mix + b) * mix % size for a, b in zip(words, words[1:])]
        counts = {}
        for x in words + pairs:
            counts[x >> 44] = counts.get(x >> 44, 0) + 1
        values = {k: 1 + math.log(n) for k, n in counts.items()}
        length = max(1.0, math.sqrt(sum(v * v for v in values.values())))
        return float(weights[linear.ALWAYS]) + sum(float(weights[k]) * v / length for k, v in values.items())

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", linear.sums(docs, weights, linear.WordNgrams).alias("z")).collect()
    assert all(math.isclose(r.z, slow(texts[r.doc_id]), abs_tol=1e-4) for r in got) and len(got) == len(texts)


def test_expected_severity_by_hand(spark):
    row = spark.range(1).select(toxicity._parts(F.lit(1.2), np.array([0.5, 2.0])).alias("s")).first().s
    over = [slow_sigmoid(1.2 - 0.5), slow_sigmoid(1.2 - 2.0)]
    chance = [1 - over[0], over[0] - over[1], over[1]]
    assert math.isclose(row.severity, chance[1] + 2 * chance[2]) and math.isclose(row.p_toxic, over[0])
    assert row.grade == chance.index(max(chance))
