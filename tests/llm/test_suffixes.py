"""Repeated byte strings against a dictionary of all windows."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from churnmart.llm import suffixes as sx


def slow(texts, window=sx.WINDOW):
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), kept))
    return out


def check(spark, texts, most_contexts=sx.MOST_CONTEXTS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sx.deduplicate(df, most_contexts=most_contexts).collect()}
    want = slow([(t or "").encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdefghij é\n"
    text = lambda n: "".join(rng.choices(letters, k=n))
    passages = [text(n) for n in (150, 199, 200, 201, 260, 400, 900)]
    out = [None, "", "x" * 199, "y" * 200, "z" * 700, "ab" * 400]
    for _ in range(60):
        parts = [text(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            at = rng.randint(0, len(p) // 3)
            p = p[at:] if rng.random() < 0.4 else p
            if rng.random() < 0.3:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1 :]
            parts += [p, text(rng.randint(0, 120))]
        out.append("".join(parts))
    return out + rng.choices(out, k=6)


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_matches_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_crowded_anchors_are_counted_the_same(spark):
    check(spark, corpus(3), most_contexts=3)


def test_stretches_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(sx, "STRETCH", 256)
    texts = [t.encode() for t in corpus(4) if t]
    whole = {tuple(int(x) for x in (p - h, p - lo)) for t in texts for p, lo, h, *_ in zip(*sx.anchors_of(np.frombuffer(t, np.uint8)))}
    assert whole
    check(spark, corpus(4))


@settings(max_examples=40, deadline=None)
@example([(0, b""), (0, b"")])
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b))), max_size=40))
def test_merge_sort_orders_suffixes_of_each_group(items):
    group, strings = [g for g, _ in items], [s for _, s in items]
    found = sx.Suffixes(strings, np.array(group, np.int64))
    assert [(group[i], strings[i], i) for i in found.order] == sorted((g, s, i) for i, (g, s) in enumerate(items))
    for n, (a, b) in enumerate(zip(found.order[:-1], found.order[1:]), 1):
        common = next((k for k, (x, y) in enumerate(zip(strings[a], strings[b])) if x != y), min(len(strings[a]), len(strings[b])))
        assert found.common[n] == (common if group[a] == group[b] else -1)


def test_every_window_has_one_anchor():
    data = np.frombuffer(("lorem ipsum dolor " * 90).encode(), np.uint8)
    place, low, high, *_ = sx.anchors_of(data)
    starts = sorted(s for p, lo, h in zip(place, low, high) for s in range(p - h, p - lo + 1))
    assert starts == list(range(len(data) - sx.WINDOW + 1))


def test_odd_rows(spark):
    long = "".join(chr(97 + (i * i * 7 + i // 13) % 26) for i in range(260))
    rows = [(None, long, 1), (None, long, 1), (1, None, 1), (2, "", 1), (3, long[:150], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k1 int")
    got = sx.digest(df).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in got) == [(0, 0, 0), (0, 0, 0), (150, 0, 0), (260, 260, 1), (260, 260, 1)]
    assert sx.digest(df.limit(0)).count() == 0


@pytest.mark.parametrize("most_contexts", [sx.MOST_CONTEXTS, 0])
def test_equal_hashes_of_different_bytes_are_an_error(spark, most_contexts):
    long = "".join(chr(97 + (i * i * 7 + i // 13) % 26) for i in range(330))
    df = spark.createDataFrame([(1, "a" + long), (2, "b" + long)], "doc_id long, text string")
    assert [r.n_removed for r in sx.deduplicate(df, most_contexts=most_contexts).collect()] == [330, 330]

    rows = spark.createDataFrame([(1, 5, 5), (2, 5, 6)], "n long, least_check long, most_check long")
    assert [r.n for r in rows.where("n = 1").select(sx._verified("n", "windows")).collect()] == [1]
    with pytest.raises(Exception, match="different windows with one hash"):
        rows.select(sx._verified("n", "windows")).collect()


def test_second_hashes_are_those_of_the_bytes():
    import xxhash

    text = bytes(range(256)) * 3
    got = sx._checks(text, np.array([0, 7, 256]), np.array([200, 300, 456]))
    assert got.view(np.uint64).tolist()[::2] == [int.from_bytes(xxhash.xxh3_64_digest(text[:200]), "little")] * 2 and len(set(got.tolist())) == 2
