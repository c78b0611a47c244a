"""Spaced seeds against brute force over all alignments."""

import itertools
import random

import pytest

from churnmart.llm import decontaminate as d


def slow_best(text, item):
    a, b = d._WORDS((text or "").lower()), d._WORDS((item or "").lower())
    size, best = min(d.WINDOW, len(b)), None
    if len(b) < d.SHORTEST:
        return None
    for i in range(len(a) - size + 1):
        for j in range(len(b) - size + 1):
            same = sum(x == y for x, y in zip(a[i : i + size], b[j : j + size]))
            if same >= d.SIMILAR * size and (best is None or (-same, i) < best):
                best = (-same, i)
    return best and (-best[0], size, best[1])


@pytest.mark.parametrize("size", [5, 7, 10, 14, 15, 19, 20])
def test_masks_see_every_window_with_a_fifth_replaced(size):
    for wrong in itertools.combinations(range(size), int(size * (1 - d.SIMILAR) + 1e-9)):
        assert any(
            not {at + o for o in mask} & set(wrong) for mask in d.MASKS for at in range(size - mask[-1])
        ), wrong


def test_pairs_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choices(vocabulary, k=n)) for n in (3, 5, 9, 15, 20, 30, 45)]
    texts = []
    for n in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        part = rng.choice(items).split()
        part = [w if rng.random() > 0.16 else "X" + w for w in part[rng.randint(0, 3) :]]
        texts.append(" ".join(words + part + rng.choices(vocabulary, k=5)).upper())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_equal, r.n_window, r.first_word) for r in d.overlaps(docs, bench).collect()}
    want = {(i, j): b for i, t in enumerate(texts) for j, x in enumerate(items) if (b := slow_best(t, x))}
    assert len(want) > 20 and got == want


def test_given_tables_match_brute_force_membership(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in d.overlaps(docs, bench).collect()}
    exact = {
        (r.doc_id, b.item_id) for r in docs.collect() for b in bench.collect()
        if " ".join(d._WORDS(b.text.lower())) in " ".join(d._WORDS((r.text or "").lower()))
    }
    assert exact and exact <= got


def test_odd_rows(spark):
    item = " ".join(f"v{i}" for i in range(24))
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, item, 1), (3, item, 1), (3, item, 1), (4, "pad " * 40_000 + item, 1)],
        "doc_id long, text string, seed int",
    )
    bench = spark.createDataFrame([(7, item, 2), (7, item, 2), (8, None, 2), (9, "v1 v2", 2)], "item_id long, text string, at int")
    got = sorted(d.overlaps(docs, bench).collect(), key=str)
    assert {(r.doc_id, r.item_id, r.n_equal) for r in got} == {(None, 7, 20), (3, 7, 20), (4, 7, 20)} and len(got) == 3
    assert d.overlaps(docs, bench.limit(0)).count() == d.overlaps(docs.limit(0), bench).count() == 0
    keyed = docs.selectExpr("*", "monotonically_increasing_id() as k")
    assert sorted(r.doc_id for r in d.clean(keyed, bench, "k").collect()) == [1, 2]


def test_words_are_hashed_together_and_as_the_expression_finds_them(monkeypatch):
    """Seeding must cost a few array operations per run of texts, not per text or word."""
    texts = ["", "a", "İstanbul ΣΑΣ _x_y_ ²½ \ud800 nul\0nul", "one two\nthree four", "é" * 5000, "w1 w2 w3 w4 w5 " * 300]
    texts = [t.lower() for t in texts]
    monkeypatch.setattr(d, "CHUNK", 1000)
    seeds, known = d.Seeds(), {}
    for text in [*texts, "\n".join(texts)]:
        starts, ends, hashes = seeds.words(text)
        words = [text[i:j] for i, j in zip(starts, ends)]
        assert words == d._WORDS(text)
        for word, value in zip(words, hashes.tolist()):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    assert [texts[i:j] for i, j in d._groups(texts)] == [texts[:4], texts[4:5], texts[5:]]
    monkeypatch.setattr(d, "CHUNK", 1 << 17)
    pieces, piece = [], d.Seeds._piece
    monkeypatch.setattr(d.Seeds, "_piece", lambda *a: pieces.append(1) or piece(*a))
    short = [" ".join(f"v{i + j}" for j in range(i % 9)) for i in range(2000)]
    got = [row for i, j in d._groups(short) for found in d._hits(d.Seeds(), short[i:j], None) for row in zip(*found)]
    assert len(pieces) == 1
    want = sorted((i, at) for i in range(2000) for m in d.MASKS for at in range(i % 9 - m[-1]) if i % 9 >= d.SHORTEST)
    assert sorted((int(r[0]), int(r[2])) for r in got) == want
    assert all(r[3] == r[0] % 9 and r[4] == short[r[0]] and r[5] == r[2] for r in got)
