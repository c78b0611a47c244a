"""PPM code lengths against a plain version with dictionaries, and held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from churnmart.llm import langid

TEXTS = {
    "a": ["the cat sat on the mat", "then the hat", "", "\x00 zero", "é€"],
    "b": ["der hund und die katze", "die mäuse", "un chien"],
    "c": ["zzzz", "zz"],
}


def slow_counts(texts):
    """Count of each (context, byte), contexts of 0 to DEPTH bytes."""
    counts: dict = {}
    for text in texts:
        padded = bytes(langid.DEPTH) + text.encode()
        for at in range(langid.DEPTH, len(padded)):
            for d in range(langid.DEPTH + 1):
                counts.setdefault(padded[at - d : at], Counter())[padded[at]] += 1
    return counts


def slow_bits(counts, before: bytes, byte: int):
    bits, ruled_out = 0.0, set()
    for d in range(langid.DEPTH, -1, -1):
        seen = counts.get(before[len(before) - d :])
        if not seen:
            continue
        left = {b: n for b, n in seen.items() if b not in ruled_out}
        escape = 0 if len(seen) == 256 else len(left)
        total = sum(left.values()) + escape
        if byte in left:
            return bits + math.log2(total / left[byte])
        if left:
            bits += math.log2(total / escape)
        ruled_out |= set(seen)
    return bits + math.log2(256 - len(ruled_out))


def trees_of(texts):
    rows = []
    for number, lang in enumerate(sorted(texts)):
        for context, seen in slow_counts(texts[lang]).items():
            rows += [(number, len(context), int.from_bytes(context + bytes([b]), "big"), n) for b, n in seen.items()]
    lang, depth, code, n = map(np.array, zip(*rows))
    return langid.Trees(sorted(texts), lang, depth, code.astype(np.uint64), n)


def test_code_lengths_match_a_plain_version():
    trees = trees_of(TEXTS)
    probe = ["the cat", "die katze", "zzz the", "qqq", "", "é€ \x00\x00\x00\x00a", "thx then\n"]
    got = trees.code_lengths([t.encode() for t in probe])
    for text, row in zip(probe, got):
        padded = bytes(langid.DEPTH) + text.encode()
        for lang, bits in zip(sorted(TEXTS), row):
            counts = slow_counts(TEXTS[lang])
            want = sum(slow_bits(counts, padded[i - langid.DEPTH : i], padded[i]) for i in range(langid.DEPTH, len(padded)))
            assert bits == pytest.approx(want, rel=1e-5, abs=1e-5)


@pytest.mark.parametrize("before", [b"\0\0\0\0", b" the", b"xqzz", b"ie k", b"\xff\0\0t"])
def test_probabilities_of_all_bytes_add_up_to_one(before):
    codes = np.array([int.from_bytes(before + bytes([b]), "big") for b in range(256)], np.uint64)
    lengths = trees_of(TEXTS).lengths(codes)
    assert np.exp2(-lengths).sum(axis=0) == pytest.approx([1, 1, 1], abs=1e-5)


def test_all_256_bytes_seen():
    everything = {"a": [], "b": ["x"]}
    rows = [(0, 0, b, 1) for b in range(256)] + [(1, 0, 120, 5)]
    lang, depth, code, n = map(np.array, zip(*rows))
    trees = langid.Trees(sorted(everything), lang, depth, code.astype(np.uint64), n)
    assert trees.lengths(np.array([7], np.uint64))[0] == pytest.approx([8, math.log2(6) + math.log2(255)], rel=1e-5)


def test_long_texts_are_cut_without_a_seam(monkeypatch):
    trees, text = trees_of(TEXTS), ("the cat and die katze zz " * 400).encode()
    whole = trees.code_lengths([text, b"", text[:100]])
    monkeypatch.setattr(langid, "chunks", lambda texts, size=37, cut=langid.chunks: cut(texts, size))
    assert trees.code_lengths([text, b"", text[:100]]) == pytest.approx(whole, rel=1e-6)


def test_counts_match_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(langid, "_HELD", 8)
    rows = [(lang, t) for lang, texts in TEXTS.items() for t in texts * 3]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "cast(text as binary) text")
    got = {(r.lang, r.depth, r.code): r.n for r in langid.context_counts(df.repartition(3)).collect()}
    want = {}
    for lang, texts in TEXTS.items():
        for context, seen in slow_counts(texts * 3).items():
            want |= {(lang, len(context), int.from_bytes(context + bytes([b]), "big")): n for b, n in seen.items()}
    assert got == want


def test_known_and_unknown_codes():
    rng = np.random.default_rng(3)
    known = np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    table = langid.Codes(known)
    assert (table.find(known) == np.arange(len(known))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000).astype(np.uint64), known)
    assert (table.find(other) == -1).all() and (langid.Codes(known[:0]).find(other) == -1).all()


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in docs.select("doc_id", "text", "lang").collect()}
    got = langid.predict(docs).collect()
    assert len(got) == len(rows)
    kept = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    right = sum(r.lang_pred == rows[r.doc_id].lang for r in kept)
    assert len(kept) > 150 and right >= 0.98 * len(kept)


def test_nothing_is_learnt_from_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(string(doc_id) as binary)) % 5 = 0, 'xx', lang) lang")
    assert sorted(langid.predict(docs).collect()) == sorted(langid.predict(other).collect())


def test_small_trees_keep_the_most_frequent(spark, monkeypatch):
    monkeypatch.setattr(langid, "TREE_ENTRIES", 40)
    rows = [(i, t, lang) for lang, texts in TEXTS.items() for i, t in enumerate(texts * 9)]
    trees = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for d in range(langid.DEPTH + 1):
        assert (~np.isnan(trees._counts[d])).sum() <= 40 * 3
    codes = np.array([int.from_bytes(b" the" + bytes([b]), "big") for b in range(256)], np.uint64)
    assert np.exp2(-trees.lengths(codes)).sum(axis=0) == pytest.approx([1, 1, 1], abs=1e-5)


def test_odd_rows(spark):
    ids = [i for i in range(100) if not held_out(i)]
    rows = [(ids[0], "the cat sat", "en", "x"), (ids[1], "der hund saß", "de", "x"), (ids[1], "der hund saß", "de", "x"),
            (ids[2], None, "fr", "x"), (ids[3], "the hat", None, "x"), (None, "the cat", "zz", "x"), (ids[4], "", "en", "x"),
            (ids[5], "12 34 !", "en", "x"), (ids[6], "hund " * 100_000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = sorted(((r.doc_id, r.held_out, r.lang_pred) for r in langid.predict(docs).collect()), key=str)
    want = [(ids[0], False, "en"), (ids[1], False, "de"), (ids[1], False, "de"), (ids[2], False, "und"), (ids[3], False, "en"),
            (None, False, "en"), (ids[4], False, "und"), (ids[5], False, "und"), (ids[6], False, "de")]
    assert got == sorted(want, key=str)
    assert langid.predict(docs.limit(0)).count() == 0
    unknown = langid.predict(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}
    tie = spark.createDataFrame([(ids[0], "same", "b"), (ids[1], "same", "a")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.predict(tie).collect()} == {("a", 0.5)}
