"""Packing against the tokenizer itself: exact round trip, limits, padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from churnmart.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@pytest.mark.parametrize("text", [
    "", " ", "a", " a  b\n\n c\t", "don't I'll 12 3.5!!", "\x1c a\x1fb !\x1c!", "é ü　漢字 x", "a\r\n b \r", "😀👍🏽 é", " x \u0085y", "  lead", "trail  \n ",
])
def test_pieces_have_the_ids_of_the_whole_text(tokenizer, text, monkeypatch):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    encode = packing.ByteBpe(RANKS)
    for piece in (1 << 18, 1, 3):
        monkeypatch.setattr(packing, "PIECE", piece)
        assert np.frombuffer(encode(text), "<u4").tolist() == want


def check(rows, texts, tokenizer, limit=2048, segments=128):
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        docs.setdefault(r.doc_id, []).append(r)
    assert set(docs) == set(texts)
    for key, pieces in docs.items():
        ids = tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    lengths = []
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert len(pieces) <= segments and sum(r.length for r in pieces) <= limit
        lengths.append(sum(r.length for r in pieces))
    return lengths


def test_given_documents_round_trip(spark, folder, tokenizer):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = packing.pack(docs, RANKS).collect()
    lengths = check(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in lengths)
    assert sum(lengths) / padded > 0.98


def test_all_three_limits_hold():
    rng = random.Random(1)
    packer = packing.Packer((100, 4, 50), pool=16)
    asked = {}
    for n in range(300):
        tokens = rng.randint(1, 260)
        loss_from = rng.randint(0, tokens)
        asked[n] = tokens, loss_from
        packer.add((n, loss_from), tokens, loss_from)
    packer.finish()
    placed = dict.fromkeys(asked, 0)
    for pieces in packer.closed:
        assert sum(p[2] for p in pieces) <= 100 and len(pieces) <= 4
        assert sum(max(0, s + n - max(s, x[1])) for x, s, n in pieces) <= 50
        for x, start, n in pieces:
            placed[x[0]] += n
    assert placed == {n: t for n, (t, _) in asked.items()}


def test_short_texts_leave_no_padding(spark, tokenizer):
    rng = random.Random(4)
    texts = {n: " ".join(rng.choice(("a", "the", "of", "no")) for _ in range(rng.randint(0, 8))) for n in range(20_000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    lengths = check(packing.pack(df, RANKS).collect(), texts, tokenizer)
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in lengths)
    assert sum(lengths) > 0.99 * padded
    whole = packing.pack(df.limit(3000).coalesce(1), RANKS, max_segments=None).groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in whole) == 2048


def test_a_loss_limit_leaves_no_padding():
    packer = packing.Packer((128, 100, 50))
    for n in range(40):
        packer.add(n, 90 + n)
    packer.finish()
    lengths = [sum(p[2] for p in s) for s in packer.closed]
    assert sum(lengths) == sum(range(90, 130)) and all(n & (n - 1) == 0 for n in lengths)


def test_without_cutting_examples_stay_whole():
    packer = packing.Packer((100, 10, 100), cut=False)
    for n in (60, 40, 50, 50, 30, 30, 40):
        packer.add(n, n)
    packer.finish()
    assert sorted(sum(p[2] for p in s) for s in packer.closed) == [100, 100, 100]
    with pytest.raises(ValueError):
        packer.add("long", 101)


def test_prompts_bear_no_loss(spark):
    df = spark.createDataFrame([(1, "a question", "an answer")], "doc_id long, prompt string, text string")
    rows = packing.pack(df, RANKS, prompt_col="prompt").collect()
    assert sum(r.loss_tokens for r in rows) == 3 and sum(r.length for r in rows) == 5


def test_odd_rows(spark, tokenizer):
    rows = [(None, "no id", 1), (1, None, 1), (2, "", 1), (4, "w " * 50_000, 1), (5, "same", 1), (5, "same", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = packing.pack(df, RANKS).collect()
    check([r for r in got if r.doc_id not in (5,)], {i: t for i, t, _ in rows if i != 5}, tokenizer, segments=1000)
    assert sum(r.length for r in got if r.doc_id == 5) == 4
    assert packing.pack(df.limit(0), RANKS).count() == 0
