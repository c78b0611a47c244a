"""SimHash groups against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from churnmart.llm import simhash
from churnmart.llm.common import with_row_key
from churnmart.llm.components import connected_components


def slow_fingerprint(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", " \t ", "One", "a b c", "a b c d", "A B\x0bc\x0cD e f Été", "x y " * 90])
def test_fingerprint_of_one_text(text):
    assert simhash.fingerprint_of(text) == slow_fingerprint(text)


def test_golay_code_covers_all_words_within_three():
    words = simhash.golay_words()
    probe = np.random.default_rng(1).integers(0, 1 << 23, 20_000).astype(np.uint32)
    near = np.bitwise_count(probe[:, None] ^ words[None, :]).min(axis=1)
    assert len(set(words.tolist())) == 4096 and near.max() == 3


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4, unique=True))
def test_linked_fingerprints_share_an_anchor(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    row, anchor = simhash.anchors_of(np.array([fp, other], np.uint64))
    assert set(anchor[row == 0]) & set(anchor[row == 1])


def test_bucket_links_keep_components():
    rng = np.random.default_rng(5)
    prints = np.unique(np.array([1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 40, (60, 2))], np.uint64))
    links = simhash.bucket_links(prints, 2)
    assert len(links) < len(prints)
    want = slow_components([int(p) for p in prints], 2)
    number = {int(p): i for i, p in enumerate(prints)}
    root = list(range(len(prints)))
    for _ in prints:
        for a, b in links:
            i, j = number[int(a)], number[int(b)]
            root[i] = root[j] = min(root[i], root[j])
    assert len(set(root)) == len(set(want))


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (500, 500), (None, 3)]
    got = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    roots = slow_components(prints)
    for row, fp, root in zip(rows, prints, roots):
        assert got[row.doc_id].fingerprint == f"{fp:016x}"
        assert got[row.doc_id].component_id == min(r.doc_id for r, other in zip(rows, roots) if other == root)
    assert len(got) == len(rows)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "  ", "z"), (4, "one two three", "x"), (4, "one two three", "x"), (None, "far away from all this text", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(simhash.near_duplicates(df).collect(), key=str)
    assert len(got) == 6
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.keep_one(with_row_key(df, "key", "t"), "key").collect()
    assert sorted(r.text or "" for r in kept) == ["", "far away from all this text", "one two three"]


def dense_prints(n, seed):
    """Fingerprints that differ from one pattern in a few of 24 bits: all lie around the same anchors."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(0, 2**63))
    some = np.array([np.bitwise_xor.reduce([1 << int(b) for b in rng.choice(24, rng.integers(1, 9), replace=False)]) for _ in range(n)], np.uint64)
    return np.unique(some ^ np.uint64(base))


@pytest.mark.parametrize("blocks", simhash.BLOCKS)
def test_linked_fingerprints_agree_under_a_choice_of_blocks(blocks):
    rng = np.random.default_rng(2)
    for _ in range(20):
        fp, flips = int(rng.integers(0, 2**63)), rng.choice(64, 4, replace=False)
        other = fp ^ sum(1 << int(b) for b in flips)
        assert any(bits[0] == bits[1] for _, bits in simhash.pieces_of(np.array([fp, other], np.uint64), blocks))
    left = {64 - int(np.bitwise_count(bits[0])) for _, bits in simhash.pieces_of(np.array([2**64 - 1], np.uint64), blocks)}
    assert left == {64 // blocks * simhash.DISTANCE} and (blocks != simhash.BLOCKS[-1] or 1 << left.pop() == simhash.MOST)


@pytest.mark.parametrize("rows", [1, 3, 7, 1000])
def test_buckets_over_batches(rows):
    import pyarrow as pa

    prints = dense_prints(120, 4)
    anchor = np.sort(np.random.default_rng(0).integers(0, 9, len(prints)))
    anchor[40:100] = anchor[40]
    anchor.sort()
    whole = pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(prints.view(np.int64))], ["anchor", "fp"])
    for most in (0, 2, 8, 59, 10**6):
        out = [b for b in simhash._compare(1, most)(whole.slice(i, rows) for i in range(0, len(prints), rows))]
        got = [(a, b) for batch in out for a, b in zip(*(c.to_pylist() for c in batch.columns))]
        sizes = {a: int((anchor == a).sum()) for a in set(anchor.tolist())}
        want = sorted(int(p) for p, a in zip(prints.view(np.int64), anchor) if sizes[a] > most)
        assert sorted(a for a, b in got if b is None) == want
        links = {(int(np.int64(x).view(np.int64)), int(np.int64(y).view(np.int64))) for a in sizes if sizes[a] <= most
                 for x, y in np.array(simhash.bucket_links(prints[anchor == a]), np.uint64).reshape(-1, 2).view(np.int64)}
        assert {(a, b) for a, b in got if b is not None} == links


@pytest.mark.parametrize("most", [0, 3, 20])
def test_crowded_anchors_lose_no_link(spark, most):
    prints = np.unique(np.concatenate((dense_prints(60, 1), dense_prints(8, 2), np.random.default_rng(9).integers(0, 2**63, 10).astype(np.uint64))))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    got = {r.node: r.root for r in connected_components(simhash.links_between(frame, most)).collect()}
    want = slow_components([int(p) for p in prints])
    signed = [int(p) for p in prints.view(np.int64)]
    for i, p in enumerate(signed):
        mates = [q for q, root in zip(signed, want) if root == want[i]]
        assert got.get(p, p) == min(mates)
    assert len(set(want)) < len(prints)
