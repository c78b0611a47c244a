"""Whitening against numpy's eigenvalues and exact integer arithmetic."""

import math

import numpy as np
import pytest

from churnmart.llm import whitening


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q * values @ q.T


CASES = {
    "falling": symmetric([2.0**-i for i in range(40)]),
    "equal": np.eye(12) * 3,
    "cluster": symmetric([5, 5, 5, 5 - 1e-9, 5 - 1e-13, 1, 1, 0.5, 0, 0]),
    "blocks": np.kron(np.eye(4), symmetric([3, 2, 1])),
    "one": np.array([[7.0]]),
    "two": symmetric([2, 1]),
    "random": np.cov(np.random.default_rng(2).normal(size=(64, 300))),
    "large": symmetric(np.linspace(1, 1e12, 30)),
    "tiny": symmetric(np.linspace(1, 2, 30)) * 1e-200,
    "nothing": np.zeros((5, 5)),
    "low rank": symmetric([4, 3, 2] + [0] * 20),
}


@pytest.mark.parametrize("name", CASES)
def test_components_match_numpy(name):
    matrix = CASES[name]
    values, vectors = whitening.principal_components(matrix, 16)
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    want = want[want > whitening.LEAST_SHARE * np.trace(matrix)][:16]
    assert len(values) == len(want)
    size = np.abs(matrix).max() or 1
    assert np.allclose(values, want, rtol=0, atol=1e-13 * size * len(matrix))
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) <= 1e-12 * size * len(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) <= 1e-12


def test_reflections_and_sturm_counts():
    matrix = CASES["random"]
    q, diagonal, off = whitening.tridiagonal(matrix)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(q @ t @ q.T, matrix, atol=1e-13) and np.allclose(q @ q.T, np.eye(64), atol=1e-13)
    values = np.linalg.eigvalsh(matrix)
    x = np.linspace(values[0] - 0.1, values[-1] + 0.1, 77)
    assert (whitening.counts_below(diagonal, off, x) == (values[None, :] < x[:, None]).sum(axis=1)).all()


def slow(rows, k=16):
    """vec_id -> (deviation, centred x), n, values, vectors, by Python integers and numpy."""
    xs = {}
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        xs[i] = tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)
    fit = sorted(set(xs.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[a - s / n for a, s in zip(x, sums)] for x in fit])
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return xs, n, sums, values, vectors, np.trace(cov)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    xs, n, sums, values, vectors, trace = slow(rows)
    got = whitening.whiten(df).collect()
    assert len(got) == 16 * len(xs) and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    signs: dict = {}
    for r in got:
        x = xs[r.vec_id]
        assert r.n == n
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-10)
        if r.component == 1:
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        want = np.array([a - s / n for a, s in zip(x, sums)]) @ vectors[:, r.component - 1] / math.sqrt(values[r.component - 1])
        signs.setdefault(r.component, []).append((r.whitened, want))
    assert sorted(signs) == list(range(1, 17))
    for pairs in signs.values():
        a, b = np.array(pairs).T
        sign = np.sign(a @ b)
        assert np.abs(a - sign * b).max() < 1e-9


def test_copies_count_once_and_get_rows(spark):
    rng = np.random.default_rng(8)
    base = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(30)]
    copies = base + [(100 + i, base[0][1]) for i in range(500)]
    schema = "vec_id long, embedding array<double>"
    once = whitening.whiten(spark.createDataFrame(base, schema)).collect()
    many = whitening.whiten(spark.createDataFrame(copies, schema).repartition(4)).collect()
    assert len(once) == 30 * 5 and len(many) == 530 * 5 and {r.n for r in many} == {30}
    explained = {r.component: r.explained for r in once}
    assert all(r.explained == pytest.approx(explained[r.component], rel=1e-12) for r in many)
    first = {(r.component, abs(round(r.whitened, 9))) for r in many if r.vec_id == 0}
    assert {(r.component, abs(round(r.whitened, 9))) for r in many if r.vec_id >= 100} == first


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 1.0, 2.0], "a"), (2, [1.5, -1.0, 0.0], "b"), (None, [0.0, 0.0, 1.0], "c"), (2, [1.5, -1.0, 0.0], "b"),
            (4, None, ""), (5, [1.0, None, 2.0], ""), (6, [1.0, inf, 2.0], ""), (7, [nan, 1.0, 2.0], ""), (8, [], ""), (9, [1.0, 2.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string")
    got = whitening.whiten(df).collect()
    # Three vectors span two directions.
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted([(i, c) for i in (0, 1, 2, 2) for c in (1, 2)])
    assert {r.n for r in got} == {3} and got[0].identity_error < 1e-12
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for few in (df.limit(0), df.where("vec_id = 1"), df.where("vec_id = 8"), df.where("vec_id = 4")):
        out = whitening.whiten(few)
        assert out.columns == columns and out.count() == 0
    tie = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0]), (4, [2.0, 2.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id for r in whitening.whiten(tie).collect()} == {3, 4}


def test_exact_beyond_64_bits():
    x = np.array([[10**12, 3], [5, 10**12]])
    y = whitening.centred(x, 10**8, np.array([7, 10**19 // 2]))
    assert y.tolist() == [[10**20 - 7, 3 * 10**8 - 10**19 // 2], [5 * 10**8 - 7, 10**20 - 10**19 // 2]]
    assert whitening.deviations(np.array([[3, 4], [2**31 - 1, 2**31]])).tolist() == [25, (2**31 - 1) ** 2 + 2**62]
    with pytest.raises(OverflowError):
        whitening.deviations(y)
