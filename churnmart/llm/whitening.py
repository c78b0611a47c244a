"""Whitening of embeddings by principal components.

Vectors become integers, and each different one counts once in the fit. Sums are exact
integers; each task multiplies its centred vectors and the products are summed by a shuffle
keyed by pair of dimensions. What comes to the driver is one covariance matrix, whose size is
the square of the dimension whatever the number of rows. There Householder reflections make it
tridiagonal, Sturm counts bisect its leading eigenvalues, inverse iteration finds a vector for
each, made orthogonal to those of close eigenvalues, and the reflections are undone. The
projection is broadcast; every vector is projected where it lies.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnmart.llm.common import id_type, struct
from churnmart.session import materialize

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# Eigenvalues below this share of their sum are rounding noise: such a direction has no spread.
LEAST_SHARE = 1e-11
# Eigenvalues closer than this share of the matrix' size get their vectors orthogonalised.
CLUSTER = 1e-3

_EPS = np.finfo(float).eps
_ROWS = 4096


def tridiagonal(matrix):
    """(q, diagonal, off-diagonal) with matrix = q t q' for a symmetric matrix, by Householder reflections."""
    a, n = np.array(matrix, float), len(matrix)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        scale = np.abs(x[1:]).max(initial=0)
        if not scale:
            continue
        scale = max(scale, abs(x[0]))
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        reflections.append((k + 1, v))
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = x[0] - 2 * scale * v[0] * (v @ (x / scale))
    q = np.eye(n)
    for at, v in reversed(reflections):
        q[at:] -= 2 * np.outer(v, v @ q[at:])
    return q, np.diag(a).copy(), np.diag(a, 1).copy()


def counts_below(diagonal, off, x):
    """Sturm count: how many eigenvalues of the tridiagonal matrix are smaller than each of ``x``."""
    least = np.finfo(float).tiny / _EPS
    pivot = diagonal[0] - x
    found = (pivot < 0).astype(int)
    for d, b in zip(diagonal[1:], off):
        pivot = d - x - b * b / np.where(np.abs(pivot) < least, -least, pivot)
        found += pivot < 0
    return found


def leading_eigenvalues(diagonal, off, k):
    """The ``k`` largest eigenvalues, falling, each by bisection down to adjacent numbers or rounding."""
    n = len(diagonal)
    reach = np.concatenate((np.abs(off), [0])) + np.concatenate(([0], np.abs(off)))
    size = (np.abs(diagonal) + reach).max()
    low, high = np.full(k, (diagonal - reach).min() - size * _EPS * n), np.full(k, (diagonal + reach).max() + size * _EPS * n)
    wanted = n - np.arange(k)
    for _ in range(200):
        middle = low + (high - low) / 2
        if (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))).all() or (high - low <= _EPS * _EPS * size).all():
            break
        below = counts_below(diagonal, off, middle) >= wanted
        high, low = np.where(below, middle, high), np.where(below, low, middle)
    return low + (high - low) / 2


def _factor(diagonal, off, shift):
    """LU with row exchanges of the tridiagonal matrix less ``shift``, as a function that solves with it."""
    n = len(diagonal)
    least = _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    main, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    factors, swapped = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        if abs(main[i]) < abs(off[i]):
            swapped[i] = True
            factor = main[i] / off[i]
            main[i], up[i], up2[i], main[i + 1], up[i + 1] = (
                off[i], main[i + 1], up[i + 1], up[i] - factor * main[i + 1], -factor * up[i + 1],
            )
        else:
            main[i] = main[i] if abs(main[i]) >= least else least
            factor = off[i] / main[i]
            main[i + 1] -= factor * up[i]
        factors[i] = factor
    main[-1] = main[-1] if abs(main[-1]) >= least else least

    def solve(b):
        z = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                z[i], z[i + 1] = z[i + 1], z[i]
            z[i + 1] -= factors[i] * z[i]
        for i in range(n - 1, -1, -1):
            z[i] = (z[i] - (up[i] * z[i + 1] if i < n - 1 else 0) - (up2[i] * z[i + 2] if i < n - 2 else 0)) / main[i]
        return z

    return solve


def eigenvectors(diagonal, off, values):
    """Unit vectors (columns) for falling eigenvalues, by inverse iteration."""
    n, rng = len(diagonal), np.random.default_rng(13)
    size = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    found, cluster, shift = np.zeros((n, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            cluster = k
        # Equal eigenvalues are moved apart a little, or they would give equal vectors.
        shift = min(value, shift - 4 * _EPS * size) if k > cluster else value
        solve, z = _factor(diagonal, off, shift), rng.uniform(-1, 1, n)
        for _ in range(6):
            z = z / np.abs(z).max()
            z = solve(z)
            z = z / np.abs(z).max()
            for _ in range(2):
                z -= found[:, cluster:k] @ (found[:, cluster:k].T @ z)
            z /= np.linalg.norm(z)
        found[:, k] = z
    return found


def principal_components(matrix, k=COMPONENTS):
    """(values, vectors as columns) of the at most ``k`` leading eigenvalues that are not rounding noise."""
    n, total = len(matrix), np.trace(matrix) if len(matrix) else 0
    if not n or not total > 0:
        return np.zeros(0), np.zeros((n, 0))
    # Squares of very large or small entries would leave the range of doubles.
    scale = np.abs(matrix).max()
    q, diagonal, off = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(k, n))
    values = values[values > LEAST_SHARE * (total / scale)]
    vectors = q @ eigenvectors(diagonal, off, values)
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


def _usable(vectors: DataFrame, id_col, vector_col):
    """(id, x): vectors without NULL or non-finite entries, as integers."""
    v = F.col(f"`{vector_col}`")
    whole = F.forall(v, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return vectors.where(v.isNotNull() & whole).select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))


def _arrays(batches, column):
    """Row numbers and equally long vectors, as matrices, of the lists in ``column``."""
    for batch in batches:
        lists = batch.column(column)
        for at in range(0, batch.num_rows, _ROWS):
            some = lists.slice(at, _ROWS)
            sizes = some.value_lengths().to_numpy(zero_copy_only=False)
            values, starts = some.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes)))
            for size in np.unique(sizes):
                rows = np.nonzero(sizes == size)[0]
                whole = values.reshape(len(rows), size) if len(rows) == len(sizes) else values[starts[rows][:, None] + np.arange(size)]
                yield batch, rows + at, whole


def _sums(batches):
    """(size, dimension, rows, sum) per task; dimension -1 counts vectors without entries."""
    held: dict = {}
    for _, _, x in _arrays(batches, 0):
        rows, total = held.get(x.shape[1], (0, 0))
        held[x.shape[1]] = rows + len(x), total + x.sum(axis=0)
    for size, (rows, total) in held.items():
        n = max(size, 1)
        columns = [np.full(n, size), np.arange(n) if size else np.array([-1]), np.full(n, rows), total if size else np.array([0])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["size", "at", "n", "s"])


def centred(x, n, s):
    """``n * x - s`` as integers: exact, also beyond 64 bits."""
    reach = float(np.abs(x).max(initial=0)) * n + float(np.abs(s).max(initial=0))
    if reach < 2.0**62:
        return n * x - s
    return n * x.astype(object) - s.astype(object)


def deviations(y):
    """Sum of squares of each row of integers; raises OverflowError where it does not fit 64 bits."""
    if float(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 2.0**62:
        return (y.astype(np.int64) ** 2).sum(axis=1)
    return np.array([sum(int(c) ** 2 for c in row) for row in y], np.int64)


def _spread(n, s, project=None):
    """Task: sums of products of centred vectors, one row per pair of dimensions."""

    def run(batches):
        total = 0
        for _, _, x in _arrays(batches, 0):
            c = centred(x, n, s).astype(float) / n
            c = c if project is None else c @ project
            total = total + c.T @ c
        if not np.isscalar(total):
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (i, j, total[i, j])], ["i", "j", "part"])

    return run


def covariance(fit: DataFrame, n: int, s, project=None) -> np.ndarray:
    """Covariance (divisor ``n``) of the written vectors ``fit``, centred by ``s / n``, after projecting them."""
    parts = fit.mapInArrow(_spread(n, np.asarray(s), project), "i long, j long, part double")
    cells = parts.groupBy("i", "j").agg(F.sum("part").alias("cell")).toArrow()
    dims = len(s) if project is None else project.shape[1]
    found = np.zeros((dims, dims))
    i, j, cell = (c.to_numpy() for c in cells.columns)
    found[i, j] = found[j, i] = cell / n
    return found


def whiten(vectors: DataFrame, id_col="vec_id", vector_col="embedding", k=COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained and identity_error, up to ``k`` rows per vector.

    Rows with a NULL vector, or with a NULL or non-finite entry, take no part. Of vectors of
    several lengths those of the length most different vectors have (the larger on a tie) take
    part. Each different vector counts once in the fit, every row gets its results; repeated
    rows get equal ones. Components whose eigenvalue is less than ``LEAST_SHARE`` of all
    variance are left out: a table of one vector, of vectors without entries, or an empty one
    gives no rows. Ids may be NULL or repeated. A deviation that does not fit a long is an
    OverflowError. Other columns are not read, so their names cannot clash.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col)
    distinct = materialize(rows.select("x").distinct(), "distinct")
    sums = distinct.mapInArrow(_sums, "size long, at long, n long, s long")
    sums = materialize(sums.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "sums")
    most = sums.orderBy(F.desc("n"), F.desc("size")).first()
    out = struct(
        id=id_type(vectors, id_col), component=T.IntegerType(), n=T.LongType(), deviation=T.LongType(),
        whitened=T.DoubleType(), explained=T.DoubleType(), identity_error=T.DoubleType(),
    )
    values = np.zeros(0)
    if most is not None and most["size"]:
        n, size = most["n"], most["size"]
        # One row per dimension.
        s = np.array([r["s"] for r in sums.where(F.col("size") == size).orderBy("at").collect()], np.int64)
        fit = distinct.where(F.size("x") == size)
        matrix = covariance(fit, n, s)
        values, components = principal_components(matrix, k)
    if not len(values):
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    project = components / np.sqrt(values)
    error = float(np.abs(covariance(fit, n, s, project) - np.eye(len(values))).max())
    explained, schema = values / np.trace(matrix), to_arrow_schema(out)
    # k columns of one vector's length.
    shared = spark.sparkContext.broadcast((project, s))

    def run(batches):
        project, s = shared.value
        for batch, at, x in _arrays(batches, 1):
            y, times = centred(x, n, s), len(explained)
            columns = [
                batch.column(0).take(pa.array(np.repeat(at, times))).cast(schema.field(0).type),
                np.tile(np.arange(1, times + 1, dtype=np.int32), len(at)),
                np.full(len(at) * times, n),
                np.repeat(deviations(y), times),
                (y.astype(float) / n @ project).ravel(),
                np.tile(explained, len(at)),
                np.full(len(at) * times, error),
            ]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    return rows.where(F.size("x") == size).mapInArrow(run, out).withColumnRenamed("id", id_col)
