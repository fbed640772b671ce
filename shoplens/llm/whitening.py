"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

Entries become integers on a fixed grid, and each distinct vector counts once
(the fit list).  Tasks reduce their centred rows block by block to a triangular
factor, and a tree of jobs reduces the factors to one R of dimension x dimension; the
covariance matrix is never formed, so small components keep their digits.  On
the driver, which holds only R, Householder reflections make it bidiagonal, dqds
finds the singular values to high relative accuracy, and twisted factorisations
give the directions, which the reflections carry back.

Defined cases: null vectors and those with null or non-finite entries are left
out; shorter vectors are filled up with zeros; components without variance
are left out, so a table of fewer than two distinct vectors gives no rows; rows
with repeated or null ids are whitened each; an empty table gives an empty one.
Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored
from shoplens.session import ship_package

#: Triangular factors that one task of the tree puts together.
FAN_IN = 16
#: Variance below this share of the largest counts as none.
RANK_TOLERANCE = 1e-28
_EPS = np.finfo(float).eps


# ---- numeric kernel (small dense matrices) ---------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, superdiagonal and right reflections (first index, unit vector) of a square matrix."""
    m, n = r.copy(), len(r)
    right: list[tuple[int, np.ndarray]] = []
    for k in range(n):
        v = _reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k + 1 < n:
            v = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
            right.append((k + 1, v))
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit v (or zero) for which x - 2 v (v.x) lies on the first axis."""
    scale = np.abs(x).max(initial=0.0)
    v = x / scale if scale else x.copy()
    if scale:
        v[0] += math.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
    return v


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix with diagonal ``a``, superdiagonal ``b``."""
    found: list[float] = []
    blocks = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        dmin, retries = 0.0, 0
        while q:
            n = len(q)
            if n == 1:
                found.append(sigma + q[0])
                break
            small = [k for k in range(n - 1) if e[k] <= _EPS * _EPS * (sigma + min(q[k], q[k + 1])) or e[k] < 1e-300]
            if small:  # the matrix falls apart
                k = small[-1]
                blocks.append((q[:k + 1], e[:k], sigma))
                q, e, dmin = q[k + 1:], e[k + 1:], 0.0
                continue
            if q[0] < 1e-3 * q[-1] and dmin == 0.0:  # graded the wrong way: turn round
                q, e = q[::-1], e[::-1]
            # The last pivot of the sweep before is above the smallest value and close to it.
            shift = dmin * (1 - 1e-3) / 4 ** retries if dmin and retries < 8 else 0.0
            step = _sweep(q, e, shift)
            if step is None:
                retries += 1
                continue
            q, e, dmin = step
            sigma += shift
            retries = 0
    return np.array(sorted(found, reverse=True))


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transformation; None if the shift was too large."""
    d = q[0] - shift
    if d < 0:
        return None
    least, out_q, out_e = d, [], []
    for k in range(len(e)):
        new = d + e[k]
        if new <= 0:
            new = 1e-300
        ratio = q[k + 1] / new
        out_q.append(new)
        out_e.append(e[k] * ratio)
        d = d * ratio - shift
        if d < 0:
            return None
        least = min(least, d)
    out_q.append(d)
    return out_q, out_e, least


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for the eigenvalue nearest ``value``: the stationary
    factorisation from the top and the progressive one from the bottom meet where the
    twisted pivot is smallest.  Two Rayleigh corrections follow."""
    n = len(a)
    tiny = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)) * 1e-150 + 1e-300
    a = np.where(np.abs(a) < tiny, tiny, a)
    d, low = a * a, b / a[:-1]
    z = np.zeros(n)
    for _ in range(3):
        lower, upper = np.zeros(n), np.zeros(n)
        s, p = np.zeros(n), np.zeros(n)
        s[0] = -value
        for k in range(n - 1):
            pivot = s[k] + d[k]
            pivot = pivot if pivot else tiny * tiny
            lower[k] = d[k] * low[k] / pivot
            s[k + 1] = lower[k] * low[k] * s[k] - value
        p[n - 1] = d[n - 1] - value
        for k in range(n - 2, -1, -1):
            pivot = d[k] * low[k] ** 2 + p[k + 1]
            t = d[k] / (pivot if pivot else tiny * tiny)
            upper[k] = low[k] * t
            p[k] = p[k + 1] * t - value
        gamma = s + p + value
        at = int(np.nanargmin(np.abs(gamma)))
        z = np.zeros(n)
        z[at] = 1.0
        for k in range(at - 1, -1, -1):
            z[k] = -lower[k] * z[k + 1]
        for k in range(at, n - 1):
            z[k + 1] = -upper[k] * z[k]
        norm = z @ z
        move = gamma[at] / norm
        z /= math.sqrt(norm)
        if not math.isfinite(move) or abs(move) <= 2 * _EPS * abs(value):
            break
        value += move
    return z


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of ``r`` and their right singular vectors (columns)."""
    a, b, right = bidiagonal(r)
    values = dqds(a, b)
    values = values[:count][values[:count] > RANK_TOLERANCE * (values[0] if len(values) else 0)]
    vectors = np.zeros((len(r), len(values)))
    for k, value in enumerate(values):
        z = twisted(a, b, value)
        # Close values share a plane: their vectors are made orthogonal in it.
        for j in range(k - 1, -1, -1):
            if values[j] - value > 1e-3 * values[j]:
                break
            z = z - vectors[:, j] * (vectors[:, j] @ z)
        size = np.linalg.norm(z)
        if size < 0.1:  # an equal value: any direction of what is left of its space
            z = _beside(vectors[:, :k], a, b, value)
            size = np.linalg.norm(z)
        vectors[:, k] = z / size
    for first, v in reversed(right):
        vectors[first:] -= 2 * np.outer(v, v @ vectors[first:])
    return values, vectors


def _beside(known: np.ndarray, a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """An eigenvector of B'B for a repeated ``value``, orthogonal to the columns ``known``: inverse iteration."""
    m = np.diag(a) + np.diag(b, 1)
    shifted = m.T @ m - value * (1 + 1e-13) * np.eye(len(a))
    z = np.cos(np.arange(len(a)) * 1.7 + known.shape[1])
    for _ in range(4):
        z = z - known @ (known.T @ z)
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        z = z - known @ (known.T @ z)
    return z


# ---- Spark jobs ------------------------------------------------------------

def grid_rows(df: DataFrame, id_col: str, vector_col: str, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(id, x): rows with a whole vector, entries as integers floor(scale * c) + offset."""
    c = F.col(vector_col)
    fit = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.filter(F.coalesce(fit, F.lit(False))).select(
        F.col(id_col).alias("id"), F.transform(c, lambda v: F.floor(v.cast("double") * F.lit(float(scale))) + F.lit(offset).cast("long")).alias("x"))


def filled(rows: DataFrame, size: int, offset: int = 1_000_000) -> DataFrame:
    """Vectors continued to ``size`` entries with the integer of zero."""
    more = F.array_repeat(F.lit(offset).cast("long"), F.lit(size) - F.size("x"))
    return rows.withColumn("x", F.concat("x", more))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def sums(fit: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums per dimension."""
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for b in batches:
            n += b.num_rows
            total += matrix(b.column(0), size).sum(axis=0)
        yield pa.record_batch({"d": pa.array(range(-1, size), pa.int32()), "s": pa.array([n, *total.tolist()], pa.int64())})

    got = {r.d: r.s for r in fit.select("x").mapInArrow(add, "d int, s long").groupBy("d").agg(F.sum("s").alias("s")).collect()}
    return got.get(-1, 0), np.array([got.get(k, 0) for k in range(size)], dtype=object)


def triangle(fit: DataFrame, n: int, s: np.ndarray) -> np.ndarray:
    """R of the centred rows: blocks in tasks, then a tree of tasks, one factor at the end."""
    size = len(s)
    total = s.astype(np.int64)

    def centred(b: pa.RecordBatch) -> np.ndarray:
        return (n * matrix(b.column(0), size) - total) / float(n)

    def factors(b: pa.RecordBatch) -> np.ndarray:
        return b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)

    def reduce(rows):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            r = np.zeros((0, size))
            for b in batches:
                for at in range(0, b.num_rows, 4096):
                    r = np.linalg.qr(np.vstack([r, rows(b.slice(at, 4096))]), mode="r")
            if len(r):
                yield pa.record_batch({"r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})
        return run

    level = stored(fit.select("x").mapInArrow(reduce(centred), "r array<double>"), "qr")
    count = level.count()
    while count > 1:
        parts = -(-count // FAN_IN)
        level = stored(level.repartition(parts).mapInArrow(reduce(factors), "r array<double>"), "qr")
        count = level.count()
    r = np.zeros((size, size))
    last = np.array(level.first().r).reshape(-1, size)
    r[:len(last)] = last
    return r


def projection(x: np.ndarray, n: int, s: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return (n * x - s) / float(n) @ directions


def identity_gap(fit: DataFrame, n: int, s: np.ndarray, directions: np.ndarray) -> float:
    """Largest entry, in size, of the whitened rows' covariance minus the identity."""
    size, k = directions.shape
    total = s.astype(np.int64)

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros((k + 1, k))
        for b in batches:
            w = projection(matrix(b.column(0), size), n, total, directions)
            m += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.divmod(np.arange(m.size), k)
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "m": pa.array(m.ravel(), pa.float64())})

    m = np.zeros((k + 1, k))
    for r in fit.select("x").mapInArrow(moments, "i int, j int, m double").groupBy("i", "j").agg(F.sum("m").alias("m")).collect():
        m[r.i, r.j] = r.m
    mean = m[k] / n
    return float(np.abs(m[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def deviations(centred: np.ndarray) -> list[int]:
    """Exact sums of squares of integer rows."""
    if np.abs(centred).max(initial=0) ** 2.0 * max(1, centred.shape[1]) < 2.0 ** 62:
        return (centred * centred).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in centred]


def whiten(df: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: id, component (from 1), n, deviation,
    whitened, explained and identity_error.

    The driver holds R, the sums and the directions, whose sizes depend on the
    dimension alone.  Squares beyond a 64-bit integer give a null deviation.
    """
    ship_package(df.sparkSession)
    rows = stored(grid_rows(df, id_col, vector_col), "grid")
    id_type = dict(rows.dtypes)["id"]
    schema = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    size = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = filled(rows, size)
    fit = stored(rows.select("x").distinct(), "fit")
    n, s = sums(fit, size) if size else (0, np.zeros(0, dtype=object))
    empty = df.sparkSession.createDataFrame([], schema)
    if n < 2:
        return empty
    r = triangle(fit, n, s)
    values, vectors = principal(r, components)
    if not len(values):
        return empty
    directions = vectors / np.sqrt(values / n)
    explained = values / float((r * r).sum())
    gap = identity_gap(fit, n, s, directions)
    total, k = s.astype(np.int64), len(values)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                centred = n * matrix(part.column(1), size) - total
                m = len(centred)
                deviation = [v if v < 2 ** 63 else None for v in deviations(centred)]
                yield pa.record_batch([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((centred / float(n) @ directions).ravel(), pa.float64()),
                    pa.array(np.tile(explained, m), pa.float64()), pa.array(np.full(m * k, gap), pa.float64())],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
