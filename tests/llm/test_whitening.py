import math
import random

import numpy as np
import pytest

from shoplens.llm import whitening
from shoplens.llm.whitening import dqds, principal, twisted, bidiagonal, whiten

NAN, INF = float("nan"), float("inf")


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, component string").repartition(4)


def _check(rows, got, size, components=16):
    """Against the covariance matrix of the distinct integer vectors."""
    whole = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (size - len(v)) for _, v in whole]
    fit = sorted({tuple(v) for v in x})
    n = len(fit)
    s = [sum(v[k] for v in fit) for k in range(size)]
    c = np.array([[n * v[k] - s[k] for k in range(size)] for v in fit]) / n
    values = np.linalg.eigvalsh(c.T @ c / n)[::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(whole) * k
    want = sorted((i if i is not None else -1, sum((n * v[j] - s[j]) ** 2 for j in range(size))) for (i, _), v in zip(whole, x))
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.deviation) for r in got if r.component == 1) == want
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
    return values, c


def test_equals_the_eigenvectors_of_the_covariance(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1 + j % 5) for j in range(24)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # many copies count once
    rows += [(2000, None), (2001, [NAN] * 24), (2002, [INF] + [0.0] * 23), (2003, [None] + [1.0] * 23), (None, [0.5] * 24), (3, [0.25] * 24)]
    got = whiten(_frame(spark, rows)).collect()
    values, c = _check(rows, got, 24)
    _, vectors = np.linalg.eigh(c.T @ c / len(c))
    vectors = vectors[:, ::-1][:, :16]
    x = np.floor(64 * np.float32(rows[5][1]).astype(float))
    s = {r.component: r for r in got if r.vec_id == 5}
    fit = {tuple(np.floor(64 * np.float32(v).astype(float))) for _, v in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)}
    want = (x - np.mean(sorted(fit), axis=0)) @ vectors / np.sqrt(values[:16])
    assert np.allclose(np.abs([s[k].whitened for k in range(1, 17)]), np.abs(want), rtol=1e-8, atol=1e-9)
    copies = [r.whitened for r in got if r.component == 1 and (r.vec_id == 3 or (r.vec_id or 0) >= 1000)]
    assert len(set(copies)) == 2  # the 151 copies, and the second row with id 3


def test_few_dimensions_constant_columns_and_ragged_vectors(spark):
    rows = [(1, [1.0, 5.0]), (2, [2.0, 5.0, 1.0]), (3, [4.0, 5.0]), (4, [8.0, 5.0, 0.0]), (5, [])]
    _check(rows, whiten(_frame(spark, rows)).collect(), 3)
    assert whiten(_frame(spark, [])).count() == 0
    assert whiten(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whiten(_frame(spark, [(1, []), (2, None)])).count() == 0
    got = whiten(_frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 0.0])])).collect()
    assert {(r.vec_id, r.component) for r in got} == {(1, 1), (2, 1)} and all(math.isclose(abs(r.whitened), 1) for r in got)


def test_a_tree_of_factors_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(5)]) for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check(rows, whiten(_frame(spark, rows), components=3).collect(), 5, 3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(5))
def test_dqds_is_accurate_for_small_values(seed):
    rng = np.random.default_rng(seed)
    n = 30
    a, b = np.exp(rng.normal(0, 6, n)), np.exp(rng.normal(0, 3, n - 1))
    from decimal import Decimal, getcontext
    getcontext().prec = 120
    values = dqds(a, b)
    # Product of the squared values is that of the squared diagonal, exactly; the sum is the squared norm.
    assert math.isclose(sum(math.log(v) for v in values), 2 * np.log(a).sum(), abs_tol=1e-11)
    assert math.isclose(values.sum(), (a * a).sum() + (b * b).sum(), rel_tol=1e-12)
    # Sturm counts by exact arithmetic just below and above each value.
    def below(x):
        d, count = Decimal(1), 0
        for k in range(n):
            e = Decimal(a[k]) ** 2 + (Decimal(b[k - 1]) ** 2 if k else 0) - x
            off = (Decimal(a[k - 1]) * Decimal(b[k - 1])) ** 2 / d if k else 0
            d = e - off
            count += d < 0
        return count
    for k, v in enumerate(sorted(values)):
        assert below(Decimal(v) * (1 - Decimal("1e-12"))) <= k < below(Decimal(v) * (1 + Decimal("1e-12")))


def test_twisted_vectors_and_repeated_values():
    r = np.triu(np.random.default_rng(0).normal(size=(20, 20)))
    a, b, _ = bidiagonal(r)
    m = np.diag(a) + np.diag(b, 1)
    for v in dqds(a, b):
        z = twisted(a, b, v)
        assert np.linalg.norm(m.T @ (m @ z) - v * z) < 1e-13 * dqds(a, b)[0]
    r = np.kron(np.eye(3), np.array([[2.0, 1.0], [0.0, 1.0]]))
    values, vectors = principal(r, 6)
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12) and np.allclose(r.T @ r @ vectors, vectors * values, atol=1e-12)
