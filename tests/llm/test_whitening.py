"""Whitening against a dense eigendecomposition of the covariance."""

import math

import numpy as np
import pytest

from evimap.llm import whitening as W


def vectors(n, dim, seed, scale=lambda i: 1 / (1 + i)):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, dim)) @ np.diag([scale(i) for i in range(dim)]) @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]


@pytest.mark.parametrize("dim, scale", [(64, lambda i: 1 / (1 + i)), (64, lambda i: 0.2), (3, lambda i: 1.0), (20, lambda i: 1.0 if i < 5 else 0.0)], ids=["falling", "level", "few", "rank 5 of 20"])
def test_against_dense(spark, dim, scale):
    v = vectors(3000, dim, 3, scale)
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)] + [(7, v[7].tolist(), 1), (None, v[8].tolist(), 1), (5000, v[9].tolist(), 1)] * 400
    rows += [(6000, None, 1), (6001, [math.nan] * dim, 1), (6002, [math.inf] + [0.0] * (dim - 1), 1), (6003, [None] * dim, 1), (6004, [], 1), (6005, [1.0] * (dim + 1), 1), (6006, [1e300] * dim, 1)]
    got = W.whitened(spark.createDataFrame(rows, "vec_id long, v array<double>, component int").repartition(5), "vec_id", "v").collect()
    x = np.unique(np.floor(64 * v).astype(np.int64) + 1_000_000, axis=0)
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    size = min(16, dim, int((e > 1e-12 * e.sum()).sum()))
    assert len(got) == 4200 * size
    by = {(r.vec_id, r.component): r for r in got}
    sign = {}
    gaps = [min(abs(e[j] - e[i]) for i in range(dim) if i != j) / e[0] for j in range(size)]
    for i in range(0, 3000, 17):
        here = x[0] * 0 + np.floor(64 * v[i]).astype(np.int64) + 1_000_000
        for j in range(size):
            r, want = by[i, j + 1], float(((n * here - s) / n) @ u[:, j] / math.sqrt(e[j]))
            assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(here, s))
            assert abs(r.explained - e[j] / e.sum()) <= 1e-9 * e[j] / e.sum() and r.identity_error <= 1e-8
            if j not in sign and abs(want) > 0.1:
                sign[j] = math.copysign(1, want * r.whitened)
            if j in sign:
                assert abs(sign[j] * r.whitened - want) <= 1e-10 / gaps[j] + 1e-9


def test_filter_finds_close_and_repeated_eigenvalues():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    for e in (np.sort(rng.uniform(0.9, 1.1, 90))[::-1], np.array([3.0] * 40 + [1.0] * 50), np.array([5.0, 5.0, 4.0] + [0.0] * 87)):
        v, passes = (q * e) @ q.T, [0]

        def product(m, v=v, passes=passes):
            passes[0] += 1
            return v @ m

        found, u, away = W.eigenpairs(product, 90, 16)
        assert np.abs(found - e[:16]).max() <= 1e-11 and away.max() <= 1e-10 * e[0] and np.abs(u.T @ u - np.eye(16)).max() < 1e-12
        assert passes[0] <= 250


def test_one_vector_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, v array<float>")
    assert W.whitened(df, "vec_id", "v").collect() == [] == W.whitened(df.limit(0), "vec_id", "v").collect()


def test_large_numbers_stay_exact():
    x = np.array([[1 << 50, 5], [-(1 << 50), 7]])
    assert W.centred(x, 1 << 20, [3, 12]).tolist() == [[(1 << 70) - 3, (5 << 20) - 12], [-(1 << 70) - 3, (7 << 20) - 12]]
