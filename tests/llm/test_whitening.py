from __future__ import annotations

import math

import numpy as np
import pytest

from tripflow.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<float>, n long, component string, whitened double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 0.5) for i, v in rows], SCHEMA).repartition(3)


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(width, width)) * 0.1 * np.linspace(0.05, 1.0, width)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(n, width)) @ mix + 0.3)]


AWKWARD = [(900, None), (901, []), (902, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (903, [float("nan")] * 6),
           (904, [float("inf")] * 6), (905, [1.0]), (906, [1e30] * 6)]


def brute(rows, width):
    """Exact sums and deviations in whole numbers; covariance, eigenpairs and whitening by numpy."""
    ok = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in rows
          if v and len(v) == width and all(c is not None and math.isfinite(c) and abs(c) < 1e15 for c in v)]
    n = len(ok)
    s = [sum(x[d] for _, x in ok) for d in range(width)]
    dev = [(i, sum((n * x - t) ** 2 for x, t in zip(v, s, strict=True))) for i, v in ok]
    y = np.array([[(n * x - t) / n for x, t in zip(v, s, strict=True)] for _, v in ok])
    e, u = np.linalg.eigh(y.T @ y / n)
    return n, dev, y, e[::-1], u.T[::-1]


@pytest.mark.parametrize("n,width,seed", [(300, 6, 1), (50, 40, 2), (9, 12, 3)])
def test_equals_brute_force(spark, n, width, seed):
    rows = vectors(n, width, seed)
    rows += rows[:7] + AWKWARD + [(None, rows[0][1])]
    got = whitening.whiten(frame(spark, rows)).collect()
    total, dev, y, values, basis = brute(rows, width)
    k = min(32, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == total * k
    assert {r.n for r in got} == {total}
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted({(r.vec_id, r.deviation) for r in got}, key=order) == sorted(set(dev), key=order)
    for j in range(k):
        own = [r for r in got if r.component == j + 1]
        assert own[0].explained == pytest.approx(values[j] / values.sum(), rel=1e-9)
        want = y @ basis[j] / math.sqrt(values[j])
        by_id = {}
        for (i, _), x in zip(dev, want, strict=True):
            by_id[i] = x
        sign = np.sign(sum(by_id[r.vec_id] * r.whitened for r in own))
        assert max(abs(by_id[r.vec_id] * sign - r.whitened) for r in own) < 1e-6
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-7


def test_equal_single_and_no_vectors(spark):
    for rows in ([], [(1, [0.1, 0.2])], [(i, [0.1, 0.2]) for i in range(5)], AWKWARD[:1], [(1, []), (2, [])]):
        df = whitening.whiten(frame(spark, rows))
        assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert df.count() == 0


def test_constant_dimensions_are_no_components(spark):
    rows = [(i, [float(i % 7), 3.0, float(i * i % 11), 3.0]) for i in range(60)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and sum({r.explained for r in got}) == pytest.approx(1)


def test_large_deviations_are_exact():
    c = whitening.Centre(3, (30_000_000_000, 3_000_000_001))
    x = np.array([[10_000_000_900, 1_000_000_007], [9_000_000_000, 1]])
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(v, c.sums, strict=True)) for v in x]
    assert c.deviations(x) == [v if v < 1 << 63 else None for v in want] and want[1] >= 1 << 62


@pytest.mark.parametrize("matrix", [
    np.eye(20), np.ones((20, 20)), np.diag(np.arange(20.0)), np.array([[2.0]]), np.array([[1.0, 2.0], [2.0, 1.0]]),
    np.diag([5.0] * 6 + [5 - 1e-12] * 6 + [1e-9] * 8)])
def test_eigenpairs_of_clustered_matrices(matrix):
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=matrix.shape))
    for a in (matrix, q @ matrix @ q.T):
        values, basis = eigen.leading(a, 12)
        want = np.linalg.eigvalsh(a)[::-1][:12]
        norm = np.abs(a).max()
        assert np.abs(values - want).max() < 1e-13 * len(a) * norm
        assert np.abs(a @ basis.T - basis.T * values).max() < 1e-13 * len(a) * norm
        assert np.abs(basis @ basis.T - np.eye(len(basis))).max() < 1e-12


def test_sturm_counts():
    d, e = np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.5, 0.0, 0.25])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.concatenate([values - 1e-6, values + 1e-6])
    assert list(eigen.below(d, e, at)) == [int((values < x).sum()) for x in at]
