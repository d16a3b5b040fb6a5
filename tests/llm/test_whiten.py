"""Whitening against NumPy's eigenvalues of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest

from brakelight.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, id string, x string, n string"


def fixture(d=6, n=400, seed=3):
    rng = np.random.default_rng(seed)
    v = (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) * 2).astype(np.float32)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    return rows + [(i, r) for i, r in rows[:40]] * 5 + [(None, rows[7][1])] * 3


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(parts)


def expected(rows, k):
    x = {i: [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in r] for i, r in rows}
    fit = sorted({tuple(r) for r in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(a - Fraction(s, n)) for a, s in zip(r, sums)] for r in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {i: (sum((n * a - s) ** 2 for a, s in zip(r, sums)),
               np.array([float(a - Fraction(s, n)) for a, s in zip(r, sums)]) @ u / np.sqrt(e)) for i, r in x.items()}
    return n, e / np.trace(centred.T @ centred / n), out


@pytest.mark.parametrize("parts", [1, 7])
def test_whitened_rows_match_numpy(spark, parts):
    rows = fixture()
    bad = [(1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [float("nan")] * 6), (1004, [float("inf")] * 6),
           (1005, [1.0, 2.0])]
    got = whiten.whiten(frame(spark, rows + bad, parts), components=4).collect()
    n, share, want = expected(rows, 4)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    signs = {}
    for r in got:
        dev, y = want[r.vec_id]
        assert r.deviation == dev and abs(r.explained - share[r.component - 1]) < 1e-12 and r.identity_error < 1e-10
        signs.setdefault(r.component, np.sign(r.whitened * y[r.component - 1]))
        assert abs(r.whitened * signs[r.component] - y[r.component - 1]) < 1e-9


def test_degenerate_tables(spark):
    one = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    assert whiten.whiten(frame(spark, one)).collect() == []
    assert whiten.whiten(frame(spark, [])).collect() == []
    assert whiten.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    # one direction of variance: a single component; huge entries: a deviation beyond a long is null
    got = whiten.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, [1e30, 2.0])])).collect()
    assert {r.component for r in got} == {1} and all(r.deviation is None for r in got)
    assert np.isfinite([r.whitened for r in got]).all()


@pytest.mark.parametrize("seed", range(6))
def test_slices_match_numpy_also_for_repeated_and_close_eigenvalues(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(2, 40))
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    e = np.sort(rng.random(d))[::-1]
    if seed % 2:
        e[: d // 2] = e[0]  # a cluster
        e[-1] = 0.0
    if seed == 4:
        e = 1 + np.arange(d)[::-1] * 1e-9
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    for shift in (0.1, 0.5, 0.9):
        assert whiten.inertia(a, shift) == int((np.linalg.eigvalsh(a) > shift).sum())
    values, vectors = whiten.Slices(a).leading(16)
    k = len(values)
    assert k == min(16, int((e > 1e-12).sum())) and np.allclose(values, e[:k], rtol=1e-12, atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12
