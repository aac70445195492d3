"""Whitening against a direct eigendecomposition of exact covariances."""

from __future__ import annotations

import math

import numpy as np
import pytest

from trailspark.llm.whitening import Spectrum, merged, partial_spectra, rank_one, secular_roots, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d)) * np.linspace(2, 0.1, d) + rng.normal(size=d)


def brute(rows, k=4):
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v, *_ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    if not d:
        return {}
    kept = [(i, tuple([math.floor(256 * c) for c in v] + [0] * (d - len(v)))) for i, v in kept]
    fit = np.array(sorted({x for _, x in kept}), np.int64).reshape(-1, d)
    n = len(fit)
    s = fit.sum(axis=0)
    z = fit - s / n
    values, basis = np.linalg.eigh(z.T @ z / n)
    out = {}
    for i, x in kept:
        away = sum((n * a - b) ** 2 for a, b in zip(x, s.tolist(), strict=True))
        for c in range(min(k, d)):
            e = values[-1 - c]
            if e > 1e-9 * values[-1] > 0:
                w = (np.array(x) - s / n) @ basis[:, -1 - c] / math.sqrt(e)
                out.setdefault((i, c + 1), []).append((n, away, w, e / values.sum()))
    return out


def assert_matches(got, expected):
    assert len(got) == sum(map(len, expected.values()))
    signs = {}
    for r in got:
        n, away, w, share = expected[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, away)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert r["identity_error"] < 1e-9
        assert abs(r["whitened"]) == pytest.approx(abs(w), abs=1e-8)
        if abs(w) > 1e-6:
            signs.setdefault(r["component"], set()).add(r["whitened"] * w > 0)
    assert all(len(x) == 1 for x in signs.values())


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_secular_roots(d):
    rng = np.random.default_rng(d)
    for scale in (1, 1e-7, 1e7):
        poles = np.sort(rng.normal(size=d)) * rng.choice([1, 100])
        z = rng.normal(size=d) * scale
        z[rng.random(d) < 0.2] *= 1e-3
        origin, offset = secular_roots(poles, z, 0.7)
        expected = np.linalg.eigvalsh(np.diag(poles) + 0.7 * np.outer(z, z))
        top = np.abs(expected).max()
        assert np.allclose(poles[origin] + offset, expected, rtol=1e-12, atol=1e-13 * top)


def test_updates_with_ties_and_untouched_components():
    rng = np.random.default_rng(9)
    basis = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    values = np.array([0, 0, 0, 1, 1, 1, 1, 2, 3, 3 + 1e-15, 5, 8.0])
    for v in (basis[:, 3] * 2, basis[:, 0] + basis[:, 4] + basis[:, 5], rng.normal(size=12), np.zeros(12)):
        got, vecs = rank_one(values, basis, v, 1.5)
        full = basis @ np.diag(values) @ basis.T + 1.5 * np.outer(v, v)
        assert np.allclose(vecs.T @ vecs, np.eye(12), atol=1e-13)
        assert np.allclose(vecs @ np.diag(got) @ vecs.T, full, atol=1e-12)


def test_folding_and_merging_give_the_scatter():
    x = np.floor(256 * vectors(300, 10, 4)).astype(np.int64)
    whole, parts = Spectrum(10), [Spectrum(10) for _ in range(3)]
    for i, row in enumerate(x):
        whole.add(row)
        parts[i % 3].add(row)
    for p in parts[1:]:
        parts[0].merge(p)
    z = x - x.mean(axis=0)
    for spec in (whole, parts[0]):
        back = spec.vectors @ np.diag(spec.values) @ spec.vectors.T
        assert spec.n == 300 and spec.s.tolist() == x.sum(axis=0).tolist()
        assert np.allclose(back, z.T @ z, rtol=1e-11, atol=1e-6)


def test_merging_over_levels(spark):
    x = np.floor(256 * vectors(200, 6, 5)).astype(np.int64)
    fit = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(7)
    got = merged(partial_spectra(fit, 6), 6, fan_in=2)
    z = x - x.mean(axis=0)
    assert got.n == 200
    assert np.allclose(got.values, np.linalg.eigvalsh(z.T @ z), rtol=1e-9)


def test_query_matches_brute_force(spark):
    v = vectors(150, 6, 1)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    rows += [(1000 + i, v[3].tolist(), 1) for i in range(30)] + [(7, v[7].tolist(), None)] * 2
    rows += [(2000, None, 1), (2001, [1.0, None] + [0.0] * 4, 1), (2002, [float("nan")] * 6, 1),
             (2003, [float("inf")] + [0.0] * 5, 1), (2004, [0.5, -0.25], 1), (2005, [], 1),
             (None, (v[0] * 3).tolist(), 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS x", "2L AS n", "'c' AS component")
    assert_matches(whiten(df).collect(), brute(rows))


@pytest.mark.parametrize("rows", [
    [], [(1, [0.5, 1.0], 0)], [(1, [0.5, 1.0], 0)] * 5, [(1, None, 0)], [(1, [], 0)],
    [(i, [i / 4, i / 2, 3.0], 0) for i in range(9)]])
def test_little_variance(spark, rows):
    assert_matches(whiten(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows))


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(1, [2.0**50, 0.0], 0), (2, [0.0, 1.0], 0)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame(
        rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: None, 2: None}
