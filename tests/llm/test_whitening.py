import math
import random

import numpy as np
import pytest

from tonality.llm import whitening as W


def symmetric(seed, n):
    r = np.random.default_rng(seed)
    a = r.standard_normal((n, n))
    return a + a.T


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
def test_inertia_counts_equal_the_spectrum(n):
    for seed in range(20):
        a = symmetric(seed, n)
        if seed % 3 == 0:
            a[np.diag_indices(n)] = 0  # no diagonal pivot to start with
        for s in (-3.0, -0.5, 0.0, 0.7, 2.0):
            assert W.positive_pivots(a - s * np.eye(n)) == int((np.linalg.eigvalsh(a) > s).sum())


@pytest.mark.parametrize("spectrum", [
    [9, 5, 3, 1, .5, .1], [9, 9, 3, 3, 3, 1], [1, 1, 1, 1, 1, 1], [5, 0, 0, 0, 0, 0], [1 + 1e-10, 1, 1e-3, 1e-9, 0, 0], [1e30, 1e12, 1, 1, 1, 1], [0] * 6,
])
def test_leading_pairs(spectrum):
    q = np.linalg.qr(symmetric(7, 6))[0]
    v = (q * np.array(spectrum, dtype=float)) @ q.T
    v = (v + v.T) / 2
    values, vectors = W.leading_pairs(v, 4)
    want = [s for s in sorted(spectrum, reverse=True)[:4] if s > 1e-14 * max(spectrum)]
    assert np.allclose(values, want, rtol=1e-9, atol=1e-14 * max(spectrum))
    y = np.array(vectors).reshape(len(values), 6)
    assert np.allclose(y @ y.T, np.eye(len(values)), atol=1e-9)
    for e, u in zip(values, vectors):
        assert np.linalg.norm(v @ u - e * u) <= 1e-12 * max(spectrum)


def test_random_covariances_and_a_wide_one():
    for seed, n, rows in [(1, 16, 400), (2, 64, 300), (3, 64, 20), (4, 200, 900)]:
        x = np.random.default_rng(seed).standard_normal((rows, n)) * np.linspace(1, 3, n)
        v = np.cov(x.T, bias=True)
        values, vectors = W.leading_pairs(v, 4)
        e, u = np.linalg.eigh(v)
        assert np.allclose(values, e[::-1][:4], rtol=1e-12)
        assert np.allclose(np.abs(np.sum(np.array(vectors) * u.T[::-1][:4], axis=1)), 1, atol=1e-9)


def brute(rows, k=4):
    """The contract in plain Python and numpy: (vec_id, component) -> n, deviation, |whitened|, explained."""
    use = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in use})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    z = np.array(fit, dtype=float) - np.array(s) / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u.T[::-1][:k]
    out = []
    for i, x in use:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        for c in range(k):
            out.append((i, c + 1, n, dev, abs(float((np.array(x) - np.array(s) / n) @ u[c]) / e[c] ** .5), e[c] / np.trace(v)))
    return out


def test_query_equals_brute_force_with_odd_rows(spark):
    r = random.Random(2)
    vec = lambda: [r.gauss(0, 1 + j) for j in range(6)]
    rows = [(i, vec()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # copies count once
    rows += [(i % 5, [c + 1e-9 for c in rows[3][1]]) for i in range(7)]
    odd = [(None, rows[1][1]), (2001, None), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [math.nan] * 6), (2004, [math.inf] + [0.0] * 5), (2005, [-0.0] * 6)]
    other = [(3000, [1.0, 2.0]), (3001, [])]  # not the commonest length: no row
    df = spark.createDataFrame([(*x, 1.0, 2) for x in rows + odd + other], "vec_id long, embedding array<double>, whitened double, dim int").repartition(5)
    got = W.whiten(df).collect()
    want = brute(rows + odd)
    key = lambda x: (x[0] is None, x[0] or 0, x[3], x[1])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([abs(g[4]) for g in got], [w[4] for w in want], atol=1e-9)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    assert {g[6] for g in got} == {got[0][6]} and got[0][6] < 1e-9


def test_same_sign_for_all_rows(spark):
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 5 - j) for j in range(5)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {(x["vec_id"], x["component"]): x["whitened"] for x in W.whiten(df).collect()}
    m = np.array([[got[i, c] for c in range(1, 5)] for i in range(200)])
    assert np.abs(m.T @ m / 200 - np.eye(4)).max() < 1e-9


def test_degenerate_tables(spark):
    shape = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert W.whiten(spark.createDataFrame(rows, shape)).collect() == []
    got = W.whiten(spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 3.0])], shape)).collect()  # rank one
    assert [(x["vec_id"], x["component"], round(abs(x["whitened"]), 9)) for x in sorted(got)] == [(1, 1, 1.0), (2, 1, 1.0)]


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(1, [3e15, 1.0]), (2, [1e15, 0.0]), (3, [1e308, -1e308]), (4, [1e-320, 5.0])]
    got = {x["vec_id"]: x["deviation"] for x in W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None}
    rows = [(1, [3e5, 1.0]), (2, [1e5, 0.0]), (3, [-7e4, -1e3])]
    want = {w[0]: w[3] for w in brute(rows, 2)}
    assert {x["vec_id"]: x["deviation"] for x in W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()} == want
