"""Operator 11 against numpy's eigen-decomposition of the exact covariance."""
from fractions import Fraction

import numpy as np
import pytest

from voltcube.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors):
    """{row index: (deviation, whitened by component)}, eigenvalue shares; x as whole numbers, centred as fractions."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    mean = [Fraction(t, n) for t in s]
    y = np.array([[float(a - m) for a, m in zip(r, mean)] for r in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    return [sum((n * a - t) ** 2 for a, t in zip(r, s)) for r in x], y @ q[:, :8] / np.sqrt(e[:8]), e / e.sum()


def by_row(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


@pytest.mark.parametrize("shift", [0.0, 900.0])
def test_equals_brute_force(spark, shift):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 12)) * np.linspace(4, 0.5, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0] + shift
    got = by_row(whitening.whiten(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], SCHEMA).repartition(5)))
    deviation, white, share = brute(x.tolist())
    assert len(got) == 300
    for c in range(8):
        mine = np.array([got[i][c + 1].whitened for i in range(300)])
        assert min(np.abs(mine - white[:, c]).max(), np.abs(mine + white[:, c]).max()) < 1e-8
        assert abs(got[0][c + 1].explained - share[c]) < 1e-12
    assert all(int(got[i][1].deviation) == deviation[i] and got[i][1].n == 300 for i in range(300))
    assert got[0][1].identity_error < 1e-9


def test_what_takes_part(spark):
    good = [(1, [1.0, 2.0]), (1, [3.0, -1.0]), (None, [0.0, 0.0]), (4, [0.0, 0.0])]
    bad = [(5, None), (6, []), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 0.0]), (10, [1.0, 2.0, 3.0]), (11, [1e300, 0.0])]
    df = spark.createDataFrame([(i, v, 0.5) for i, v in good + bad], SCHEMA + ", whitened double")
    rows = whitening.whiten(df).collect()
    deviation = brute([v for _, v in good])[0]
    assert sorted((r.vec_id or 0, int(r.deviation)) for r in rows if r.component == 1) == sorted((i or 0, d) for (i, _), d in zip(good, deviation))
    assert {r.n for r in rows} == {4} and {r.component for r in rows} == {1, 2}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    df = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert df.collect() == [] and df.columns[:3] == ["vec_id", "component", "n"]


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i % 3)]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert {r.component for r in got.collect()} == {1, 2}
    assert got.first().identity_error < 1e-9


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2 ** 40 + i), float(-(2 ** 41) * (i % 2))]) for i in range(9)]
    got = by_row(whitening.whiten(spark.createDataFrame(rows, SCHEMA)))
    assert [int(got[i][1].deviation) for i in range(9)] == brute([v for _, v in rows])[0]


def test_factor_and_rotation():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(40, 9))
    a[:, 8] = a[:, 0] + a[:, 1]
    m = a.T @ a
    f = whitening.pivoted_cholesky(m)
    assert f.shape == (9, 8) and np.allclose(f @ f.T, m)
    e, q = whitening.one_sided_jacobi(f)
    assert np.allclose(e, np.linalg.eigvalsh(m)[::-1][:8]) and np.allclose(q.T @ q, np.eye(8)) and np.allclose(q * e @ q.T, m)
    big = np.array([[2 ** 40, -3], [5, 2 ** 41 + 1]], np.int64)
    assert whitening.products(big).tolist() == [[2 ** 80 + 25, -3 * 2 ** 40 + 5 * (2 ** 41 + 1)], [-3 * 2 ** 40 + 5 * (2 ** 41 + 1), 9 + (2 ** 41 + 1) ** 2]]
