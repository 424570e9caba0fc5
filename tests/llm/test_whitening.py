import math

import numpy as np
import pytest

from termloom.llm.whitening import polar_factor, principal_components, whiten

SF = "/root/testdata/sf0.001"


def matrix_with(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q * np.array(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1.0, 41),
        [5.0],
        [3.0, 3.0, 3.0],
        [1e9, 1.0, 1.0, 1e-3, 0.0, 0.0],
        [2.0] * 20 + [1.0] * 20,
        np.logspace(0, 12, 30),
        [0.0, 0.0, 7.0, 0.0],
        1 + np.arange(25) * 1e-9,
    ],
)
def test_components_are_those_of_a_plain_solver(values):
    a = matrix_with(values)
    size = np.abs(a).max()
    want = np.linalg.eigvalsh(a)[::-1]
    for most in (1, 4, len(values)):
        got, vectors = principal_components(a, most)
        np.testing.assert_allclose(got, want[:most], atol=1e-13 * size * len(values))
        np.testing.assert_allclose(a @ vectors, vectors * got, atol=1e-13 * size * len(values))
        np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)


def test_polar_factor_is_the_sign():
    a = matrix_with([4.0, 1e-6, -1e-9, -3.0])
    u = polar_factor(a)
    np.testing.assert_allclose(u @ u, np.eye(4), atol=1e-12)
    np.testing.assert_allclose(u @ a, (u @ a).T, atol=1e-12)
    assert np.linalg.eigvalsh(u @ a).min() > 0


def brute(vectors, scale=256):
    """(n, S, eigenvalues, unit vectors, trace) of the distinct vectors, plainly."""
    x = sorted({tuple(math.floor(scale * float(c)) for c in v) for v in vectors})
    x = np.array(x, dtype=object)
    n, sums = len(x), x.sum(0)
    z = np.array([[float(a - s / n) for a, s in zip(row, sums)] for row in x])
    values, parts = np.linalg.eigh(z.T @ z / n)
    return n, [int(s) for s in sums], values[::-1], parts[:, ::-1], float(values.sum())


def test_whole_table_against_a_plain_solver(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in df.collect()}
    good = {k: v for k, v in rows.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    n, sums, values, parts, trace = brute(good.values())
    got = whiten(df).collect()
    assert {(r.vec_id, r.component) for r in got} == {(k, c) for k in good for c in (1, 2, 3, 4)}
    signs = {}
    for r in got:
        x = [math.floor(256 * float(c)) for c in good[r.vec_id]]
        assert r.n == n
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        k = r.component - 1
        want = float((np.array([a - s / n for a, s in zip(x, sums)]) @ parts[:, k]) / math.sqrt(values[k]))
        if abs(want) > 0.1:
            sign = signs.setdefault(k, math.copysign(1, want * r.whitened))
            assert abs(r.whitened * sign - want) < 1e-9
        assert abs(r.explained / (values[k] / trace) - 1) < 1e-10
    assert {r.identity_error for r in got} == {got[0].identity_error}
    assert got[0].identity_error < 1e-10


ODD = [
    (1, [1.0, 2.0, 3.0]),
    (1, [1.0, 2.0, 3.0]),
    (2, [1.0, 2.0, 3.001]),
    (3, None),
    (4, [1.0, None, 3.0]),
    (5, [float("nan"), 0.0, 0.0]),
    (6, [float("inf"), 0.0, 0.0]),
    (7, [1e300, 0.0, 0.0]),
    (8, []),
    (9, [-0.0, 0.0, 0.0]),
    (10, [5.0]),
    (None, [-3.0, 4.5, -1.0]),
]


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, n long, id string, key string, component string"
    df = spark.createDataFrame([(i, v, 5, "odd", "odd", "odd") for i, v in ODD], schema)
    got = whiten(df).collect()
    # 1 and 2 are equal in whole numbers, 8 and 9 are both zero, 3 to 7 are left out
    assert sorted((r.vec_id or 0) for r in got) == sorted([0, 1, 1, 2, 8, 9, 10] * 3)
    assert {r.n for r in got} == {4}
    x = {0: (-768, 1152, -256), 1: (256, 512, 768), 8: (0, 0, 0), 10: (1280, 0, 0)}
    sums = [sum(v) for v in zip(*x.values())]
    for r in got:
        if (r.vec_id or 0) in x:
            assert r.deviation == sum((4 * a - s) ** 2 for a, s in zip(x[r.vec_id or 0], sums))
    assert max(r.identity_error for r in got) < 1e-10


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_without_variance_there_are_no_components(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = whiten(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_large_numbers(spark):
    df = spark.createDataFrame([(0, [2.0**54, 1.0]), (1, [-(2.0**54), 3.0]), (2, [2.0**53, -5.0])], "vec_id long, embedding array<double>")
    got = whiten(df, components=1).collect()
    assert [r.deviation for r in got] == [2**63 - 1] * 3
    assert abs(sum(r.whitened for r in got)) < 1e-12 and got[0].identity_error < 1e-10
