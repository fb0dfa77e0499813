"""Whitening against numpy's dense eigenvectors, and its solver on hard matrices."""

import math

import numpy as np
import pytest

from shipgauge.llm import queries
from shipgauge.llm.bidiagonal import bidiagonalise, singular, squares
from shipgauge.llm.whitening import fit, identity_error, whiten

SF = "/root/testdata/sf0.001"


def dense(vectors):
    """(x as Python integers, mean-free x, variances falling, directions) by the plain covariance."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return x, sums, centred, values[::-1], directions[:, ::-1]


def check(rows, got, model, error, components=32):
    x, sums, centred, values, directions = dense([v for _, v in rows])
    k = min(components, int(np.count_nonzero(values > 1e-12 * values[0])))
    n = len(x)
    by_id = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows) and len(model.variances) == k
    np.testing.assert_allclose(model.variances, values[:k], rtol=1e-9)
    np.testing.assert_allclose(model.total, values.sum(), rtol=1e-9)
    z = np.array([by_id[i]["whitened"] for i, _ in rows])
    want = centred @ directions[:, :k] / np.sqrt(values[:k])
    signs = np.sign((z * want).sum(axis=0))
    np.testing.assert_allclose(z, want * signs, atol=1e-7)
    assert [int(by_id[i]["deviation"]) for i, _ in rows] == [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    measured = np.abs(np.cov(z.T, bias=True).reshape(k, k) - np.eye(k)).max()
    assert error <= 1e-9 and abs(error - measured) < 1e-9


def test_query_equals_the_dense_solution(spark):
    rows = queries.op11_whitening(spark, SF).collect()
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    x, sums, centred, values, directions = dense([v for _, v in table])
    n, place = len(x), {v: i for i, (v, _) in enumerate(table)}
    z = np.zeros((n, 32))
    for r in rows:
        z[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9
    assert len(rows) == 32 * n
    want = centred @ directions[:, :32] / np.sqrt(values[:32])
    np.testing.assert_allclose(z, want * np.sign((z * want).sum(axis=0)), atol=1e-7)
    deviation = {r["vec_id"]: r["deviation"] for r in rows}
    assert all(deviation[v] == sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for (v, _), row in zip(table, x, strict=True))


def test_nulls_ties_ragged_rows_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(c) for c in rng.normal(size=5).astype(np.float32)]) for i in range(40)]
    good += [(7, good[7][1]), (None, good[3][1]), (99, [50.0, -3.0, 0.0, 1e-9, -1e-9])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [1.0, float("nan"), 0.0, 0.0, 0.0]), (53, [float("inf")] + [0.0] * 4),
           (54, []), (55, [1.0, 2.0]), (56, [1e30] + [0.0] * 4)]
    df = spark.createDataFrame([(i, v, "w", "d", "v") for i, v in good + bad],
                               "vec_id long, embedding array<float>, whitened string, deviation string, _vector string").repartition(5)
    model = fit(df)
    out = whiten(df, model)
    assert out.columns == ["vec_id", "embedding", "_vector", "whitened", "deviation"]
    named = [(-1 - i if k is None or k == 7 else k, v) for i, (k, v) in enumerate(good)]  # distinct names, by the vectors
    got = out.collect()
    assert all(r["_vector"] == "v" for r in got)
    keyed, left = [], list(named)
    for r in got:
        at = next(i for i, (k, v) in enumerate(left) if np.array_equal(np.float32(v), np.float32(r["embedding"])) and (k < 0 or k == r["vec_id"]))
        keyed.append({"vec_id": left.pop(at)[0], "whitened": r["whitened"], "deviation": r["deviation"]})
    check(named, keyed, model, identity_error(df, model))


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_without_variance_there_is_no_component(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    model = fit(df)
    got = whiten(df, model).collect()
    assert len(model.variances) == 0 and identity_error(df, model) == 0.0
    assert len(got) == sum(v is not None for v in vectors)
    assert all(r["whitened"] == [] and r["deviation"] == 0 for r in got)


def test_linearly_dependent_dimensions_and_huge_numbers(spark):
    rng = np.random.default_rng(5)
    half = rng.integers(-9, 9, size=(60, 3)).astype(float)
    rows = [(i, [*map(float, h), float(h[0]), float(2 * h[1]), 3.0, 2.0 ** 40]) for i, h in enumerate(half)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = fit(df)
    check(rows, whiten(df, model).collect(), model, identity_error(df, model))
    assert len(model.variances) == 3


def _hard_matrices():
    for seed in range(12):
        r = np.random.default_rng(seed)
        n = int(r.integers(1, 40))
        values = r.choice([0, 1e-8, 1, 1, 2, 2, 3, 1e4], size=n)
        q, u = (np.linalg.qr(r.normal(size=(n, n)))[0] for _ in range(2))
        yield np.diag(values) @ q
        yield u @ np.diag(values) @ q
        yield u @ np.diag(np.sqrt(1 + 1e-14 * np.arange(n))) @ q
        yield r.integers(-1, 2, size=(n, n)).astype(float)
    yield np.zeros((4, 4))
    yield np.eye(6)
    yield np.diag(np.abs(np.arange(-10, 11)) + 1.0) + np.diag(np.ones(20), 1)  # pairs of nearly equal values


def test_solver_on_degenerate_and_clustered_matrices():
    for m in _hard_matrices():
        values, vectors = singular(m)
        scale = max(values.max(), 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(len(m))).max() < 1e-10
        assert np.abs(m.T @ m @ vectors - vectors * values).max() / scale < 1e-12
        assert np.abs(values - np.linalg.svd(m, compute_uv=False) ** 2).max() / scale < 1e-12


def test_small_values_of_a_bidiagonal_are_relatively_accurate():
    """The inverse's entries are products here, so the smallest value is known to high accuracy from its largest."""
    a, b = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(1, 12)
    exact = np.linalg.svd(np.linalg.inv(np.diag(a) + np.diag(b, 1)), compute_uv=False)[0] ** -2
    assert abs(squares(a, b)[-1] / exact - 1) < 1e-12
    d, e, right = bidiagonalise(np.random.default_rng(1).normal(size=(9, 9)))
    assert np.abs(right.T @ right - np.eye(9)).max() < 1e-14 and len(d) == 9 and len(e) == 8
