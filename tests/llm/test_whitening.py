from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import catalog
from daymark.llm import whitening as W
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, component string, whitened string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], SCHEMA).repartition(parts)


def brute(vectors: list[list[float]], k: int = 8):
    """Integers, covariance by its definition and numpy's eigenvectors."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=float)
    y = x - x.mean(axis=0)
    values, vecs = np.linalg.eigh(y.T @ y / len(x))
    return x, y, values[::-1][:k], vecs[:, ::-1][:, :k].T, values.sum()


def compare(vectors, got, model, k=8):
    x, y, values, vecs, trace = brute(vectors, k)
    assert model.n == len(vectors) and len(model.components) == len(values)
    np.testing.assert_allclose(model.eigenvalues, values, rtol=1e-9)
    np.testing.assert_allclose(model.explained, values / trace, rtol=1e-9)
    np.testing.assert_allclose(np.abs(np.sum(model.components * vecs, axis=1)), 1, atol=1e-9)
    assert np.abs(model.components @ model.components.T - np.eye(len(values))).max() < 1e-14
    sums = [sum(int(v) for v in c) for c in x.T]
    want = {}
    for i, row in enumerate(x):
        deviation = sum((len(x) * int(v) - s) ** 2 for v, s in zip(row, sums))
        for c, u in enumerate(model.components):
            want[i, c + 1] = (deviation, float((row - x.mean(axis=0)) @ u / math.sqrt(model.eigenvalues[c])))
    assert len(got) == len(want)
    for r in got:
        deviation, w = want[r.vec_id, r.component]
        assert int(r.deviation) == deviation and r.whitened == pytest.approx(w, abs=1e-7)


def test_against_the_definition(spark):
    rng = np.random.default_rng(3)
    for dim, n in ((12, 300), (3, 40), (1, 9)):
        vectors = (rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim))).astype(np.float32).tolist()
        df = table(spark, enumerate(vectors))
        model = W.fit_whitening(df)
        compare(vectors, W.whiten(df, model).collect(), model)
        assert W.identity_error(df, model) < 1e-9


def test_rows_without_a_usable_vector_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(30, 9)).astype(np.float32).tolist()
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None] * 9, [nan] + [0.0] * 8, [0.0] * 8 + [inf], [-inf] * 9, [3e38] * 9, [1.0, 2.0]]
    rows = [*enumerate(vectors), *[(100 + i, v) for i, v in enumerate(bad)], (None, vectors[0]), (7, vectors[7])]
    df = table(spark, rows)
    model = W.fit_whitening(df)
    assert model.n == 32 and model.dim == 9
    got = W.whiten(df, model).collect()
    assert len(got) == 32 * 8 and {r.vec_id for r in got} == {*range(30), None}
    x, _, values, _, _ = brute([*vectors, vectors[0], vectors[7]])
    np.testing.assert_allclose(model.eigenvalues, values, rtol=1e-9)


def test_ties_and_missing_directions(spark):
    # Two pairs of equal eigenvalues and a direction without variance.
    vectors = [[s * 2.0 if j == i else 0.0 for j in range(4)] + [5.0] for i in range(4) for s in (1, -1)]
    df = table(spark, enumerate(vectors))
    model = W.fit_whitening(df)
    assert len(model.components) == 4 and len(set(model.eigenvalues.tolist())) == 1
    assert np.abs(model.components @ model.components.T - np.eye(4)).max() < 1e-15 and W.identity_error(df, model) < 1e-12
    one = table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    model = W.fit_whitening(one)
    assert model.n == 2 and W.whiten(one, model).count() == 0 and W.identity_error(one, model) == 0.0
    empty = one.where("vec_id < 0")
    assert W.whiten(empty, W.fit_whitening(empty)).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [[1e9, -2e9, 3.0], [4e12, 1.5, -7e10], [-4e12, 0.25, 1.0], [12345.678, 9e11, -1e3]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    n, sums, matrix = W.scatter(df, "embedding", 3)
    x = [[math.floor(1024 * c) for c in v] for v in rows]
    assert n == 4 and sums == [sum(c) for c in zip(*x)]
    want = [[4 * sum(v[i] * v[j] for v in x) - sums[i] * sums[j] for j in range(3)] for i in range(3)]
    assert matrix == want
    got = {r.vec_id: int(r.deviation) for r in W.whiten(df, W.fit_whitening(df)).where("component = 1").collect()}
    assert got == {i: sum((4 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}


def test_polynomial_and_roots(spark):
    assert W.primes_below(30, 5) == [29, 23, 19, 17, 13]
    # Eigenvalues 0, 0, 3, 3, 10^12 (rotated by an integer similarity that stays symmetric).
    matrix = [[3, 0, 0, 0, 0], [0, 3, 0, 0, 0], [0, 0, 10**12, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 0]]
    poly = W.characteristic_polynomial(spark, matrix)
    assert poly == [1, -(10**12 + 6), 6 * 10**12 + 9, -9 * 10**12, 0, 0]
    roots = W.largest_roots(poly, 8, 40)
    assert [(r.at, r.multiplicity) for r in roots] == [(10**12 << 40, 1), (3 << 40, 2)]
    assert W.largest_roots([1, -3, 1], 1, 100)[0].at == pytest.approx((3 + 5**0.5) / 2 * 2**100, rel=1e-15)
    tri = [[2, -1, 0], [-1, 2, -1], [0, -1, 2]]
    assert W.characteristic_polynomial(spark, tri) == [1, -6, 10, -4]
    rng = np.random.default_rng(0)
    b = rng.integers(-50, 50, (6, 4))
    gram = (b @ b.T).tolist()
    poly = W.characteristic_polynomial(spark, gram)
    np.testing.assert_allclose(np.array(poly, float), np.poly(np.array(gram, float)), rtol=1e-6, atol=1e3)
    assert poly[5:] == [0, 0]


def test_query(spark):
    got = catalog.QUERIES["op11_whitening"](spark, SF_SMALL)
    rows = got.collect()
    vectors = [r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    model = W.fit_whitening(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    compare(vectors, rows, model)
    assert {r.n for r in rows} == {len(vectors)} and max(r.identity_error for r in rows) < 1e-9
    assert dict(got.dtypes)["deviation"] == "bigint" and got.where(F.col("explained").isNull()).count() == 0
