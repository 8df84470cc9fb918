"""Whitening against numpy's eigenvectors, and its polynomial against exact arithmetic."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import charpoly as C
from shardloom.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def brute_polynomial(matrix):
    """Faddeev-LeVerrier in fractions: constant first."""
    d = len(matrix)
    a = [[Fraction(x) for x in row] for row in matrix]
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(x) for x in reversed(c)]


def scatter(seed, rows, d, scale):
    y = np.random.default_rng(seed).integers(-scale, scale, (rows, d)).astype(object)
    return (y.T.dot(y)).tolist()


@pytest.mark.parametrize(("rows", "d", "scale"), [(1, 1, 9), (9, 5, 7), (3, 6, 10**9), (20, 8, 2**61), (0, 3, 2)])
def test_polynomial_is_exact(spark, rows, d, scale):
    m = scatter(d, rows, d, scale)
    assert C.characteristic_polynomial(spark, m) == brute_polynomial(m)


def test_modular_polynomial_without_pivots():
    m = [[0, 0, 3], [0, 2, 0], [3, 0, 0]]
    p = C.primes(40)[0]
    assert C.modular_polynomial(m, p) == [x % p for x in brute_polynomial(m)]
    assert C.modular_polynomial([[0] * 4] * 4, p) == [0, 0, 0, 0, 1]


def test_primes_are_primes():
    found = C.primes(200)
    assert all(p < 1 << 31 and all(p % q for q in range(2, math.isqrt(p) + 1)) for p in found[:3])
    assert len(set(found)) == len(found) and math.prod(found).bit_length() > 200


def test_roots_of_known_multiplicity():
    """(x-7)^3 (x-5) (x-5+2^-?) ... : integer roots, a repeated one, zeros and a root below 1."""
    def product(*factors):
        out = [1]
        for f in factors:
            out = [sum(out[i] * f[k - i] for i in range(len(out)) if 0 <= k - i < len(f)) for k in range(len(out) + len(f) - 1)]
        return out

    poly = product([-7, 1], [-7, 1], [-7, 1], [-5, 1], [0, 1], [0, 1], [1, -3, 1])  # the last: (3 -+ sqrt 5) / 2
    got = C.largest_roots(poly, 99)
    assert [m for _, m in got] == [3, 1, 1, 1]
    assert np.allclose([float(r) for r, _ in got], [7, 5, (3 + 5**0.5) / 2, (3 - 5**0.5) / 2], rtol=1e-15)
    assert C.largest_roots([0, 0, 1], 2) == []
    assert sum(m for _, m in C.largest_roots(poly, 4)) == 4


def test_null_vectors_of_a_repeated_root(spark):
    q = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])
    m = (q @ np.diag([9, 4, 4, 1]) @ q.T).tolist()  # roots 36, 16, 16, 4
    roots = C.largest_roots(C.characteristic_polynomial(spark, m), 4)
    assert [(round(float(r)), k) for r, k in roots] == [(36, 1), (16, 2), (4, 1)]
    for r, k in roots:
        v = C.null_vectors(m, r, k)
        assert np.allclose(v @ v.T, np.eye(k), atol=1e-15) and np.allclose(v @ np.array(m), float(r) * v, atol=1e-13)


def expected(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return x, fit, n, s, v, e[::-1], u[:, ::-1]


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, fit, n, s, v, e, u = expected([r[1] for r in rows])
    at = {r[0]: i for i, r in enumerate(rows)}
    got = queries.op12_whitening(spark, SF).toPandas()
    assert len(got) == 16 * len(rows) and set(got.n) == {n} and got.identity_error.nunique() == 1
    assert got.identity_error.iloc[0] < 1e-9
    deviation = ((n * x - s) ** 2).sum(1)
    assert (got.deviation.to_numpy() == deviation[[at[i] for i in got.vec_id]]).all()
    for k, part in got.groupby("component"):
        want = ((x - s / n) @ u[:, k - 1] / np.sqrt(e[k - 1]))[[at[i] for i in part.vec_id]]
        assert min(np.abs(part.whitened - want).max(), np.abs(part.whitened + want).max()) < 1e-7
        assert abs(part.explained.iloc[0] / (e[k - 1] / v.trace()) - 1) < 1e-9


def test_result_does_not_depend_on_layout(spark):
    base = spark.read.parquet(f"{SF}/embeddings.parquet").select("embedding")
    one, two = whitening.fit(base)[64], whitening.fit(base.repartition(7).union(base))[64]
    assert (one.project == two.project).all() and (one.n, one.sums, one.explained) == (two.n, two.sums, two.explained)


def frame(spark, vectors, **extra):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").withColumns(extra)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [None, [], [1.0, None], [nan, 1.0], [1.0, inf], [0.5, 0.25], [0.5, 0.25], [-0.5, 1.0], [0.1, 0.0], [3.0], [3.0], [1.0, 2.0, 3.0], [1e300, 0.0, -1e300]]
    df = frame(spark, rows, **{"a.b": F.lit(1), "N": F.lit("mine"), "Whitened": F.lit(2)})
    spaces = whitening.fit(df)
    assert {d: (s.n, s.project.shape[1]) for d, s in spaces.items()} == {1: (1, 0), 2: (3, 2), 3: (2, 1)}
    out = whitening.whiten(df, spaces)
    assert out.columns == ["vec_id", "embedding", "a.b", "n", "deviation", "whitened", "explained", "identity_error"]
    got = {r["vec_id"]: r for r in out.collect()}
    assert sorted(got) == [5, 6, 7, 8, 9, 10, 11, 12]
    assert np.allclose(got[5]["whitened"], got[6]["whitened"], rtol=1e-14) and got[9]["whitened"] == [] and got[9]["deviation"] == 0
    fit = [[32, 16], [-32, 64], [6, 0]]
    s = [sum(c) for c in zip(*fit)]
    assert got[7]["deviation"] == sum((3 * a - b) ** 2 for a, b in zip(fit[1], s))
    assert abs(sum(got[5]["explained"]) - 1) < 1e-12 and abs(abs(got[11]["whitened"][0]) - 1) < 1e-12
    far = sum((a - b) ** 2 for a, b in zip((64, 128, 192), (2**62, 0, -(2**62))))
    assert got[11]["deviation"] == (far if far < 10**38 else None)
    empty = frame(spark, [])
    assert whitening.fit(empty) == {} and whitening.whiten(empty, {}).count() == 0


def test_products_in_limbs():
    y = np.random.default_rng(3).integers(-(2**62), 2**62, (50, 3))
    y[0] = [-(2**62), 2**62, -1]
    want = y.astype(object).T.dot(y.astype(object))
    assert (whitening.products(y) == want).all()


def test_duplicate_vectors_count_once_in_the_fit(spark):
    base = [[0.1 * i, 0.3 * i * i, -0.2] for i in range(12)]
    a, b = (whitening.fit(frame(spark, rows))[3] for rows in (base, base + [base[3]] * 500))
    assert (a.n, a.sums, a.explained) == (b.n, b.sums, b.explained) and a.project.shape == (3, 2)
