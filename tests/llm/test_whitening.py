"""Whitening: exact parts against exact arithmetic, components against numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm.whitening import (
    characteristic_polynomial, hessenberg_polynomials, largest_roots, pack, primes, roots_above, unpack, whiten, whole_numbers,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors_table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], SCHEMA).repartition(3)


def exact_polynomial(m):
    """Coefficients, constant first, by traces of powers (Newton's identities)."""
    d = len(m)
    power = [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
    traces = []
    for _ in range(d):
        power = [[sum(power[i][k] * m[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
        traces.append(sum(power[i][i] for i in range(d)))
    e = [Fraction(1)]
    for k in range(1, d + 1):
        e.append(sum((-1) ** (i - 1) * e[k - i] * traces[i - 1] for i in range(1, k + 1)) / k)
    return [int((-1) ** k * e[k]) for k in range(d, -1, -1)]


def some_matrix(d, rank, seed, scale=9):
    x = np.random.default_rng(seed).integers(-scale, scale, (rank, d))
    return (x.T @ x).tolist()


@pytest.mark.parametrize(("d", "rank", "scale"), [(1, 1, 9), (2, 1, 9), (5, 3, 9), (6, 9, 10**6), (4, 4, 10**8)])
def test_polynomial(spark, d, rank, scale):
    m = some_matrix(d, rank, d, scale)
    assert characteristic_polynomial(spark, [[int(v) for v in row] for row in m]) == exact_polynomial(m)


def test_polynomial_with_zero_pivots():
    m = [[0, 0, 0, 1], [0, 2, 0, 0], [0, 0, 3, 0], [1, 0, 0, 0]]
    p = primes(10**12)
    found = hessenberg_polynomials(np.array([np.array(m) % q for q in p]), np.array(p))
    assert [[v if 2 * v < q else v - q for v in row] for row, q in zip(found.tolist(), p, strict=True)] == [exact_polynomial(m)] * len(p)


def test_roots():
    # (x - 7)^2 (x - 3) x
    polynomial = [0, -147, 91, -17, 1]
    assert [roots_above(polynomial, x, 0) for x in (-1, 0, 2, 3, 6, 7, 8)] == [4, 3, 3, 2, 2, 0, 0]
    found = largest_roots(polynomial, 17, 4)
    assert [(round(float(r), 12), k) for r, k in found] == [(7, 2), (3, 1)]
    wide = largest_roots([2, -4, 1], 4, 2)  # 2 +- sqrt(2)
    assert [float(r) for r, _ in wide] == pytest.approx([2 + math.sqrt(2), 2 - math.sqrt(2)], rel=1e-15)


def test_whole_numbers_and_packing():
    x = whole_numbers(np.array([0.5, -0.001, -0.0, 1e30, -1e30, 2.0**54, 0.00390624]))
    assert x.tolist() == [128, -1, 0, 2**63 - 1, -(2**63), 2**62, 0]
    rows = [np.array([1, -2], np.int64), np.array([2**20, 0]), np.array([-(2**63), 2**63 - 1])]
    assert unpack([pack(r) for r in rows], 2).tolist() == [r.tolist() for r in rows]


def brute(rows, k=4):
    x = np.floor(256 * np.array(rows, np.float32).astype(float)).astype(np.int64)
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    centred = distinct - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), ((x * n - s) / n) @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_same_as_numpy(spark):
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(150, 8)) * np.array([3, 2, 1.5, 1.2, 1, 0.8, 0.5, 0.1])).astype(np.float32).tolist()
    rows += rows[:40] + [rows[0]] * 60
    n, deviation, whitened, explained = brute(rows)
    found = {(r["vec_id"], r["component"]): r for r in whiten(vectors_table(spark, rows)).collect()}
    assert len(found) == 4 * len(rows)
    for k in range(4):
        own = [found[i, k + 1] for i in range(len(rows))]
        assert {r["n"] for r in own} == {n} and [r["deviation"] for r in own] == deviation.tolist()
        w = np.array([r["whitened"] for r in own])
        sign = np.sign(w @ whitened[:, k])
        np.testing.assert_allclose(sign * w, whitened[:, k], atol=1e-10)
        assert own[0]["explained"] == pytest.approx(explained[k], rel=1e-9) and own[0]["identity_error"] < 1e-9


def test_equal_eigenvalues(spark):
    """A cross of unit steps: all eigenvalues are alike, and any orthonormal basis will do."""
    rows = [[s * float(i == j) for j in range(5)] for i in range(5) for s in (1, -1)]
    found = whiten(vectors_table(spark, rows)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4} and {round(r["explained"], 12) for r in found} == {0.2}
    assert max(r["identity_error"] for r in found) < 1e-12


def test_fewer_components(spark):
    """Vectors on a line have one component, equal ones none."""
    rows = [[float(i), 2.0 * i, 0.0] for i in range(5)]
    found = whiten(vectors_table(spark, rows)).collect()
    assert [r["component"] for r in found] == [1] * 5 and found[0]["explained"] == pytest.approx(1)
    assert whiten(vectors_table(spark, [[1.0, 2.0]] * 3)).count() == 0


def test_odd_tables(spark):
    none = vectors_table(spark, [])
    assert whiten(none).count() == 0 and whiten(vectors_table(spark, [None, [], [None]])).count() == 0
    rows = [None, [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [5.0], [], [1.0, 0.0], [0.0, 0.0], [0.0, 3.0], [1.0, 0.0]]
    table = vectors_table(spark, rows).withColumns({c: F.lit("c") for c in ("id", "d", "x", "n", "k", "component", "value")})
    found = whiten(table).collect()
    assert sorted({r["vec_id"] for r in found}) == [6, 7, 8, 9] and {r["n"] for r in found} == {3}
    huge = whiten(vectors_table(spark, [[1e30, 0.0], [-1e30, 0.0], [0.0, 1.0]])).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] < 2} == {None} and {r["component"] for r in huge} == {1, 2}
