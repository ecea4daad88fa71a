import math
from fractions import Fraction

import numpy as np
import pytest

from dwellrank.llm import whitening as wh
from dwellrank.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Exact integers, then numpy's symmetric solver: (vec_id, deviation, whitened row), eigenvalues, trace."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    gaps = [[n * c - s for c, s in zip(row, sums)] for row in x]
    floats = np.array(gaps, float) / n
    values, vectors = np.linalg.eigh(floats.T @ floats / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    whitened = floats @ vectors / np.sqrt(values)
    return [(i, sum(g * g for g in gap), w) for (i, _), gap, w in zip(kept, gaps, whitened)], values, np.trace(floats.T @ floats / n)


def as_rows(found):
    """vec_id to (deviation, whitened by component); ids are unique here."""
    out = {}
    for r in found:
        out.setdefault(r.vec_id, (r.deviation, {}))[1][r.component] = r.whitened
    return out


def test_op13_equals_numpy(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected, values, trace = brute(rows)
    frame = QUERIES["op13_exact_whitening"](spark, folder)
    assert frame.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = frame.collect()
    assert len(found) == 8 * len(expected) and {r.n for r in found} == {len(rows)}
    assert max(r.identity_error for r in found) < 1e-9 and len({r.identity_error for r in found}) == 1
    got = as_rows(found)
    for k in range(8):
        signs = {round(got[i][1][k + 1] / w[k]) for i, _, w in expected if abs(w[k]) > 0.01}
        assert len(signs) == 1
        sign = signs.pop()
        assert all(got[i][1][k + 1] == pytest.approx(sign * w[k], abs=1e-9) for i, _, w in expected)
    assert all(got[i][0] == d for i, d, _ in expected)
    assert {r.component: r.explained for r in found} == {k + 1: pytest.approx(v / trace) for k, v in enumerate(values)}


def test_polynomial_equals_fractions(spark):
    rng = np.random.default_rng(2)
    b = rng.integers(-50, 50, (7, 12))
    matrix = (b @ b.T).tolist()
    d = len(matrix)
    # Faddeev-LeVerrier in fractions.
    m, expected = [[0] * d for _ in range(d)], [1]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (expected[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        trace = sum(sum(matrix[i][t] * m[t][i] for t in range(d)) for i in range(d))
        expected.append(Fraction(-trace, k))
    whole, simple = wh.polynomials(spark, matrix)
    assert whole == expected[::-1] and simple == whole


def test_pivots_and_zero_columns():
    primes = wh.primes_below(1 << 31, 1 << 100)
    assert primes[0] == (1 << 31) - 1 and all(wh._is_prime(p) for p in primes)
    for matrix in ([[0, 0, 1], [0, 0, 0], [1, 0, 0]], [[2, 0, 0, 3], [0, 1, 4, 0], [0, 4, 0, 0], [3, 0, 0, 5]], [[0] * 3] * 3):
        rows = wh.hessenberg_polynomials(matrix, primes)
        expected = [int(round(x)) for x in np.poly(np.array(matrix, float))[::-1]] if np.any(matrix) else [0, 0, 0, 1]
        assert wh.remaindered(rows.tolist(), primes) == expected


def polynomial(roots):
    f = [1]
    for r in roots:
        f = [a - r * b for a, b in zip([0, *f], [*f, 0])]
    return f


def test_close_repeated_and_zero_roots():
    big = 1 << 80
    roots = [0, 0, 3, 7, 7, big, big + 1, big + 1, big + 1]
    f, simple = polynomial(roots), polynomial(sorted(set(roots)))
    found = wh.largest_roots(f, simple, 8)
    assert [(Fraction(r.low, 2**r.bits) < v <= Fraction(r.low + 1, 2**r.bits), r.count) for r, v in zip(found, [big + 1, big, 7, 3])] == [(True, 3), (True, 1), (True, 2), (True, 1)]
    assert [r.count for r in wh.largest_roots(f, simple, 3)] == [3]
    assert wh.roots_beyond(f, 7, 0) == 4 and wh.roots_beyond(f, 13, 1) == 6
    irrational = [1, -4, 1]  # 2 - sqrt 3 and 2 + sqrt 3
    assert [r.low / 2**r.bits for r in wh.largest_roots(irrational, irrational, 8)] == pytest.approx([2 + 3**0.5, 2 - 3**0.5], rel=1e-15)


def test_components_whose_roots_nearly_meet(spark):
    """Two eigenvalues one part in 2**40 apart: doubles alone could not tell the axes."""
    matrix = [[1 << 40, 0, 0], [0, (1 << 40) + 1, 0], [0, 0, 5]]
    parts = wh.components(spark, wh.Moments(1, [0, 0, 0], matrix))
    assert [[abs(round(x, 12)) for x in p.vector] for p in parts] == [[0, 1, 0], [1, 0, 0], [0, 0, 1]]


def test_repeated_eigenvalue_has_an_orthonormal_basis(spark):
    corners = [(i, [a, b, c, 0.0]) for i, (a, b, c) in enumerate((a, b, c) for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-3.0, 3.0))]
    found = wh.whiten(spark.createDataFrame([(i, v, 0) for i, v in corners], SCHEMA)).collect()
    w = np.array([[as_rows(found)[i][1][k] for k in (1, 2, 3)] for i, _ in corners])
    assert max(r.component for r in found) == 3 and np.allclose(w.T @ w / 8, np.eye(3))
    assert found[0].identity_error < 1e-9


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [math.sin(i * k + k) for k in range(1, 5)]) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [nan, 0.0, 0.0, 0.0]), (103, [0.0, inf, 0.0, 0.0]), (104, [-inf] * 4), (105, []), (106, [1.0, 2.0])]
    rows = [*good, *bad]
    schema = SCHEMA + ", component string, n string, whitened string, v string"
    found = wh.whiten(spark.createDataFrame([(*r, None, "a", "b", "c", "d") for r in rows], schema)).collect()
    got, (expected, _, _) = as_rows(found), brute(good)
    assert set(got) == {i for i, _ in good} and all(len(v[1]) == 4 for v in got.values())
    for i, d, w in expected:
        assert got[i][0] == d and [abs(got[i][1][k + 1]) for k in range(4)] == pytest.approx([abs(x) for x in w])
    # A null key and copies are rows of their own.
    twice = wh.whiten(spark.createDataFrame([(*r, 0) for r in [*good, good[0], (None, good[1][1])]], SCHEMA)).collect()
    assert len(twice) == 32 * 4 and {r.n for r in twice} == {32}


def test_tables_without_a_component(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(i, [0.5, 0.25], 0) for i in range(9)], [(1, [], 0)]):
        frame = wh.whiten(spark.createDataFrame(rows, SCHEMA))
        assert frame.count() == 0 and frame.columns[0] == "vec_id"


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e15 + 3.0 * i, -1e12 * i, float(i % 3)]) for i in range(12)]
    found = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(1024 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    spread = [sum((12 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert {r.vec_id: int(r.deviation_exact) for r in found} == dict(enumerate(spread))
    assert all(r.deviation is None for r in found if r.deviation_exact >= 1 << 63) and found[0].identity_error < 1e-6
    limits = wh.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert len(limits) == 3 and max(abs(r.whitened) for r in limits) < 2


def test_limbs_and_deviations():
    rng = np.random.default_rng(3)
    for size in (1, 1 << 19, 1 << 21, 1 << 45, (1 << 63) - 1):
        y = rng.integers(-size, size, (50, 3))
        o = y.astype(object)
        assert (wh.exact_products(y) == o.T @ o).all()
        assert wh.deviations(y) == [int((r * r).sum()) for r in o]
