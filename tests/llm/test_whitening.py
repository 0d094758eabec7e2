from fractions import Fraction
from math import floor

import numpy as np
import pytest

from tarn.llm import charpoly, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, v int"


def determinant(m):
    m, sign, d = [[Fraction(x) for x in row] for row in m], 1, Fraction(1)
    for k in range(len(m)):
        p = next((i for i in range(k, len(m)) if m[i][k]), None)
        if p is None:
            return Fraction(0)
        if p != k:
            m[k], m[p], sign = m[p], m[k], -sign
        d *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return d * sign


def frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in vectors], SCHEMA).repartition(parts)


def check(spark, vectors, good, k):
    """The result for (id, vector) rows of which ``good`` count, against whole numbers and numpy."""
    rows = whitening.whitened(frame(spark, vectors)).collect()
    x = [[floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    s = [sum(c) for c in zip(*x)]
    u = [[n * a - b for a, b in zip(r, s)] for r in x]
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, c) for i, _ in good for c in range(1, k + 1))
    deviations = sorted((i, sum(a * a for a in r)) for (i, _), r in zip(good, u))
    for c in range(1, k + 1):
        assert sorted((r.vec_id, int(r.deviation_exact)) for r in rows if r.component == c) == deviations
    assert all(r.n == n and (r.deviation == r.deviation_exact if r.deviation_exact < 2**63 else r.deviation is None) for r in rows)
    centred = np.array(u, float) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    by = {(r.vec_id, r.component): r for r in rows}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    for c in range(k):
        assert by[good[0][0], c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
        if sum(abs(values - values[c]) < 1e-9 * values[0]) == 1:
            want = centred @ axes[:, c] / np.sqrt(values[c])
            found = np.array([by[i, c + 1].whitened for i, _ in good])
            want *= np.sign(want @ found)
            assert np.allclose(found, want, atol=1e-8)
    return rows


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 12)) * np.linspace(0.05, 0.6, 12)
    vectors = list(enumerate(x.tolist()))
    check(spark, vectors, vectors, 8)


def test_defined_cases(spark):
    rng = np.random.default_rng(4)
    good = [(i, r) for i, r in enumerate(rng.normal(size=(40, 3)).tolist())] + [(100, [0.5, 0.5, 0.5])] * 3 + [(101, [5000.0, -9e5, 3.0])]
    bad = [(200, None), (201, []), (202, [1.0, None, 1.0]), (203, [1.0, float("nan"), 1.0]), (204, [float("inf"), 0, 0]), (205, [1.0, 2.0]), (206, [1e30, 0, 0])]
    check(spark, good + bad, good, 3)
    assert whitening.whitened(frame(spark, bad[:5])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    empty = whitening.whitened(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and [t for c, t in empty.dtypes][:7] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    assert whitening.whitened(frame(spark, [(None, [1.0]), (None, [2.0])])).where("vec_id is null and abs(abs(whitened) - 1) < 1e-12").count() == 2


def test_rank_and_equal_eigenvalues(spark):
    corners = [(i, [float(s) if j == i // 2 else 0.0 for j in range(4)] + [7.0]) for i, s in enumerate([1, -1] * 4)]  # four equal ones and a zero
    rows = check(spark, corners, corners, 4)
    assert {round(r.explained, 12) for r in rows} == {0.25}


def test_huge_entries_are_exact(spark):
    rng = np.random.default_rng(5)
    good = [(i, r) for i, r in enumerate((rng.normal(size=(30, 2)) * 2.0**40).tolist())]
    check(spark, good, good, 2)
    y = rng.integers(-(2**61), 2**61, (5000, 3))
    assert (whitening.gram(y) == y.astype(object).T @ y.astype(object)).all()


@pytest.mark.parametrize("d", [1, 2, 5, 9])
def test_polynomial_is_exact(spark, d):
    rng = np.random.default_rng(d)
    b = rng.integers(-50, 50, (d + 2, d)).astype(object)
    b[:, d // 2] = b[:, 0]  # a root at zero for d > 1
    m = (b.T @ b).tolist()
    poly = charpoly.characteristic(spark, m)
    for x in range(d + 1):
        assert sum(c * x**k for k, c in enumerate(poly)) == determinant([[(i == j) * x - m[i][j] for j in range(d)] for i in range(d)])
    roots = charpoly.largest_roots(poly, d)
    assert len(roots) == max(1, d - 1)
    assert np.allclose([float(r) for r in roots], np.linalg.eigvalsh(np.array(m, float))[::-1][: len(roots)])
