"""Eigenvalues and eigenvectors of an integer covariance matrix from its exact characteristic polynomial.

The polynomial is found modulo many primes (Hessenberg reduction, one prime a
row of a Spark job) and put together by Chinese remainders; a bound on its
coefficients tells how many primes it takes. All roots are real, so the number
of roots above a point is exactly the number of sign changes of the polynomial
shifted to that point (Descartes' rule counts exactly then, with
multiplicity). Bisection on that count isolates roots; after that signs alone
are asked. Vectors of the null space come from inverse iteration in decimal
arithmetic. Everything here works on a matrix of d x d and d + 1 coefficients,
whatever the number of rows it was summed from; time grows with d cubed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Bits to which a root is found, relative to itself, and digits of decimal arithmetic for vectors.
BITS = 160
DIGITS = 90


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that decide all numbers below 3,215,031,751."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, largest first, whose product is over ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime, constant first, by reduction to Hessenberg form."""
    d = len(matrix)
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        k = m + int(below[0])
        if k != m:
            a[[k, m]] = a[[m, k]]
            a[:, [k, m]] = a[:, [m, k]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - polys[k - 1] * a[k - 1, k - 1] % p) % p
        down = 1  # product of the entries below the diagonal
        for i in range(k - 1, 0, -1):
            down = down * int(a[i, i - 1]) % p
            if not down:
                break
            polys[k] = (polys[k] - polys[i - 1] * (int(a[i - 1, k - 1]) * down % p) % p) % p
    return polys[d].tolist()


def _reducer(matrix: list[list[int]]):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            primes = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([polynomial_modulo(matrix, p) for p in primes], pa.list_(pa.int64()))], names=["p", "c"])

    return reduce


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact coefficients of det(x - matrix), constant first, of a positive semidefinite integer matrix.

    The k-th is at most comb(d, k) (trace / d)^k. Residues of a few hundred
    primes (d + 1 numbers each) are what the driver gets.
    """
    d = len(matrix)
    mean = -(-sum(matrix[k][k] for k in range(d)) // d)
    primes = primes_beyond(2 * max(comb(d, k) * mean**k for k in range(d + 1)))
    slots = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartitionByRange(slots, "p").mapInArrow(_reducer(matrix), "p long, c array<long>").collect()
    value, product = [0] * (d + 1), 1
    for r in rows:
        step = pow(product, -1, r.p)
        value = [v + product * ((c - v) * step % r.p) for v, c in zip(value, r.c)]  # noqa: B905
        product *= r.p
    return [v - product if v > product // 2 else v for v in value]


def _above(poly: list[int], a: Fraction) -> int:
    """How many roots lie above a point: sign changes after a shift to it (of d^n p(x + n/d), whose coefficients are whole)."""
    q, bits = len(poly) - 1, a.denominator.bit_length() - 1
    c = [v << bits * (q - k) for k, v in enumerate(poly)]  # roots times the denominator, a power of two
    for i in range(q):
        for k in range(q - 1, i - 1, -1):
            c[k] += a.numerator * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))  # noqa: B905


def _sign(poly: list[int], a: Fraction) -> int:
    bits, value, scale = a.denominator.bit_length() - 1, 0, 0
    for v in reversed(poly):
        value = value * a.numerator + (v << scale)
        scale += bits
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int) -> list[Fraction]:
    """The largest roots above zero, with multiplicity, falling, each within 2^-BITS of itself; fewer if there are fewer.

    A root that is found repeatedly comes out as the same number each time.
    """
    total = _above(poly, Fraction(0))
    top = 1
    while _above(poly, Fraction(top)):
        top *= 2
    found: list[Fraction] = []
    known = {Fraction(0): total, Fraction(top): 0}  # roots above a point
    for k in range(min(count, total)):
        low = max(x for x, n in known.items() if n > k)
        high = min(x for x, n in known.items() if n <= k)
        while (high - low) * (1 << BITS) > high:
            mid = (low + high) / 2
            if known[low] - known[high] == 1:  # one root inside: its sign tells the side
                right = _sign(poly, high) or (-1) ** known[high]
                sign = _sign(poly, mid)
                if sign == 0:
                    low = high = mid
                    break
                known[mid] = known[high] if sign == right else known[low]
            else:
                known[mid] = _above(poly, mid)
            low, high = (mid, high) if known[mid] > k else (low, mid)
        found.append((low + high) / 2 if low != high else mid)
    return found


def _null_vectors(matrix: list[list[int]], root: Fraction, before: list[np.ndarray]) -> np.ndarray:
    """A unit vector of decimals with (matrix - root) v = 0 by inverse iteration, at right angles to those before."""
    d = len(matrix)
    e = Decimal(root.numerator) / Decimal(root.denominator)
    a = np.array([[Decimal(v) for v in row] for row in matrix], object)
    a[np.diag_indices(d)] -= e
    tiny = e * Decimal(10) ** -(DIGITS - 10)  # stands for a pivot that is zero
    order = np.arange(d)
    for m in range(d):
        k = m + max(range(d - m), key=lambda i: abs(a[m + i, m]))
        a[[k, m]], order[[k, m]] = a[[m, k]], order[[m, k]]
        if abs(a[m, m]) < tiny:
            a[m, m] = tiny
        a[m + 1 :, m] = a[m + 1 :, m] / a[m, m]
        a[m + 1 :, m + 1 :] -= np.outer(a[m + 1 :, m], a[m, m + 1 :])
    start = np.random.default_rng(d + len(before)).integers(1, 1000, d)
    v = np.array([Decimal(int(x)) for x in start], object)
    for _ in range(4):
        v = v[order]
        for m in range(d):
            v[m + 1 :] -= a[m + 1 :, m] * v[m]
        for m in range(d - 1, -1, -1):
            v[m] = (v[m] - (a[m, m + 1 :] * v[m + 1 :]).sum()) / a[m, m]
        for _ in range(2):
            for w in before:
                v = v - w * (v * w).sum()
        v = v / (v * v).sum().sqrt()
    return v


def components(matrix: list[list[int]], roots: list[Fraction]) -> np.ndarray:
    """Unit eigenvectors (rows) of an integer matrix for its falling roots, in double precision."""
    with localcontext() as context:
        context.prec = DIGITS
        found: list[np.ndarray] = []
        for root in roots:
            found.append(_null_vectors(matrix, root, found))
        return np.array([[float(x) for x in v] for v in found]).reshape(len(roots), len(matrix))
