"""Exact spectra of integer matrices: characteristic polynomial by modular
Hessenberg reduction and Chinese remaindering, real roots isolated in integers,
components by inverse iteration on the null space.

For scatter matrices: symmetric, positive semidefinite, exact integers of any
size.  Their polynomial has real roots only, so the sign changes of its Taylor
shift by a *count* the roots above a, multiplicities included (Descartes' rule is
exact there).  Nothing here rounds before a root is known to ``BITS`` bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

#: Relative precision of a root, in bits.  Roots closer than that count as one with a multiplicity.
BITS = 100
#: Decimal digits of the null-space solves.
DIGITS = 90


def primes(bits: int) -> list[int]:
    """The largest primes below 2^31 whose product has more than ``bits`` bits."""
    found, product, p = [], 1, (1 << 31) + 1
    while product.bit_length() <= bits:
        p -= 2
        if _is_prime(p):
            found.append(p)
            product *= p
    return found


def _is_prime(n: int) -> bool:
    """Miller-Rabin; the bases 2, 3, 5, 7 are exact below 3.2 * 10^9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def modular_polynomial(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients (constant first) of det(xI - matrix) mod ``p`` < 2^31.

    A similarity brings the matrix to upper Hessenberg form; the polynomials of
    its leading blocks follow from one another."""
    h = np.array([[x % p for x in row] for row in matrix], np.int64)
    d = len(h)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        h[[i, m]] = h[[m, i]]
        h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(1)) % p
    leading = np.zeros((d + 1, d + 1), np.int64)
    leading[0, 0] = 1
    for k in range(d):
        weights, chain = np.zeros(k + 1, np.int64), 1
        weights[k] = h[k, k]
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = chain * int(h[i, k]) % p
        down = (weights[:, None] * leading[: k + 1] % p).sum(0)
        leading[k + 1, 1:] = leading[k, :-1]
        leading[k + 1] = (leading[k + 1] - down) % p
    return leading[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, constant first, of det(xI - matrix) for a positive
    semidefinite ``matrix``: one task's work a prime, joined by Chinese remainders.

    The k-th elementary symmetric function of eigenvalues that are not negative is
    at most C(d, k) (trace / d)^k, which bounds the coefficients and so the primes
    needed: their number depends on the matrix alone, never on the rows behind it."""
    d = len(matrix)
    mean = sum(matrix[i][i] for i in range(d)) // max(d, 1) + 1
    bound = max(comb(d, k) * mean**k for k in range(d + 1))
    wanted = primes(bound.bit_length() + 1)

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"p": frame["p"], "c": [modular_polynomial(matrix, int(p)) for p in frame["p"]]})

    table = spark.createDataFrame([(p,) for p in wanted], "p long").repartition(min(len(wanted), 64), "p")
    value, modulus = [0] * (d + 1), 1
    for row in sorted(table.mapInPandas(residues, "p long, c array<long>").collect()):
        inverse = pow(modulus, -1, row["p"])
        value = [v + modulus * ((c - v) * inverse % row["p"]) for v, c in zip(value, row["c"], strict=True)]
        modulus *= row["p"]
    return [v - modulus if 2 * v > modulus else v for v in value]


def _shifted(poly: list[int], a: int) -> list[int]:
    """Coefficients of poly(x + a)."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    return c


def count_above(poly: list[int], a: int) -> int:
    """Roots above ``a``, with multiplicity, of a polynomial with real roots only."""
    signs = [c > 0 for c in _shifted(poly, a) if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], a: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * a + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], wanted: int) -> list[tuple[Decimal, int]]:
    """(root, multiplicity) of the positive roots from the largest down, until
    ``wanted`` are covered.  All roots of ``poly`` are real and none is negative."""
    zeros = next((i for i, c in enumerate(poly) if c), len(poly) - 1)
    poly = poly[zeros:]
    wanted = min(wanted, len(poly) - 1)
    scale = BITS
    while True:
        spans = _isolate([c << scale * (len(poly) - 1 - i) for i, c in enumerate(poly)], wanted)
        if all(low >> BITS for low, _ in spans):
            break
        scale *= 2  # a root below 1: a finer grid
    with localcontext() as ctx:
        ctx.prec = DIGITS
        return [((Decimal(2 * low + 1) / 2) / (Decimal(2) ** scale), m) for low, m in spans]


def _isolate(poly: list[int], wanted: int) -> list[tuple[int, int]]:
    """(low, multiplicity): the root lies in (low, low + 1]; largest first."""
    high = 1 + sum(abs(c) for c in poly[-2:-1])  # the sum of the roots
    found: list[tuple[int, int]] = []
    todo = [(0, high, wanted and len(poly) - 1, 0)]  # low, high, roots above either
    while todo and sum(m for _, m in found) < wanted:
        low, high, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1 or high - low == 1:
            found.append((_refine(poly, low, high) if inside == 1 else low, inside))
            continue
        middle = (low + high) // 2
        above = count_above(poly, middle)
        todo += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def _refine(poly: list[int], low: int, high: int) -> int:
    """The grid cell (x, x + 1] of the one root in (low, high]."""
    at_high = _sign(poly, high)
    if at_high == 0:
        return high - 1
    while high - low > 1:
        middle = (low + high) // 2
        s = _sign(poly, middle)
        if s == 0:
            return middle - 1
        low, high = (low, middle) if s == at_high else (middle, high)
    return low


def null_vectors(matrix: list[list[int]], root: Decimal, multiplicity: int) -> np.ndarray:
    """Orthonormal rows spanning the eigenvectors of ``root``: solves against the
    shifted matrix, factored once, in ``DIGITS`` digits, until a vector stays."""
    d = len(matrix)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        a = np.array([[Decimal(x) for x in row] for row in matrix], object)
        tiny = max(abs(root), Decimal(1)) * Decimal(10) ** (-DIGITS + 10)
        a[np.arange(d), np.arange(d)] -= root
        order = np.arange(d)
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(a[i, k]))
            if best != k:
                a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(d):
                x[k + 1 :] -= a[k + 1 :, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / a[k, k]
                x[:k] -= a[:k, k] * x[k]
            return x

        start = np.random.default_rng(d).standard_normal((multiplicity, d))
        basis: list[np.ndarray] = []
        for row in start:
            v, close = np.array([Decimal(float(x)) for x in row], object), Decimal(10) ** -25
            for _ in range(60):
                last = v = _unit(v, basis)
                v = _unit(solve(v), basis)
                if v.dot(last) < 0:
                    v = -v
                if max(abs(v - last)) < close:
                    break
            basis.append(v)
        return np.array([[float(x) for x in v] for v in basis])


def _unit(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for b in basis:
        v = v - b * b.dot(v)
    return v / v.dot(v).sqrt()
