"""Exact characteristic polynomials of integer matrices, their real roots, and null vectors at those roots.

Small linear algebra on one matrix of the vectors' dimension, for the tasks of ``whitening``: nothing here sees rows.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from math import comb

import numpy as np


def primes_below(start: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``start``, falling. ``start`` is at most 2**31, so 16-bit factors decide."""
    sieve = np.ones(1 << 16, dtype=bool)
    sieve[:2] = False
    for i in range(2, 1 << 8):
        if sieve[i]:
            sieve[i * i :: i] = False
    factors, out, candidate = np.flatnonzero(sieve), [], start - 1
    while len(out) < count:
        rest = candidate % factors
        if candidate > 1 and (rest[factors * factors <= candidate] != 0).all():
            out.append(candidate)
        candidate -= 1
    return out


def coefficient_bits(trace: int, dim: int) -> int:
    """Bits that hold every coefficient of a positive semidefinite matrix: |c_k| <= C(dim, k) (trace / dim)^k."""
    mean = -(-trace // max(dim, 1)) + 1
    return max(comb(dim, k).bit_length() + k * mean.bit_length() for k in range(dim + 1)) + 2


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - matrix) modulo ``p`` < 2**31, constant first, by way of a similar Hessenberg matrix."""
    h, n = matrix.astype(np.int64) % p, len(matrix)
    for m in range(1, n - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        at = m + int(below[0])
        if at != m:
            h[[m, at]] = h[[at, m]]
            h[:, [m, at]] = h[:, [at, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    # polys[k] is the polynomial of the leading k x k block.
    polys = np.zeros((n + 1, n + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, n + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        factor, column = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):
            column[i] = h[i, k - 1] * factor % p
            if i:
                factor = factor * int(h[i, i - 1]) % p
        polys[k] = (polys[k] - (column[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[n]


def combined(residues: dict[int, list[int]]) -> list[int]:
    """The integers of least size with the given residues: {prime: residue of each}."""
    values, modulus = [0] * len(next(iter(residues.values()))), 1
    for p, rest in residues.items():
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((int(r) - v) * inverse % p) for v, r in zip(values, rest, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def _scaled(poly: list[int], bits: int) -> list[int]:
    """2^(bits * degree) poly(y / 2^bits), as a polynomial in y."""
    return [c << (bits * (len(poly) - 1 - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots exceed ``at``, repeated ones counted, if all are real: the sign changes of poly(x + at)."""
    c, n = list(poly), len(poly)
    for i in range(n - 1):
        for j in range(n - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], at: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * at + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, bits: int) -> list[tuple[int, int, int]]:
    """The ``count`` largest positive roots of a polynomial whose roots are all real: (numerator, fraction bits, how often).

    A root lies less than 2**-bits of itself from numerator / 2**fraction bits. Intervals are halved until a root stands
    alone, by counting the roots above their ends, then by the sign at the middle. Roots that share an interval of
    the last size are one repeated root. A repeated root is listed once, also where that makes more than ``count``.
    """
    bound = 1
    while roots_above(poly, bound):
        bound *= 2
    out: list[tuple[int, int, int]] = []
    work = [(0, bound, 0, roots_above(poly, 0))]  # (low, high, fraction bits, roots in (low, high])
    while work and sum(r[2] for r in out) < count:
        low, high, fraction, inside = work.pop()
        if not inside:
            continue
        if low and (high - low) << bits <= low:
            out.append((high, fraction, inside))
            continue
        if high - low == 1:
            low, high, fraction = 2 * low, 2 * high, fraction + 1
        scaled, middle = _scaled(poly, fraction), (low + high) // 2
        if inside == 1 and (upper := _sign(scaled, high)):
            # One root: the sign at the middle says on which side it lies.
            at_middle = _sign(scaled, middle)
            work.append((middle, high, fraction, 1) if at_middle == -upper else (low, middle, fraction, 1))
            continue
        above = roots_above(scaled, middle) - roots_above(scaled, high)
        work += [(low, middle, fraction, inside - above), (middle, high, fraction, above)]
    return out


def null_space(matrix: list[list[int]], root: tuple[int, int, int], digits: int, rounds: int = 3) -> np.ndarray:
    """Orthonormal vectors v with matrix v = root v, as many as the root counts, by inverse iteration in ``digits`` digits."""
    numerator, fraction, often = root
    n = len(matrix)
    with localcontext() as context:
        context.prec = digits
        shift = Decimal(numerator) / Decimal(1 << fraction)
        scale = Decimal(max(1, max(abs(x) for row in matrix for x in row)))
        a = [[(Decimal(x) - (shift if i == j else 0)) / scale for j, x in enumerate(row)] for i, row in enumerate(matrix)]
        tiny, order = Decimal(10) ** -digits, list(range(n))
        for k in range(n):
            at = max(range(k, n), key=lambda i: abs(a[i][k]))
            a[k], a[at], order[k], order[at] = a[at], a[k], order[at], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            pivot, row = a[k][k], a[k]
            for i in range(k + 1, n):
                factor = a[i][k] / pivot
                a[i][k] = factor
                if factor:
                    target = a[i]
                    for j in range(k + 1, n):
                        target[j] -= factor * row[j]

        def solve(b: list[Decimal]) -> list[Decimal]:
            y = [b[i] for i in order]
            for i in range(n):
                y[i] -= sum(a[i][j] * y[j] for j in range(i))
            for i in range(n - 1, -1, -1):
                y[i] = (y[i] - sum(a[i][j] * y[j] for j in range(i + 1, n))) / a[i][i]
            return y

        def orthonormal(vectors: list[list[Decimal]]) -> list[list[Decimal]]:
            done: list[list[Decimal]] = []
            for v in vectors:
                for _ in range(2):
                    for w in done:
                        along = sum(x * y for x, y in zip(v, w, strict=True))
                        v = [x - along * y for x, y in zip(v, w, strict=True)]
                size = sum(x * x for x in v).sqrt()
                done.append([x / size for x in v])
            return done

        rng = np.random.default_rng(1)
        vectors = [[Decimal(float(x)) for x in rng.standard_normal(n)] for _ in range(often)]
        for _ in range(rounds):
            vectors = orthonormal([solve(v) for v in vectors])
        return np.array([[float(x) for x in v] for v in vectors])
