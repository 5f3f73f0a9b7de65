"""Exact characteristic polynomials of integer matrices, their real roots and eigenvectors.

Residues of the polynomial modulo 31-bit primes come from Hessenberg reduction, one prime per
unit of work; Chinese remaindering gives the integer coefficients. All roots of a symmetric
matrix are real, so the sign changes of the polynomial shifted by ``a`` count its roots above
``a`` exactly, with multiplicity. Intervals are halved until each holds one root, and further by
the sign of the polynomial alone. What the driver holds depends on the dimension only (its
square times the digits of an entry), never on the number of rows.
"""

from __future__ import annotations

import decimal
import random
from decimal import Decimal

import numpy as np

# Roots are known to this many bits; closer ones count as one root of their multiplicity.
BITS = 160


def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide all numbers below 3,215,031,751."""
    d, twos = n - 1, 0
    while d % 2 == 0:
        d, twos = d // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2**31, the largest first, whose product exceeds ``bound``, and one more."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    while not is_prime(n):
        n -= 2
    return [*out, n]


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients (constant first) of det(x - matrix) modulo a prime below 2**31."""
    h, d = matrix.copy(), len(matrix)
    for k in range(d - 2):
        nonzero = np.flatnonzero(h[k + 1 :, k])
        if not len(nonzero):
            continue
        i = k + 1 + int(nonzero[0])
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    # Polynomials of the leading blocks, each from all before it.
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        new = np.r_[0, poly[k - 1, :-1]] - poly[k - 1] * int(h[k - 1, k - 1]) % p
        chain, factors = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            factors[i] = int(h[i, k - 1]) * chain % p
        poly[k] = (new - (factors[:, None] * poly[: k - 1] % p).sum(axis=0)) % p
    return poly[d].tolist()


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """Integers of least absolute value with the given residues by prime."""
    product = 1
    for p in residues:
        product *= p
    parts = [(product // p) * pow(product // p, -1, p) for p in residues]
    out = []
    for values in zip(*residues.values()):
        x = sum(v * part for v, part in zip(values, parts)) % product
        out.append(x - product if 2 * x > product else x)
    return out


def roots_above(poly: list[int], at: int, shift: int) -> int:
    """How many roots of a real-rooted polynomial exceed at / 2**shift, with multiplicity."""
    d = len(poly) - 1
    b = [c << (shift * (d - k)) for k, c in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            b[j] += at * b[j + 1]
    signs = [c > 0 for c in b if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value_sign(poly: list[int], at: int, shift: int) -> int:
    d, value = len(poly) - 1, 0
    for k in range(d, -1, -1):
        value = value * at + (poly[k] << (shift * (d - k)))
    return (value > 0) - (value < 0)


def halved(low: int, high: int, shift: int) -> tuple[int, int, int]:
    """The same interval on a grid on which it can be halved."""
    return (2 * low, 2 * high, shift + 1) if high - low == 1 else (low, high, shift)


def largest_roots(poly: list[int], top: int, k: int, bits: int = BITS) -> list[tuple[int, int, int]]:
    """(numerator, shift, multiplicity) of the distinct roots in (0, top] that hold the k largest.

    A root is numerator / 2**shift, to ``bits`` bits.
    """
    found, todo = [], [(0, top, 0, roots_above(poly, 0, 0), 0)]
    while todo:
        low, high, shift, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside or above_high >= k:
            continue
        if inside == 1 or (high - low) << bits <= low:
            found.append((low, high, shift, inside, above_high))
            continue
        low, high, shift = halved(low, high, shift)
        middle = (low + high) // 2
        above = roots_above(poly, middle, shift)
        # The upper half is taken first.
        todo += [(low, middle, shift, above_low, above), (middle, high, shift, above, above_high)]
    out = []
    for low, high, shift, inside, above_high in found:
        side = -1 if above_high % 2 else 1
        while inside == 1 and (high - low) << bits > low:
            low, high, shift = halved(low, high, shift)
            middle = (low + high) // 2
            sign = value_sign(poly, middle, shift)
            if not sign:
                low = high = middle
            elif sign == side:
                high = middle
            else:
                low = middle
        out.append((low + high, shift + 1, inside))
    return out


def null_vectors(matrix: list[list[int]], root: Decimal, count: int, digits: int) -> list[list[Decimal]]:
    """``count`` orthonormal vectors of the null space of matrix - root, by inverse iteration."""
    with decimal.localcontext() as context:
        context.prec = digits
        d = len(matrix)
        a = np.array([[Decimal(x) for x in row] for row in matrix], object)
        for i in range(d):
            a[i, i] -= root
        scale = max(map(abs, a.ravel())) or Decimal(1)
        tiny, order = scale.scaleb(8 - digits), list(range(d))
        for i in range(d):
            pivot = i + max(range(d - i), key=lambda j: abs(a[i + j, i]))
            if pivot != i:
                a[[i, pivot]] = a[[pivot, i]]
                order[i], order[pivot] = order[pivot], order[i]
            if abs(a[i, i]) < tiny:
                a[i, i] = tiny
            if i + 1 < d:
                a[i + 1 :, i] = a[i + 1 :, i] / a[i, i]
                a[i + 1 :, i + 1 :] -= a[i + 1 :, i][:, None] * a[i, i + 1 :]
        rng = random.Random(1)
        block = [np.array([Decimal(rng.randint(1, 1 << 30)) for _ in range(d)], object) for _ in range(count)]
        for _ in range(3):
            done: list[np.ndarray] = []
            for b in block:
                x = b[order]
                for i in range(1, d):
                    x[i] -= (a[i, :i] * x[:i]).sum()
                for i in range(d - 1, -1, -1):
                    rest = (a[i, i + 1 :] * x[i + 1 :]).sum() if i + 1 < d else Decimal(0)
                    x[i] = (x[i] - rest) / a[i, i]
                x = x / max(map(abs, x))
                for other in done:
                    x = x - (x * other).sum() * other
                done.append(x / (x * x).sum().sqrt())
            block = done
        return [list(b) for b in block]
