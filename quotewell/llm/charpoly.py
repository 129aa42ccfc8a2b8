"""Eigenvalues and eigenvectors of a symmetric integer matrix, without rounding until the last step.

The characteristic polynomial is computed modulo many primes (reduction to Hessenberg form, then the recurrence over
leading blocks) and put together by Chinese remaindering. All its roots are real, so the sign changes of its
Taylor shift by x count the roots above x exactly: halving intervals by that count isolates them, and halving goes on to the wanted
precision. A root's eigenvectors come from inverse iteration on the matrix less the root, in fixed-point integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, isqrt

import numpy as np

BITS = 192  # of a root, counted from the matrix's trace
_WITNESSES = (2, 3, 5, 7)  # decide primality below 3,215,031,751


def is_prime(n: int) -> bool:
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in _WITNESSES:
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


def primes(bits: int) -> list[int]:
    """The largest primes below 2^31, downwards, until their product has so many bits."""
    out, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits that hold every coefficient and its sign: for roots of at least 0 with sum t the k-th is at most C(d, k) (t / d)^k."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    return max((comb(d, k) * trace**k // d**k + 1).bit_length() for k in range(d + 1)) + 2


def modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo the prime p, from x^0 up."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), p - 2, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k x k block
    poly[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, np.int64)
        new[1:] = poly[k - 1, :-1]
        new = (new - h[k - 1, k - 1] * poly[k - 1] % p) % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            new = (new - (int(h[i - 1, k - 1]) * chain % p) * poly[i - 1] % p) % p
        poly[k] = new
    return poly[d].tolist()


def combined(residues: dict[int, list[int]]) -> list[int]:
    """The integers, of either sign, that leave these residues modulo each prime."""
    whole = 1
    for p in residues:
        whole *= p
    out = [0] * len(next(iter(residues.values())))
    for p, row in residues.items():
        rest = whole // p
        part = rest * pow(rest, -1, p)
        out = [a + part * b for a, b in zip(out, row)]
    return [v - whole if (v := a % whole) > whole // 2 else v for a in out]


class Roots:
    """Roots of a polynomial (integer coefficients from x^0 up, leading one 1) that are all real and at least 0.

    Numbers are integers over 2^scale.
    """

    def __init__(self, coefficients: list[int]):
        self.zeros = next(i for i, c in enumerate(coefficients) if c)
        self.c = coefficients[self.zeros :]
        self.degree = len(self.c) - 1
        self.total = -self.c[-2] if self.degree else 0  # their sum
        self.scale = max(0, BITS - self.total.bit_length())

    def _scaled(self, x: int) -> tuple[int, list[int]]:
        """x with its trailing zeros taken off, and the coefficients of the polynomial of roots as large as it is then."""
        shift = min(self.scale, (x & -x).bit_length() - 1) if x else self.scale
        s = self.scale - shift
        return x >> shift, [c << s * (self.degree - i) for i, c in enumerate(self.c)]

    def above(self, x: int) -> int:
        """Roots above x, with their multiplicity: the sign changes of the polynomial shifted by x."""
        x, c = self._scaled(x)
        for i in range(self.degree):
            for j in range(self.degree - 1, i - 1, -1):
                c[j] += x * c[j + 1]
        signs = [v > 0 for v in c if v]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def positive(self, x: int) -> bool:
        """Whether the polynomial is above 0 there."""
        x, c = self._scaled(x)
        value = 0
        for v in reversed(c):
            value = value * x + v
        return value > 0

    def largest(self, count: int) -> Iterator[tuple[int, int]]:
        """(root, multiplicity), falling, until `count` roots above 0 are out. Roots that agree in all bits are one."""
        left = min(count, self.degree)
        todo = [(0, 1 << (self.total.bit_length() + self.scale), self.degree, 0)] if left else []
        while todo and left > 0:
            low, high, from_low, from_high = todo.pop()
            n = from_low - from_high
            if not n:
                continue
            if high - low > 1 and n > 1:
                middle = (low + high) // 2
                at = self.above(middle)
                todo += [(low, middle, from_low, at), (middle, high, at, from_high)]
                continue
            if high - low > 1:  # alone: the sign tells on which side it lies; beyond it the sign is (-1)^from_high
                beyond = from_high % 2 == 0
                if high == 1 << (self.total.bit_length() + self.scale) or not self._vanishes(high):
                    while high - low > 1:
                        middle = (low + high) // 2
                        if self._vanishes(middle):
                            high = low = middle
                        elif self.positive(middle) == beyond:
                            high = middle
                        else:
                            low = middle
            yield high, n
            left -= n

    def _vanishes(self, x: int) -> bool:
        x, c = self._scaled(x)
        value = 0
        for v in reversed(c):
            value = value * x + v
        return value == 0


def eigenvectors(matrix: list[list[int]], root: int, scale: int, count: int, bits: int = 2 * BITS) -> list[list[float]]:
    """`count` orthonormal vectors that the matrix maps to root / 2^scale times themselves.

    Inverse iteration: a triangular factorisation of the matrix less the root, with row exchanges, solved twice for each
    start vector, made orthogonal to the ones before.
    """
    d = len(matrix)
    a = np.array([[v << bits for v in row] for row in matrix], object)
    for i in range(d):
        a[i, i] -= root << (bits - scale) if bits >= scale else root >> (scale - bits)
    steps: list[tuple[int, np.ndarray]] = []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
        if not a[k, k]:
            a[k, k] = 1  # as near to singular as the fixed point can tell
        factor = (a[k + 1 :, k] << bits) // a[k, k]
        a[k + 1 :, k + 1 :] -= (factor[:, None] * a[k, k + 1 :]) >> bits
        steps.append((pivot, factor))

    def unit(v: np.ndarray) -> np.ndarray:
        length = isqrt(int((v * v).sum())) or 1
        return (v << bits) // length

    def solved(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for k, (pivot, factor) in enumerate(steps):
            v[[k, pivot]] = v[[pivot, k]]
            v[k + 1 :] -= (factor * v[k]) >> bits
        for k in range(d - 1, -1, -1):
            rest = v[k] - (int((a[k, k + 1 :] * v[k + 1 :]).sum()) >> bits)
            v[k] = (rest << bits) // a[k, k]
        return unit(v)

    found: list[np.ndarray] = []
    for m in range(count):
        # Start vectors without a pattern that an eigenvector might be at right angles to.
        v = unit(np.array([1 + (i * 2654435761 + m * 40503 + i * i * 97) % 65521 for i in range(d)], object))
        for _ in range(3):
            v = solved(v)
            for w in found:
                v = v - ((w * (int((v * w).sum()) >> bits)) >> bits)
            v = unit(v)
        found.append(v)
    return [[float(int(x) / (1 << bits)) for x in v] for v in found]
