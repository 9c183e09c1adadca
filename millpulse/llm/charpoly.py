"""Exact eigenvalues and high-precision eigenvectors of symmetric integer matrices.

The characteristic polynomial comes from its residues modulo primes (Hessenberg
form, then its recurrence) by the Chinese remainder theorem.  All its roots are
real, so by Descartes' rule the sign changes of ``p(x + a)`` are exactly the roots
above ``a``: bisection with integers isolates every root, with its multiplicity.
Components are null vectors of ``M - root``, by inverse iteration in fixed-point
integers whose length follows the gap to the next root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import gcd, isqrt

import numpy as np

Poly = list[int]
"""Coefficients from the constant one up."""

#: Bits of a root, and of its distance to the next one, that are known after refinement.
REFINED = 96
GUARD = 160


# -- primes and residues ---------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.2e9."""
    if n % 2 == 0:
        return n == 2
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


def primes() -> Iterator[int]:
    """Primes below 2 ** 31, falling: products of two residues fit 62 bits."""
    n = (1 << 31) - 1
    while n > 1 << 30:
        if _is_prime(n):
            yield n
        n -= 2


def coefficient_bound(m: np.ndarray) -> int:
    """No coefficient of a positive semidefinite matrix's polynomial is larger: product of (1 + root) at most."""
    d, trace = len(m), int(sum(m[i, i] for i in range(len(m))))
    return (d + trace) ** d // d**d + 1


def enough_primes(bound: int) -> list[int]:
    """Primes whose product tells integers from -bound to bound apart."""
    out, product = [], 1
    for p in primes():
        out.append(p)
        product *= p
        if product > 2 * bound:
            return out
    raise ValueError("the matrix is too large for residues of 31 bits")


def characteristic_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Characteristic polynomial modulo p, by reduction to Hessenberg form."""
    a = np.array(m % p, dtype=np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            a[[k + 1, at]] = a[[at, k + 1]]
            a[:, [k + 1, at]] = a[:, [at, k + 1]]
        u = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :, k:] = (a[k + 2 :, k:] - u[:, None] * a[k + 1, k:][None, :] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * u[None, :] % p).sum(axis=1)) % p
    # polynomials of the leading blocks
    out = np.zeros((d + 1, d + 1), dtype=np.int64)
    out[0, 0] = 1
    for k in range(1, d + 1):
        out[k, 1:] = out[k - 1, :-1]
        out[k] = (out[k] - int(a[k - 1, k - 1]) * out[k - 1]) % p
        t = 1
        for i in range(1, k):
            t = t * int(a[k - i, k - i - 1]) % p
            if not t:
                break
            out[k] = (out[k] - t * int(a[k - i - 1, k - 1]) % p * out[k - i - 1]) % p
    return out[d]


def from_residues(residues: dict[int, list[int]]) -> Poly:
    """The integers next to zero that have these residues, coefficient by coefficient."""
    product = 1
    for p in residues:
        product *= p
    total = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        rest = product // p
        unit = rest * pow(rest, -1, p)
        total = [t + int(v) * unit for t, v in zip(total, values, strict=True)]
    total = [t % product for t in total]
    return [t - product if 2 * t > product else t for t in total]


# -- roots -----------------------------------------------------------------------


def _trim(p: Poly) -> Poly:
    while p and p[-1] == 0:
        p = p[:-1]
    return p


def _remainder(a: Poly, b: Poly) -> Poly:
    """A primitive multiple of the remainder of a by b."""
    a = list(a)
    while len(a) >= len(b):
        lead, k = a[-1], len(a) - len(b)
        a = [x * b[-1] for x in a]
        for i, y in enumerate(b):
            a[k + i] -= lead * y
        a = _trim(a[:-1])
        if (g := gcd(*a)) > 1:
            a = [x // g for x in a]
    return a


def _common_factor_mod(a: Poly, b: Poly, p: int) -> int:
    """Degree of the greatest common divisor modulo p."""
    a, b = _trim([x % p for x in a]), _trim([x % p for x in b])
    while b:
        inv = pow(b[-1], -1, p)
        while len(a) >= len(b):
            f, k = a[-1] * inv % p, len(a) - len(b)
            for i, y in enumerate(b):
                a[k + i] = (a[k + i] - f * y) % p
            a = _trim(a[:-1])
        a, b = b, a
    return len(a) - 1


def squarefree(p: Poly) -> Poly:
    """The monic polynomial's distinct roots, each once."""
    slope = [i * c for i, c in enumerate(p)][1:]
    if not slope or _common_factor_mod(p, slope, next(primes())) == 0:
        return p
    a, b = p, slope
    while b:
        a, b = b, _remainder(a, b)
    a = [x // a[-1] for x in a]  # the divisor of a monic polynomial is monic
    out, rest = [0] * (len(p) - len(a) + 1), list(p)
    for k in range(len(out) - 1, -1, -1):
        out[k] = rest[k + len(a) - 1]
        for i, y in enumerate(a):
            rest[k + i] -= out[k] * y
    return out


def roots_above(p: Poly, at: int, shift: int) -> int:
    """Number of roots of a real-rooted polynomial above ``at / 2 ** shift``, with multiplicity."""
    d = len(p) - 1
    c = [x << (shift * (d - i)) for i, x in enumerate(p)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs[1:], signs[:-1], strict=True))


def _sign(p: Poly, at: int, shift: int) -> int:
    value, scale = 0, 1
    for c in reversed(p):
        value = value * at + c * scale
        scale <<= shift
    return (value > 0) - (value < 0)


class Root:
    """The only root in (low, low + 1] / 2 ** shift."""

    def __init__(self, p: Poly, low: int, high: int, shift: int):
        self.p, self.low, self.high, self.shift = p, low, high, shift
        #: sign right of the root, up to ``high`` included unless that is the root
        self.right = 0

    def halve(self) -> None:
        if not self.right:
            self.right = _sign(self.p, self.high, self.shift) or 2
        self.low, self.high, self.shift = 2 * self.low, 2 * self.high, self.shift + 1
        if self.right == 2:  # the upper end is the root
            self.low = self.high - (self.high - self.low) // 2
            return
        middle = (self.low + self.high) // 2
        sign = _sign(self.p, middle, self.shift)
        if sign == 0:
            self.low, self.high, self.right = middle - (self.high - middle), middle, 2
        elif sign == self.right:
            self.high = middle
        else:
            self.low = middle

    @property
    def width(self) -> Fraction:
        return Fraction(self.high - self.low, 1 << self.shift)

    @property
    def lower(self) -> Fraction:
        return Fraction(self.low, 1 << self.shift)

    @property
    def upper(self) -> Fraction:
        return Fraction(self.high, 1 << self.shift)

    @property
    def middle(self) -> Fraction:
        return (self.lower + self.upper) / 2


def largest_roots(p: Poly, most: int) -> list[tuple[Root, int, Fraction]]:
    """(root, multiplicity, gap to other roots) of the positive roots from the largest on, ``most`` of them with multiplicity."""
    zeros = next(i for i, c in enumerate(p) if c)
    p = p[zeros:]
    simple = squarefree(p)
    distinct = len(simple) - 1
    if not distinct:
        return []
    top = 1
    while roots_above(simple, top, 0):
        top *= 2
    counted = {(Fraction(0)): distinct, Fraction(top): 0}

    def above(at: Fraction) -> int:
        if at not in counted:
            counted[at] = roots_above(simple, at.numerator, at.denominator.bit_length() - 1)
        return counted[at]

    found: list[tuple[Root, int]] = []
    total = 0
    for t in range(1, distinct + 1):
        low = max(a for a, n in counted.items() if n >= t)
        high = min(a for a, n in counted.items() if n < t)
        while above(low) - above(high) > 1:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= t else (low, middle)
        shift = max(low.denominator, high.denominator).bit_length() - 1
        ends = [int(x * (1 << shift)) for x in (low, high)]
        times = 1 if distinct == len(p) - 1 else roots_above(p, ends[0], shift) - roots_above(p, ends[1], shift)
        found.append((Root(simple, *ends, shift), times))
        if total >= most:  # one more than asked for, for the last one's gap
            break
        total += times
    # apart from each other and from zero, then as sharp as the gaps ask for
    edges = [r for r, _ in found]
    while True:
        gaps = [a.lower - b.upper for a, b in zip(edges[:-1], edges[1:], strict=True)] + [edges[-1].lower]
        if all(g > 0 and g >= max(a.width, b.width) for g, a, b in zip(gaps, edges, [*edges[1:], edges[-1]], strict=True)):
            break
        for r in edges:
            r.halve()
    out, total = [], 0
    for k, (root, times) in enumerate(found):
        if total >= most:
            break
        gap = min(gaps[k], *(gaps[k - 1 : k] or [gaps[k]]))
        while root.width * (1 << REFINED) > min(gap, root.lower):
            root.halve()
        out.append((root, times, gap))
        total += times
    return out


# -- components ------------------------------------------------------------------


def _bits(x: Fraction) -> int:
    return x.numerator.bit_length() - x.denominator.bit_length()


class _Factors:
    """Rows exchanged triangular factors of a fixed-point matrix."""

    def __init__(self, a: np.ndarray, point: int):
        self.a, self.point, self.swaps = a, point, []
        d = len(a)
        for k in range(d):
            at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            self.swaps.append(at)
            if at != k:
                a[[k, at]] = a[[at, k]]
            if not a[k, k]:
                a[k, k] = 1  # the root is exact: any small pivot leads to its null space
            if k + 1 < d:
                a[k + 1 :, k] = (a[k + 1 :, k] << point) // a[k, k]
                a[k + 1 :, k + 1 :] -= (a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]) >> point

    def solve(self, b: np.ndarray) -> np.ndarray:
        b, d = b.copy(), len(b)
        for k, at in enumerate(self.swaps):  # rows were exchanged whole, factors with them
            if at != k:
                b[[k, at]] = b[[at, k]]
        for k in range(d - 1):
            b[k + 1 :] -= (self.a[k + 1 :, k] * b[k]) >> self.point
        for k in range(d - 1, -1, -1):
            b[k] = (b[k] << self.point) // self.a[k, k]
            b[:k] -= (self.a[:k, k] * b[k]) >> self.point
        return b


def _unit(v: np.ndarray, point: int) -> np.ndarray:
    """v in fixed point with length 1."""
    v = v >> max(0, max(abs(x) for x in v).bit_length() - 2 * point)
    norm = isqrt(sum(x * x for x in v))
    return (v << point) // norm


def null_vectors(m: np.ndarray, root: Root, times: int, gap: Fraction) -> np.ndarray:
    """Orthonormal eigenvectors (rows, doubles) of a root of the integer matrix ``m``."""
    size = max(abs(int(x)) for x in m.ravel()).bit_length()
    point = size + max(0, -_bits(gap)) + max(0, -_bits(root.lower)) + REFINED + GUARD
    shifted = m.astype(object) << point
    value = int(root.middle * (1 << point))
    for i in range(len(m)):
        shifted[i, i] -= value
    factors = _Factors(shifted, point)
    out: list[np.ndarray] = []
    for c in range(times):
        draw = [int.from_bytes(hashlib.sha256(f"{c} {i}".encode()).digest()[:8], "big") - (1 << 63) for i in range(len(m))]
        v = _unit(np.array(draw, dtype=object) << (point - 64), point)
        for _ in range(3):
            v = _unit(factors.solve(v), point)
            for u in out + out:
                v = v - ((u * (int((u * v).sum()) >> point)) >> point)
            v = _unit(v, point)
        out.append(v)
    return np.array([[float(Fraction(int(x), 1 << point)) for x in v] for v in out])
