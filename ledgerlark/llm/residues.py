"""Exact integer matrix products in float32, by a residue number system.

Integers are taken modulo several small primes. A product of residues is at most (p / 2)^2, so a float32
product over few enough columns is exact; longer rows are cut into slabs that are reduced one by one. The
scores come back from their residues by Chinese remaindering with balanced digits: a score is
d0 + p0 (d1 + p1 (d2 + ...)), every digit between -(p - 1) / 2 and (p - 1) / 2, and that is the one signed
number below half the product of the primes.
"""

from __future__ import annotations

import numpy as np

#: float32 holds every integer up to here.
EXACT = 1 << 24


def primes_for(bound: int) -> list[int]:
    """The largest primes below 256 whose product exceeds twice ``bound`` (an upper bound of |score|)."""
    out, product = [], 1
    for p in range(255, 2, -1):
        if product > 2 * bound:
            break
        if all(p % q for q in range(2, 16) if q < p):
            out.append(p)
            product *= p
    if product <= 2 * bound:
        raise ValueError("scores of this size need more primes than lie below 256")
    return out


def centered(x: np.ndarray, p: int) -> np.ndarray:
    """Congruent to ``x`` modulo p, at most about p / 2; at most (p - 1) / 2 where |x| is below 2^21."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """One float32 matrix of balanced residues per prime."""
    out = []
    for p in primes:
        r = x % p
        out.append((r - p * (r > p // 2)).astype(np.float32))
    return out


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, balanced; ``a`` and ``b`` are balanced residues."""
    step = EXACT // (p // 2) ** 2
    total = np.zeros((len(a), len(b)), np.float32)
    for s in range(0, a.shape[1], step):
        total = centered(total + centered(a[:, s:s + step] @ b[:, s:s + step].T, p), p)
    return total


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """int64 matrix of inner products of the rows behind the residues ``a`` and ``b``."""
    digits = []
    for i, p in enumerate(primes):
        t = product_modulo(a[i], b[i], p)
        for q, d in zip(primes, digits):
            t = centered((t - d) * np.float32(pow(q, -1, p)), p)
        digits.append(t)
    out = digits[-1].astype(np.int64)
    for p, d in zip(primes[-2::-1], digits[-2::-1]):
        out = out * p + d.astype(np.int64)
    return out
