"""Helpers for tables of vectors (vec_id, embedding, ...)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: str = "embedding") -> Column:
    """Not null, not empty, all components finite, not all zero."""
    e = F.col(embedding)
    broken = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(e.isNotNull() & ~broken & F.exists(e, lambda x: x != 0), F.lit(False))


def matrix(blob: bytes, dim: int, kind: str = "<f4") -> np.ndarray:
    """Rows of a packed block, in double precision."""
    return np.frombuffer(blob, kind).reshape(-1, dim).astype(np.float64)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two that brings their largest component near 1: cosines stay the same, and neither
    squares of very large nor of very small components leave the range of doubles."""
    top = np.abs(x).max(axis=1, initial=0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def farthest_first(x: np.ndarray, most: int, radius: float) -> np.ndarray:
    """A net: rows of ``x`` picked farthest first until all lie within ``radius`` or ``most`` are picked."""
    picked, near = [0], np.full(len(x), np.inf)
    while len(picked) < min(most, len(x)):
        near = np.minimum(near, np.linalg.norm(x - x[picked[-1]], axis=1))
        i = int(near.argmax())
        if near[i] <= radius:
            break
        picked.append(i)
    return np.array(picked)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest center, distance) per row, in slices of bounded memory."""
    at, dist = np.empty(len(x), np.int64), np.empty(len(x))
    step = max(1, (1 << 22) // max(1, len(centers)))
    for a in range(0, len(x), step):
        part = x[a:a + step]
        d = (part * part).sum(1)[:, None] + (centers * centers).sum(1)[None] - 2 * part @ centers.T
        at[a:a + step] = d.argmin(axis=1)
        dist[a:a + step] = np.linalg.norm(part - centers[at[a:a + step]], axis=1)
    return at, dist
