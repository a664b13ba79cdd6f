"""Blocked Bloom filters over words, sharded by word length, probed with all one-letter edits at once.

A word's hash is a polynomial over its code points modulo 2^64, so the hash of an edited word follows from
prefix and suffix sums without writing the word. A filter is made of blocks of 256 bits; a key sets one bit
in each of a block's eight 32-bit lanes. Each length has filters of its own, cut into equal parts where
one would outgrow a round; a round holds filters of bounded size, and all rounds together hold all words.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LANES = 8
BITS_PER_WORD = 16
BLOCK_BYTES = 4 * LANES
_GOLDEN = 0x9E3779B97F4A7C15  # odd, near 2^64 divided by the golden ratio
BASE = np.uint64(_GOLDEN)
_INVERSE = np.uint64(pow(_GOLDEN, -1, 1 << 64))
_ODD = np.uint64(pow(_GOLDEN, 3, 1 << 64))
SALTS = np.array([pow(0x9E3779B1, j + 1, 1 << 32) for j in range(LANES)], np.uint32)


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * BASE
    return h ^ (h >> np.uint64(32))


def keys(m: np.ndarray) -> np.ndarray:
    return mixed((m * powers(m.shape[1])).sum(axis=1, dtype=np.uint64))


def deletions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys with one place left out, marks of the first of equal neighbours), a column per place."""
    terms = m * powers(m.shape[1])
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    after = before[:, -1:] - before
    first = np.ones(m.shape, bool)
    first[:, 1:] = m[:, 1:] != m[:, :-1]
    return mixed(before - terms + after * _INVERSE), first


def replacements(m: np.ndarray, letter: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys with ``letter`` at one place, marks of places with a smaller one), a column per place."""
    at = powers(m.shape[1])
    whole = (m * at).sum(axis=1, dtype=np.uint64)
    c = np.uint64(letter)
    return mixed(whole[:, None] + (c - m) * at), m < c


@dataclass
class Round:
    """Filters of some lengths (or parts of a length) in one array of blocks."""
    parts: dict[int, int] = field(default_factory=dict)  # length -> number of parts it is cut into
    first: dict[tuple[int, int], int] = field(default_factory=dict)  # (length, part) -> first block
    blocks: dict[tuple[int, int], int] = field(default_factory=dict)  # (length, part) -> number of blocks
    total: int = 0

    def place(self, length: int, key: np.ndarray) -> np.ndarray:
        """Block of each key of words of ``length``; -1 where this round does not hold its part."""
        n = self.parts.get(length, 0)
        if not n:
            return np.full(key.shape, -1, np.int64)
        first = np.array([self.first.get((length, j), -1) for j in range(n)], np.int64)
        blocks = np.array([self.blocks.get((length, j), 0) for j in range(n)], np.uint64)
        part = ((key * _ODD) >> np.uint64(40)) % np.uint64(n)
        part = part.astype(np.int64)
        at = ((key >> np.uint64(32)) * blocks[part]) >> np.uint64(32)
        return np.where(first[part] < 0, -1, first[part] + at.astype(np.int64))


def plan(counts: dict[int, int], max_bytes: int) -> list[Round]:
    """Rounds of at most ``max_bytes`` of filters (one block at least) for so many words of each length."""
    room = max(1, max_bytes // BLOCK_BYTES)
    rounds = []
    for length, n in sorted(counts.items()):
        need = max(1, -(-n * BITS_PER_WORD // (8 * BLOCK_BYTES)))
        parts = -(-need // room)
        size = -(-need // parts)
        for j in range(parts):
            if not rounds or rounds[-1].total + size > room:
                rounds.append(Round())
            r = rounds[-1]
            r.parts[length] = parts
            r.first[length, j], r.blocks[length, j] = r.total, size
            r.total += size
    return rounds


def lanes(key: np.ndarray) -> np.ndarray:
    """Bit of each lane, as (keys, LANES) of uint32."""
    low = key.astype(np.uint32)
    return np.uint32(1) << ((low[:, None] * SALTS[None, :]) >> np.uint32(27))


def probe(filters: np.ndarray, block: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of the keys that the filters may hold: lane by lane, only what passed before goes on."""
    at = np.flatnonzero(block >= 0)
    low, row = key[at].astype(np.uint32), block[at]
    for j in range(LANES):
        bit = (low * SALTS[j]) >> np.uint32(27)
        hit = (filters[row, j] >> bit) & np.uint32(1) == 1
        at, low, row = at[hit], low[hit], row[hit]
    return at
