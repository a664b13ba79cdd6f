"""Byte-level BPE: encoding and decoding by a rank file.

Text is cut by the public pattern; each piece is encoded on its own in two tiers. A minimal perfect
hash over the vocabulary (hash and displace, one slot per token) answers pieces that are tokens in
one probe. All others are merged: bytes form a linked list, a heap holds the adjacent pairs that are
tokens, and the lowest rank (leftmost of equals) is merged first. The memory of a merge grows with
its piece only.

The vocabulary has a fixed size; its tables are broadcast once.

Edge cases. Null and empty texts have no ids and decode to no bytes. A piece of any length (a text of
one word) is merged in n log n steps. Repeated rows are encoded one by one; an empty table gives an
empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MEMO = 1 << 19

def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a public rank file (base64 and number per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash: n keys in n slots, by hash and displace.

    Buckets are placed from the largest down. A bucket's displacement is the first that sends all its
    keys to free slots; a bucket of one key names its slot directly (as a negative number). Slots are
    counted modulo the next prime, so that a displacement can reach every slot.
    """

    def __init__(self, tokens: dict[bytes, int]):
        keys = sorted(tokens)
        n = self.n = len(keys)
        self.buckets = max(1, n // 3)
        self.prime = next(p for p in range(max(n, 5), 2 * n + 6) if all(p % q for q in range(2, int(p**0.5) + 1)))
        for self.seed in range(1000):  # a seed fails if two keys always go to the same slot
            slot_of = self._placed(np.array([xxhash.xxh3_64_intdigest(k, self.seed) for k in keys], np.uint64))
            if slot_of is not None:
                break
        else:
            raise ValueError("no seed separates the tokens")
        self.keys: list = [b""] * n
        self.ids = [0] * n
        for k, s in zip(keys, slot_of.tolist()):
            self.keys[s], self.ids[s] = k, tokens[k]
        self.shift = self.shift.tolist()

    def _placed(self, h: np.ndarray) -> np.ndarray | None:
        """Slot of each key for these hashes; sets ``shift``."""
        n = self.n
        base, step = h >> np.uint64(33), (h & np.uint64(0x7FFFFFFF)) % np.uint64(self.prime - 1) + np.uint64(1)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.cumsum(np.bincount(bucket, minlength=self.buckets))[:-1])
        free, self.shift = np.arange(self.prime) < n, np.zeros(self.buckets, np.int64)
        slot_of = np.zeros(n, np.int64)
        for b in sorted(range(self.buckets), key=lambda i: -len(groups[i])):
            g, d, placed = groups[b], 0, len(groups[b]) < 2
            while not placed and d < self.prime + 256:
                tries = np.arange(d, d + 256, dtype=np.uint64)
                at = ((base[g][None] + tries[:, None] * step[g][None]) % np.uint64(self.prime)).astype(np.int64)
                for i in np.flatnonzero(free[at].all(axis=1)):
                    if len({*at[i].tolist()}) == len(g):
                        free[at[i]] = False
                        slot_of[g], self.shift[b], placed = at[i], d + int(i), True
                        break
                d += 256
            if not placed:
                return None
        left = iter(np.flatnonzero(free).tolist())
        for b in range(self.buckets):
            if len(groups[b]) == 1:
                s = next(left)
                slot_of[groups[b]], self.shift[b] = s, -s - 1
        return slot_of

    def get(self, key: bytes) -> int | None:
        """The key's id, or None."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else ((h >> 33) + d * ((h & 0x7FFFFFFF) % (self.prime - 1) + 1)) % self.prime
        return self.ids[s] if s < self.n and self.keys[s] == key else None


class Bpe:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = PerfectHash(ranks), pattern
        self.tokens: list = [None] * (1 + max(ranks.values()))
        for k, i in ranks.items():
            self.tokens[i] = k
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        self.bytes = [self.ranks.get(bytes((i,))) for i in range(256)]
        self.pairs = [self.ranks.get(bytes((i >> 8, i & 255))) for i in range(1 << 16)]  # for the first pass over a piece

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token: lowest rank first, by a heap over linked bytes.

        ``pair`` has the rank that a byte's token and the next one form, ``at`` the token that begins
        there; a heap entry counts only while its pair still has that rank.
        """
        rank, pairs, n = self.ranks.get, self.pairs, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        at = [self.bytes[c] for c in piece]
        pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        heap = [r * n + i for i, r in enumerate(pair) if r is not None]
        pair.append(None)
        heapify(heap)
        while heap:
            r, i = divmod(heappop(heap), n)
            if pair[i] != r:
                continue
            j = after[i]
            k = after[i] = after[j]
            at[i], pair[j] = r, None
            if k < n:
                before[k] = i
                q = pair[i] = rank(piece[i:after[k]])
                if q is not None:
                    heappush(heap, q * n + i)
            else:
                pair[i] = None
            p = before[i]
            if p >= 0:
                q = pair[p] = rank(piece[p:k])
                if q is not None:
                    heappush(heap, q * n + p)
        out, i = [], 0
        while i < n:
            out.append(at[i])
            i = after[i]
        if None in out:
            raise ValueError("the vocabulary lacks a single byte")
        return out

    def piece(self, piece: bytes) -> list[int]:
        r = self.ranks.get(piece)
        return [r] if r is not None else self.merge(piece)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class Memo(dict):
    """key -> what ``of`` says of it; emptied when full, which costs time only."""

    def __init__(self, of, most: int = MEMO, longest: int = 64):
        super().__init__()
        self.of, self.most, self.longest = of, most, longest

    def __missing__(self, key):
        out = self.of(key)
        if len(self) >= self.most:
            self.clear()
        if len(key) <= self.longest:
            self[key] = out
        return out


class Encoder:
    """Texts -> ids as little-endian 32-bit bytes.

    A space between two characters that are no white space always begins a piece, so a text can be
    cut there first and what stands between two cuts looked up whole.
    """

    def __init__(self, bpe: Bpe):
        self.bpe, self.pieces = bpe, regex.compile(bpe.pattern)
        self.cuts = re.compile(r"(?<=\S) (?=\S)")
        self.known = Memo(lambda p: b"".join(map(bpe.packed.__getitem__, bpe.piece(p.encode()))), 1 << 20)
        self.first, self.rest = Memo(self._unit), Memo(lambda u: self._unit(u, " "))

    def _all(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pieces.findall(text)))

    def _unit(self, unit: str, before: str = "") -> bytes | None:
        """Ids of what stands between two spaces; None if white space touches one of them."""
        if not unit or unit[0].isspace() or unit[-1].isspace():
            return None
        return self._all(before + unit)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        units = text.split(" ")
        try:
            return b"".join((self.first[units[0]], *map(self.rest.__getitem__, units[1:])))
        except TypeError:  # a unit is None
            units = self.cuts.split(text)
            if len(units) == 1:
                return self._all(text)
            return b"".join((self._all(units[0]), *map(self.rest.__getitem__, units[1:-1]), self._all(" " + units[-1])))


def _encoder(shared) -> Encoder:
    """This worker's lookup tables, kept from task to task for one vocabulary."""
    name, bpe = shared.value
    return common.kept(f"bpe:{name}", lambda: Encoder(bpe))


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per document: doc_id, ids (binary, little-endian unsigned 32-bit)."""
    return _run(documents, ranks, pattern, False)


def round_trip(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """As ``encode``, and ``decoded``: the bytes that decoding these ids gives."""
    return _run(documents, ranks, pattern, True)


def _run(documents, ranks, pattern, back):
    common.ship(documents.sparkSession)
    name = xxhash.xxh3_64_hexdigest(repr((sorted(ranks.items()), pattern)))
    shared = documents.sparkSession.sparkContext.broadcast((name, Bpe(ranks, pattern)))

    def run(texts):
        own = _encoder(shared)
        ids = [own.encode(t) for t in texts]
        out = [pa.array(ids, pa.binary())]
        if back:
            out.append(pa.array([own.bpe.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()))
        return out

    return common.map_texts(documents, run, "doc_id long, ids binary" + ", decoded binary" * back)


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a round trip."""
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
