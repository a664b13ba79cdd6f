"""Suffix and common-prefix arrays by induced sorting, with queues on disk beyond a memory bound.

The text is a sequence of strings over non-negative integers; every string ends with a separator
(0). Separators are smaller than all else, differ from one another (the earlier is smaller), and
share no prefix, so no match crosses a string.

A suffix is S if it is smaller than its successor, else L; S* is an S after an L, or a separator. The S* suffixes
are ordered by naming the pieces between them and recursing on the names (in memory by prefix
doubling once they are few). From them all L suffixes follow left to right, and from these all S
suffixes right to left: taking the smallest (largest) suffix from a queue by first character
appends its predecessor to the queue of the predecessor's character. Queues hand out whole blocks
(all suffixes that are already in order), carry the common prefix with the queue's previous entry -
one more than the least value passed since that entry's source - and keep their tuples on disk beyond
a memory bound. Common prefixes are cut off at ``most``.

Only waiting blocks are on disk: the text, its types, the entries handed out and the result stay in memory,
about 80 bytes per position in all, whatever ``MEMORY`` says. A text must fit in memory.
"""

from __future__ import annotations

import bisect
import os
import tempfile

import numpy as np

MEMORY = 64 << 20  # bytes of queued tuples in memory, of one induction
IN_MEMORY = 1 << 22  # names that are ordered by doubling


class Spool:
    """Blocks of (position, common prefix) on disk, in an unnamed file of the executor's scratch folder."""

    def __init__(self):
        self.file, self.held = None, 0

    def put(self, block: np.ndarray) -> tuple[int, int]:
        if self.file is None:
            own = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            self.file = tempfile.TemporaryFile(dir=own if os.path.isdir(own) else None)
        at = self.file.seek(0, 2)
        block.tofile(self.file)
        return at, block.shape[1]

    def get(self, at: int, n: int) -> np.ndarray:
        self.file.seek(at)
        return np.fromfile(self.file, np.int64, 2 * n).reshape(2, n)


class Passed:
    """Least common prefixes of the blocks passed so far: a stack that only rises answers the least one since any of them."""

    def __init__(self):
        self.now, self.at, self.least = 0, [], []

    def put(self, least: int) -> None:
        while self.least and self.least[-1] >= least:
            self.at.pop()
            self.least.pop()
        self.at.append(self.now)
        self.least.append(least)
        self.now += 1

    def since(self, block: int, most: int) -> int:
        """The least value of the blocks from number ``block`` on; ``most`` if there are none."""
        i = bisect.bisect_left(self.at, block)
        return self.least[i] if i < len(self.at) else most


class Queue:
    """First in, first out, for one character."""

    def __init__(self, spool: Spool):
        self.spool, self.blocks, self.any = spool, [], False

    def put(self, block: np.ndarray) -> None:
        self.any = True
        if self.spool.held + block.nbytes > MEMORY:
            self.blocks.append(self.spool.put(block))
        else:
            self.spool.held += block.nbytes
            self.blocks.append(block)

    def take(self) -> np.ndarray | None:
        """All entries so far as one block; None if there are none."""
        if not self.blocks:
            return None
        got = []
        for b in self.blocks:
            if isinstance(b, tuple):
                got.append(self.spool.get(*b))
            else:
                self.spool.held -= b.nbytes
                got.append(b)
        self.blocks = []
        return np.concatenate(got, axis=1)


def types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S, length of the run of equal characters from here) per position."""
    n = len(text)
    ends = np.append(np.flatnonzero((text[1:] != text[:-1]) | (text[1:] == 0)), n - 1)  # last position of each run
    sizes = np.diff(np.append(-1, ends))
    after = np.append(text[ends[:-1] + 1], 0)
    rises = (after > text[ends]) | (text[ends] == 0)
    return np.repeat(rises, sizes), np.repeat(ends, sizes) - np.arange(n) + 1


def _names(text: np.ndarray, rises: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Ranks of the pieces from each S* to the next one; separators come first, each with its own name."""
    stop = np.append(stars[1:], len(text) - 1)
    wide = int(text.max()) * 2 + 2
    bits = max(1, int(wide).bit_length())
    per = max(1, 62 // bits)
    mark = text[stars] == 0
    rank = np.zeros(len(stars), np.int64)
    rank[mark] = np.arange(mark.sum())
    todo = np.flatnonzero(~mark)  # pieces whose place is not final
    rank[todo] = int(mark.sum())
    depth = 0
    while len(todo):
        word = np.zeros(len(todo), np.int64)
        for k in range(depth, depth + per):
            at = np.minimum(stars[todo] + k, len(text) - 1)
            code = text[at].astype(np.int64) * 2 + rises[at] + 1
            code[stars[todo] + k > stop[todo]] = 0
            word = word << bits | code
        order = np.lexsort((word, rank[todo]))
        todo, word = todo[order], word[order]
        old = rank[todo]
        fresh = np.append(True, (old[1:] != old[:-1]) | (word[1:] != word[:-1]))
        group = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        # a group's name is its old one plus the number of pieces before it in the old group
        start = np.append(True, old[1:] != old[:-1])
        base = np.maximum.accumulate(np.where(start, np.arange(len(todo)), 0))
        rank[todo] = (old + np.arange(len(todo)) - base)[first][group]
        depth += per
        size = np.diff(np.append(first, len(todo)))[group]
        todo = todo[(size > 1) & (stars[todo] + depth <= stop[todo])]
    return rank


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a short sequence; ties in names are broken by what follows."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    step, todo = 1, np.arange(n)
    order = np.argsort(rank, kind="stable")
    rank[order] = np.searchsorted(np.sort(rank), rank[order])  # place of the first equal one
    while True:
        count = np.bincount(rank, minlength=n)
        todo = todo[count[rank[todo]] > 1]
        if not len(todo):
            break
        after = np.where(todo + step < n, rank[np.minimum(todo + step, n - 1)] + 1, 0)
        by = np.lexsort((after, rank[todo]))
        todo, after = todo[by], after[by]
        old = rank[todo]
        start = np.append(True, old[1:] != old[:-1])
        fresh = start | np.append(True, after[1:] != after[:-1])
        place = np.arange(len(todo))
        base = np.maximum.accumulate(np.where(start, place, 0))
        group = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[todo] = old + group - base
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefixes of suffix pairs, by comparison."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(most):
        x, y = text[a[live] + k], text[b[live] + k]
        live = live[(x == y) & (x != 0)]
        if not len(live):
            break
        out[live] = k + 1
    return out


def sort(text: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix with the one before it, at most ``most``)."""
    if not len(text):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rises, run = types(text)
    stars = np.flatnonzero((rises & ~np.append(True, rises[:-1])) | (text == 0))
    names = _names(text, rises, stars)
    if np.bincount(names).max() == 1:
        order = np.argsort(names)
    elif len(names) <= IN_MEMORY:
        order = _doubled(names)
    else:  # the names of separators end the strings of names; each becomes a 0 of its own
        ends = text[stars] == 0
        lifted = np.where(ends, 0, names - ends.sum() + 1)
        order = sort(lifted, 1)[0]
    seeds = stars[order]
    lcp = np.append(0, _shared(text, seeds[:-1], seeds[1:], most))
    return _induce(text, rises, run, seeds, lcp, most)


def _induce(text, rises, run, seeds, seed_lcp, most):
    chars = np.unique(text)
    spool = Spool()
    passed, tail = Passed(), {}  # per queue: the next block's number and the least prefix after its last entry in this one
    first = np.searchsorted(text[seeds], chars, "left")
    last = np.searchsorted(text[seeds], chars, "right")
    seed_at = {c: (int(i), int(j)) for c, i, j in zip(chars.tolist(), first, last)}
    left = {c: Queue(spool) for c in chars.tolist()}

    def append(queues, pos, lcp, want):
        """Predecessors (of type ``want``) of a block in order; ``lcp`` is with the entry scanned before."""
        before = pos - 1
        ok = (before >= 0) & (rises[before] == want)
        ok &= text[before] != 0
        char = text[before]
        at = np.flatnonzero(ok)
        if len(at):
            by = at[np.argsort(char[at], kind="stable")]
            cuts = np.flatnonzero(np.append(True, char[by][1:] != char[by][:-1]))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(by)]):
                c, own = int(char[by[i]]), by[i:j]
                # the least value after the previous source, up to this one
                mins = np.minimum.reduceat(lcp[:own[-1] + 1], np.append(0, own[:-1] + 1))
                if queues[c].any:
                    after, least = tail[c]
                    mins[0] = min(least, passed.since(after, most), mins[0])
                else:
                    mins[0] = -1
                queues[c].put(np.stack([before[own], np.minimum(mins + 1, most)]))
                tail[c] = passed.now + 1, int(lcp[own[-1] + 1:].min(initial=most))
        passed.put(int(lcp.min()))

    done = {}
    for c in chars.tolist():  # L, left to right
        parts, boundary = [], True
        while (block := left[c].take()) is not None:
            if boundary:
                block[1][0] = 0
            boundary = False
            parts.append(block)
            append(left, block[0], block[1], False)
        done[c] = np.concatenate(parts, axis=1) if parts else np.empty((2, 0), np.int64)
        i, j = seed_at[c]
        if j > i:
            pos, lcp = seeds[i:j], seed_lcp[i:j].copy()
            lcp[0] = 0
            if done[c].shape[1]:
                lcp[0] = min(most, int(min(run[done[c][0][-1]], run[pos[0]])))
            append(left, pos, lcp, False)
    right = {c: Queue(spool) for c in chars.tolist()}
    passed, tail = Passed(), {}
    out = []
    for c in chars[::-1].tolist():  # S, right to left
        parts, boundary = [], True
        if c == 0:
            i, j = seed_at[0]
            parts.append(np.stack([seeds[i:j][::-1], np.zeros(j - i, np.int64)]))
        while c and (block := right[c].take()) is not None:
            if boundary:
                block[1][0] = 0
            boundary = False
            parts.append(block)
            append(right, block[0], block[1], True)
        own = np.concatenate(parts, axis=1) if parts else np.empty((2, 0), np.int64)
        back = done.pop(c)[:, ::-1]
        # seen from the right, an entry carries the common prefix with its right neighbour
        if back.shape[1]:
            vals = np.append(0, back[1][:-1])
            if own.shape[1]:
                vals[0] = min(most, int(min(run[back[0][0]], run[own[0][-1]])))
            append(right, back[0], vals, True)
            own = np.concatenate([own, np.stack([back[0], vals])], axis=1)
        out.append(own)
    whole = np.concatenate(out, axis=1)[:, ::-1]
    return whole[0].copy(), np.append(0, whole[1][:-1])
