"""Repeated passages: exact removal of byte strings that also start in an earlier document.

Sharding. Every window of ``least`` bytes has a minimizer: the smallest hash of its 16-byte grams.
Equal windows have equal minimizers, so the runs of windows with one minimizer (strings of at most
``2 * least - 16`` bytes) can be dealt by it, and equal windows meet in one shard. Minimizers that only
one document has cannot belong to a repeat; they are found first, from hashes alone, and their
strings are never moved.

A shard is suffix-sorted in memory by induced sorting (``induced``): queues of suffix tuples, the waiting ones on
disk, recursion on the names of the pieces between S* suffixes, common prefixes carried along. Neighbours
that share ``least`` bytes form the groups of equal windows; a window goes if its document is not the
smallest of its group. Strings of different minimizers share no window, so they are sorted about ``SORT`` bytes
at a time: the memory of a sort does not grow with its shard.

Hot passages. A string that several documents of one batch hold is folded there: later documents
lose it at once, and one entry goes on. A shard folds again before it sorts. At the edges of a shared
passage the strings reach outside it and differ from document to document, so folding leaves them and
one minimizer may have a string per document. Strings are therefore counted per minimizer first. One with
more than ``HOT`` is hot everywhere: what folding leaves of its strings is cut into single windows, which
are folded again and dealt by a hash of all their bytes. Equal windows still meet, compared byte by byte;
a window has one entry per chunk of a batch, and no minimizer brings a shard more than ``HOT`` distinct strings.
(Places of equal strings in rows that share the least ID are all sent: none of them is later.)

Documents are packed once into compressed batches of about ``BATCH`` bytes, a table in the shared folder in
buckets of the batch number. Hits and spans come back per batch; the texts themselves are never shuffled.

Edge cases. Null and empty texts have no bytes; texts shorter than ``least`` lose nothing. Rows that
share an ID are not earlier than one another. Null IDs count as later than all others, and not earlier
than one another. Texts of any length are cut into slices for hashing only; matches inside a document
never count against itself. An empty table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, induced

BATCH, SLICE, GRAM, SHARD, HOT = 4 << 20, 1 << 17, 16, 6 << 20, 1 << 12
SORT = 1 << 20  # bytes of strings sorted at once; those of one minimizer, at most ``HOT``, stay together
LATE = np.iinfo(np.int64).max  # stands for a null ID
BITS = np.uint64((1 << 48) - 1)  # of a minimizer, where only its identity matters; a clash costs time only
FLAG = np.uint64(63)  # the bit of a hit that says hot
PACKED = "batch long, doc_ids array<long>, sizes array<long>, n_bytes long, data binary"


def packed(documents: DataFrame) -> DataFrame:
    """Compressed batches of whole documents."""
    schema = pa.schema([("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                        ("n_bytes", pa.int64()), ("data", pa.binary())])

    def run(batches):
        from pyspark import TaskContext
        number, tool = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        ids, texts = [], []

        def one():
            data = b"".join(texts)
            return pa.RecordBatch.from_pylist([{"batch": number, "doc_ids": ids, "sizes": [*map(len, texts)], "n_bytes": len(data),
                                                "data": tool.compress(data)}], schema=schema)

        for b in common.small_slices(batches, "text", BATCH):
            ids += b.column("doc_id").to_pylist()
            texts += [(t or "").encode() for t in b.column("text").to_pylist()]
            if sum(map(len, texts)) >= BATCH // 2:
                yield one()
                ids, texts, number = [], [], number + 1
        if ids:
            yield one()

    return documents.select("doc_id", "text").mapInArrow(run, PACKED)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, first byte of each document and the end)."""
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["n_bytes"])) if row["n_bytes"] else b""
    return np.frombuffer(data, np.uint8), np.append(0, np.cumsum(np.array(row["sizes"], np.int64)))


def _grams(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes from each position."""
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step = 1
    while step < GRAM:
        h = h[:-step] * np.uint64(0xBF58476D1CE4E5B9) + h[step:]
        h ^= h >> np.uint64(29)
        step *= 2
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, wide: int) -> np.ndarray:
    """Minimum over each window of ``wide``."""
    n, step = len(h) - wide + 1, 1
    while 2 * step <= wide:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[:n], h[wide - step:wide - step + n])


def runs(x: np.ndarray, bounds: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(minimizer, document, first byte, size) of the strings of windows with one minimizer, slice by slice."""
    for a in range(0, len(x), SLICE):
        part = x[a:a + SLICE + least - 1]
        if len(part) < least:
            break
        m = _least(_grams(part), least - GRAM + 1)
        new = np.append(True, m[1:] != m[:-1])
        # a run ends where the minimizer changes, with its document, and with its document's last window
        for edge in (bounds, bounds[1:] - least + 1):
            near = edge[np.searchsorted(edge, a, "left"):np.searchsorted(edge, a + len(m), "left")] - a
            new[near] = True
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(m)))
        doc = np.searchsorted(bounds, a + first, "right") - 1
        ok = a + first + least <= bounds[doc + 1]
        first, size, doc = first[ok], size[ok], doc[ok]
        # a gram that comes again and again makes a long run: it is cut where one minimizer alone would end
        most = least - GRAM + 1
        times = -(-size // most)
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first = np.repeat(first, times) + step * most
        size = np.minimum(np.repeat(size, times) - step * most, most)
        yield m[first], np.repeat(doc, times), a + first, size + least - 1


def _whole(x, bounds, least):
    got = [*runs(x, bounds, least)]
    return [np.concatenate(c) for c in zip(*got)] if got else [np.empty(0, np.uint64)] + [np.empty(0, np.int64)] * 3


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, rows) per distinct key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)) if len(keys) else []
    for i, j in zip(cuts, [*cuts[1:], len(order)]):
        yield int(keys[order[i]]), order[i:j]


def shared_minimizers(batches: DataFrame, least: int, shards: int, hot: int = HOT) -> DataFrame:
    """(batch, hits): 48-bit minimizers of a batch that another document also has, as blobs; those with more
    than ``hot`` strings in all are flagged."""
    def emit(it):
        for b in it:
            for row in b.to_pylist():
                x, bounds = _unpacked(row)
                m, doc, _, _ = _whole(x, bounds, least)
                m &= BITS
                order = np.lexsort((doc, m))
                m, doc = m[order], doc[order]
                first = np.flatnonzero(np.append(True, m[1:] != m[:-1])) if len(m) else np.empty(0, np.int64)
                last = np.append(first[1:], len(m)) - 1 if len(m) else first
                value, twice = m[first], doc[first] != doc[last]
                count = (np.minimum(last - first + 1, 0x7FFF) | twice.astype(np.int64) << 15).astype("<u2")
                key = (value % np.uint64(shards)).astype(np.int64)
                out = [(k, value[rows].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), count[rows].tobytes()) for k, rows in _by(key)]
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([row["batch"]] * len(out), pa.int64()),
                                                  pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())],
                                                 names=["shard", "batch", "minimizers", "counts"])

    def meet(table: pa.Table) -> pa.Table:
        values, counts, owner = [], [], []
        for i, (blob, numbers) in enumerate(zip(table.column("minimizers").to_pylist(), table.column("counts").to_pylist())):
            v = np.zeros((len(blob) // 6, 8), np.uint8)
            v[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
            values.append(v.view(np.uint64)[:, 0])
            counts.append(np.frombuffer(numbers, "<u2"))
            owner.append(np.full(len(v), i))
        value, strings, owner = np.concatenate(values), np.concatenate(counts), np.concatenate(owner)
        _, group, count = np.unique(value, return_inverse=True, return_counts=True)
        some = np.zeros(len(count), bool)
        some[group[strings >> 15 == 1]] = True
        hit = np.flatnonzero(some[group] | (count[group] > 1))
        many = np.bincount(group, strings & 0x7FFF) > min(hot, 0x7FFE)
        value = value | many[group].astype(np.uint64) << FLAG
        numbers = table.column("batch").to_pylist()
        out = [(numbers[i], value[hit[rows]].tobytes()) for i, rows in _by(owner[hit])]
        return pa.table({"batch": pa.array([o[0] for o in out], pa.int64()), "hits": pa.array([o[1] for o in out], pa.binary())})

    sent = batches.select("batch", "sizes", "n_bytes", "data").mapInArrow(emit, "shard int, batch long, minimizers binary, counts binary")
    return sent.groupBy("shard").applyInArrow(meet, "batch long, hits binary")


def padded(least: int) -> int:
    """Columns of a grid of strings of windows of ``least`` bytes: whole words of eight."""
    return -(-(2 * least - GRAM) // 8) * 8


class Strings:
    """Strings with their minimizer, the order of their document's ID, and their places (batch, document, byte)."""

    WORDS = np.random.default_rng(11).integers(1, 1 << 62, 4096, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def __init__(self, minimizer, order, batch, doc, at, size, grid):
        self.minimizer, self.order, self.batch, self.doc, self.at, self.size, self.grid = minimizer, order, batch, doc, at, size, grid

    def take(self, rows) -> Strings:
        return Strings(*(c[rows] for c in (self.minimizer, self.order, self.batch, self.doc, self.at, self.size, self.grid)))

    def keys(self) -> np.ndarray:
        """A hash of each string."""
        key, words = self.size.astype(np.uint64), self.words()
        for a in range(words.shape[1]):
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[:, a] * self.WORDS[a]
        return key ^ (key >> np.uint64(29))

    def words(self) -> np.ndarray:
        """The padded bytes of each string, eight at a time."""
        return np.ascontiguousarray(self.grid).view(np.uint64)

    def windows(self, least: int) -> Iterator[Strings]:
        """Each window as a string of its own whose minimizer is a hash of it, chunk by chunk."""
        for a in range(0, len(self.size), 1 << 13):
            own = self.take(slice(a, a + (1 << 13)))
            times = own.size - least + 1
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row = np.repeat(np.arange(len(times)), times)
            grid = np.zeros((len(row), own.grid.shape[1]), np.uint8)
            grid[:, :least] = np.lib.stride_tricks.sliding_window_view(own.grid, least, axis=1)[row, step]
            out = Strings(own.minimizer[row], own.order[row], own.batch[row], own.doc[row], own.at[row] + step, np.full(len(row), least), grid)
            out.minimizer = out.keys()
            yield out

    def folded(self) -> tuple[Strings, np.ndarray, np.ndarray]:
        """(strings ordered so that equal ones follow one another, group number, least order of each group)."""
        own = self.take(np.argsort(self.keys(), kind="stable"))
        words = own.words()
        new = np.append(True, (own.size[1:] != own.size[:-1]) | (words[1:] != words[:-1]).any(axis=1))[:len(own.size)]
        group = np.cumsum(new) - 1
        return own, group, np.minimum.reduceat(own.order, np.flatnonzero(new)) if len(group) else own.order

    def pack(self) -> bytes:
        flat = self.grid[np.arange(self.grid.shape[1])[None] < self.size[:, None]]
        return zstandard.ZstdCompressor(level=1).compress(b"".join((
            len(self.size).to_bytes(8, "little"), self.minimizer.tobytes(), self.order.tobytes(), self.doc.astype("<u4").tobytes(),
            self.at.tobytes(), self.size.astype("<u2").tobytes(), flat.tobytes())))

    @staticmethod
    def unpack(blob: bytes, batch: int, wide: int) -> Strings:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, p, out = int.from_bytes(raw[:8], "little"), 8, []
        for kind in ("<u8", "<i8", "<u4", "<i8", "<u2"):
            out.append(np.frombuffer(raw, kind, n, p))
            p += n * np.dtype(kind).itemsize
        minimizer, order, doc, at, size = out
        size = size.astype(np.int64)
        grid = np.zeros((n, wide), np.uint8)
        grid[np.arange(wide)[None] < size[:, None]] = np.frombuffer(raw, np.uint8, -1, p)
        return Strings(minimizer, order, np.full(n, batch), doc.astype(np.int64), at, size, grid)


def _joined(own: Strings) -> Strings:
    """Strings of one batch and size, those at successive bytes of a document as one (for their places only)."""
    own = own.take(np.lexsort((own.at, own.doc)))
    first = np.flatnonzero(np.append(True, (own.doc[1:] != own.doc[:-1]) | (own.at[1:] != own.at[:-1] + 1))[:len(own.at)])
    out = own.take(first)
    out.size = out.size + np.diff(np.append(first, len(own.at))) - 1
    return out


def _spans(batch, doc, at, size) -> pa.RecordBatch:
    """Span blobs per batch: document number, first byte within it, size."""
    out = []
    for k, rows in _by(batch):
        out.append((k, b"".join((len(rows).to_bytes(8, "little"), doc[rows].astype("<u4").tobytes(),
                                 at[rows].astype("<i8").tobytes(), size[rows].astype("<i8").tobytes()))))
    return pa.RecordBatch.from_arrays([pa.array([0] * len(out), pa.int32()), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                                      names=["kind", "key", "blob"])


def candidates(batches: DataFrame, hits: DataFrame, least: int, shards: int) -> DataFrame:
    """(kind, key, batch, blob): 0, spans of a batch that are settled within it; 1, strings of a shard."""
    wide = padded(least)

    def emit(it):
        for b in it:
            for row in b.to_pylist():
                known = np.concatenate([np.frombuffer(h, np.uint64) for h in row["hits"]])
                known = known[np.argsort(known & BITS)]
                hot, known = known >> FLAG == 1, known & BITS
                x, bounds = _unpacked(row)
                ids = np.array([LATE if i is None else i for i in row["doc_ids"]], np.int64)
                m, doc, at, size = _whole(x, bounds, least)
                short = m & BITS
                rows = np.flatnonzero(known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short)
                for a in range(0, max(1, len(rows)), 1 << 16):
                    part = rows[a:a + (1 << 16)]
                    grid = x[np.minimum(at[part][:, None] + np.arange(wide), len(x) - 1)]
                    grid[np.arange(wide)[None] >= size[part][:, None]] = 0
                    gone, rest = settled(Strings(m[part], ids[doc[part]], np.full(len(part), row["batch"]), doc[part],
                                                 at[part] - bounds[doc[part]], size[part], grid))
                    cut = hot[np.searchsorted(known, rest.minimizer & BITS)]
                    yield sent(row["batch"], gone, rest.take(~cut))
                    for own in rest.take(cut).windows(least):
                        gone, rest_of = settled(own)
                        yield sent(row["batch"], _joined(gone), rest_of)

    def settled(own: Strings) -> tuple[Strings, Strings]:
        """(strings that an earlier document of these holds, the others)."""
        own, group, low = own.folded()
        late = own.order > low[group] if len(group) else np.empty(0, bool)
        return own.take(late), own.take(~late)

    def sent(batch: int, gone: Strings, rest: Strings) -> pa.RecordBatch:
        spans = _spans(gone.batch, gone.doc, gone.at, gone.size)
        out = [(k, rest.take(r).pack()) for k, r in _by(((rest.minimizer >> np.uint64(8)) % np.uint64(shards)).astype(np.int64))]
        n = len(out)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([spans.column(0), pa.array([1] * n, pa.int32())]), pa.concat_arrays([spans.column(1), pa.array([o[0] for o in out], pa.int64())]),
             pa.array([None] * spans.num_rows + [batch] * n, pa.int64()),
             pa.concat_arrays([spans.column(2), pa.array([o[1] for o in out], pa.binary())])], names=["kind", "key", "batch", "blob"])

    found = hits.groupBy("batch").agg(F.collect_list("hits").alias("hits"))  # at most the batch's own minimizers
    return batches.join(found.hint("merge"), "batch").mapInArrow(emit, "kind int, key long, batch long, blob binary")


def _bounded(rows: np.ndarray, kind: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """``rows``, ordered by ``kind``, in parts of about ``SORT`` bytes that never cut a kind."""
    first = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    part = np.cumsum(np.add.reduceat(size + 1, first)) // SORT
    cuts = first[np.flatnonzero(np.append(True, part[1:] != part[:-1]))]
    yield from np.split(rows, cuts[1:])


def late_runs(text: np.ndarray, size: np.ndarray, rank: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(string, first, stop of each maximal run of windows that a string of smaller rank also has, number of strings)."""
    n = len(size)
    inside = np.arange(text.shape[1] + 1)[None] <= size[:, None]
    flat = np.zeros(inside.shape, np.int16)
    flat[:, :-1] = text
    flat[:, :-1] += 1
    flat[np.arange(n), size] = 0
    source = np.repeat(np.arange(n, dtype=np.int32), size + 1)
    begins = np.cumsum(size + 1) - size - 1
    order, lcp = induced.sort(flat[inside], least)
    del flat, inside
    source = source[order]
    at = order - begins[source]
    del order
    new = lcp < least
    same, low = np.cumsum(new, dtype=np.int32) - 1, np.minimum.reduceat(rank[source], np.flatnonzero(new))
    drop = (rank[source] > low[same]) & (at + least <= size[source])
    mask = np.zeros((n, text.shape[1] - least + 3), bool)  # a free column on either side
    mask[source[drop], at[drop] + 1] = True
    step = np.diff(mask.astype(np.int8), axis=1)
    row, start = np.nonzero(step == 1)
    return row, start, np.nonzero(step == -1)[1], n


def repeated(own: Strings, group: np.ndarray, low: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(batch, document, first byte, size) of what goes, from the folded strings of one shard."""
    late = own.order > low[group]
    gone = own.take(late)
    out = [(gone.batch, gone.doc, gone.at, gone.size)]
    own, group = own.take(~late), group[~late]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    one = own.take(first)  # distinct strings
    place = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
    _, kind, count = np.unique(one.minimizer, return_inverse=True, return_counts=True)
    sift = np.flatnonzero(count[kind] > 1)  # a single string of a minimizer shares nothing with others
    if len(sift):
        sift = sift[np.argsort(kind[sift], kind="stable")]
        parts = [late_runs(one.grid[rows], one.size[rows], one.order[rows], least) for rows in _bounded(sift, kind[sift], one.size[sift])]
        row, start, stop = (np.concatenate(c) for c in zip(*((r + n, a, z) for (r, a, z, _), n in zip(
            parts, np.cumsum([0, *(p[3] for p in parts)])))))
        # every place of a string with such runs
        runs_of = np.bincount(row, minlength=len(sift))
        back = np.full(len(one.size), -1)
        back[sift] = np.arange(len(sift))
        holds = np.flatnonzero((back[place] >= 0) & (runs_of[back[place]] > 0))
        times = runs_of[back[place[holds]]]
        entry = np.repeat(holds, times)
        offset = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
        which = (np.cumsum(runs_of) - runs_of)[back[place[entry]]] + offset
        out.append((own.batch[entry], own.doc[entry], own.at[entry] + start[which], stop[which] - start[which] + least - 1))
    return tuple(np.concatenate(c) for c in zip(*out))


def all_spans(found: DataFrame, least: int) -> DataFrame:
    """Span blobs per batch (kind 0, key, blob): those settled within a batch, and those from the sorted shards.

    Both kinds go through one exchange, so the strings are moved once and written nowhere else.
    """
    wide = padded(least)

    def run(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() == 0:
            return table.select(["kind", "key", "blob"])
        blobs, numbers = table.column("blob"), table.column("batch").to_pylist()
        parts = [Strings.unpack(blobs[i].as_buffer(), batch, wide) for i, batch in enumerate(numbers)]
        columns = []
        for c in ("minimizer", "order", "batch", "doc", "at", "size", "grid"):  # a column of the parts goes as it is joined
            columns.append(np.concatenate([getattr(p, c) for p in parts]))
            for p in parts:
                setattr(p, c, None)
        folded = Strings(*columns)
        del parts, columns
        folded = folded.folded()
        return pa.Table.from_batches([_spans(*repeated(*folded, least))])

    return found.groupBy("kind", "key").applyInArrow(run, "kind int, key long, blob binary")


def remove(documents: DataFrame, least: int = 50, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (array of start, stop: maximal removed runs of bytes), kept (binary)."""
    spark = documents.sparkSession
    common.ship(spark)
    batches = common.bucketed(packed(documents), "passages", "batch")
    total = batches.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD))
    hits = shared_minimizers(batches, least, shards, hot)
    spans = all_spans(candidates(batches, hits, least, shards), least)
    spans = spans.groupBy(F.col("key").alias("batch")).agg(F.collect_list("blob").alias("spans"))  # of one batch

    kind = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def cut(it):
        for b in it:
            for row in b.to_pylist():
                x, bounds = _unpacked(row)
                delta = np.zeros(len(x) + 1, np.int32)
                for blob in row["spans"] or ():
                    n = int.from_bytes(blob[:8], "little")
                    doc = np.frombuffer(blob, "<u4", n, 8).astype(np.int64)
                    at = np.frombuffer(blob, "<i8", n, 8 + 4 * n) + bounds[doc]
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + np.frombuffer(blob, "<i8", n, 8 + 12 * n), -1)
                gone = np.cumsum(delta[:-1]) > 0
                runs_of, kept = [], []
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    mask = gone[i:j]
                    if mask.any():
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                        runs_of.append([{"start": s, "stop": e} for s, e in edge.reshape(-1, 2).tolist()])
                        kept.append(x[i:j][~mask].tobytes())
                    else:
                        runs_of.append([])
                        kept.append(x[i:j].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["sizes"], pa.int64()),
                                                  pa.array(runs_of, pa.list_(kind)), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return batches.join(spans.hint("merge"), "batch", "left").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def digests(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, r: s + r["stop"] - r["start"])
    return removed.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
