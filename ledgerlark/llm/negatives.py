"""Hard-negative mining: exact integer scores by a residue-number-system product, then windowed selection.

Anchors are dealt into groups and rows into parts, by hashes of their IDs; a cell is one group against one
part, and every cell is one Spark group of bounded size, whatever the labels. Each cell multiplies modulo
several small primes in float32 and reconstructs the signed scores (see ``residues``). The first pass
multiplies equal labels only and ranks an anchor's positives; the second ranks, for each positive, the rows
of other labels in its score window. A cell returns its first few rows per anchor and window, and those
are ranked again over all cells, so no task holds all rows of an anchor or label.

Edge cases. Rows with a null ID, label or vector, or a null or non-finite component take no part; nor do
rows whose sum of squared integer components reaches 2^56, as their scores might not fit a long. Only
vectors of one length are compared; empty ones score 0. Repeated rows count once; rows that share an ID
but not label and vector stay separate rows (each is an anchor of its own), ties among them by a hash, and
are neither positives nor negatives of their own ID. An anchor without positives, and a positive without
rows in its window, return nothing. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import residues
from .common import ship, written

ANCHORS, ROWS = 2048, 8192  # rows of a group of anchors and of a part, on average
STRIP = 1 << 22  # scores in memory at a time
NORM = 1 << 56  # no sum of squares reaches this, so 100 scores fit a long
NONE = -(1 << 62)


def prepared(rows: DataFrame, anchors: Column, scale: int = 256) -> DataFrame:
    """(id, h, label, anchor, dim, norm, c): integer components c = floor(scale * x) of the rows that take part."""
    grid = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    big = F.lit(float(1 << 28))
    sound = F.forall("embedding", lambda x: F.coalesce(F.abs(F.lit(float(scale)) * x.cast("double")) < big, F.lit(False)))
    norm = F.aggregate("c", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return (rows.select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), anchors.alias("anchor"), "embedding")
            .filter("id is not null and label is not null and embedding is not null").filter(sound)
            .select("id", "label", F.coalesce("anchor", F.lit(False)).alias("anchor"), grid.cast("array<int>").alias("c"))
            .distinct()
            .select("id", F.xxhash64("label", "c").alias("h"), "label", "anchor", F.size("c").alias("dim"), norm.alias("norm"), "c")
            .filter(F.col("norm") < float(NORM)))


def _dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
    """Every row in one of ``n`` parts, and once for each of ``m`` parts of the other side."""
    part = F.pmod(F.xxhash64("id", "h"), F.lit(n)).cast("int")
    return (df.withColumn(own, part).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
            .repartition(n * m, "dim", "ag", "rp"))


def _matrix(col: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = col.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(n, -1) if len(flat) else np.zeros((n, 0), np.int64)


def _side(t: pa.Table) -> tuple:
    """ids, hashes, labels and components, by ascending (id, hash): then the first of equals has the smaller ID."""
    t = t.sort_by([("id", "ascending"), ("h", "ascending")])
    return t["id"].to_numpy(), t["h"].to_numpy(), t["label"], _matrix(t["c"], t.num_rows), t


def _strips(n: int, width: int) -> Iterator[slice]:
    step = max(1, STRIP // max(1, width))
    for a in range(0, n, step):
        yield slice(a, min(a + step, n))


def _codes(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    both = pa.chunked_array([*a.chunks, *b.chunks], pa.string()).dictionary_encode().combine_chunks()
    codes = both.indices.to_numpy(zero_copy_only=False)
    return codes[:len(a)], codes[len(a):]


def first(values: np.ndarray, k: int, low: int, high: int) -> np.ndarray:
    """Places of the first ``k`` values between ``low`` and ``high``, largest first, equal ones in their order."""
    at = np.flatnonzero((values >= low) & (values <= high))
    if len(at) > k:
        cut = np.partition(values[at], len(at) - k)[len(at) - k]
        at = at[values[at] >= cut]
    return at[np.argsort(-values[at], kind="stable")][:k]


def _table(schema: list[str], parts: list[list]) -> pa.Table:
    """Rows of (anchor id, anchor hash, ids..., hashes..., scores...) as given by ``parts``, all long."""
    cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*parts) if parts else [[]] * len(schema))]
    return pa.table([pa.array(np.asarray(c, np.int64)) for c in cols], names=schema)


POSITIVES = ["id", "h", "positive_id", "ph", "positive_score"]
NEGATIVES = ["id", "h", "positive_id", "ph", "positive_score", "negative_id", "nh", "negative_score"]


def _positives(primes: list[int], k: int):
    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, hs, al, a, _ = _side(left)
        rids, rhs, rl, b, _ = _side(right)
        al, rl = _codes(al, rl)
        out = []
        for code in np.unique(al):
            mine, theirs = np.flatnonzero(al == code), np.flatnonzero(rl == code)
            if not len(theirs):
                continue
            rb = residues.residues(b[theirs], primes)
            for strip in _strips(len(mine), len(theirs)):
                got = residues.scores(residues.residues(a[mine[strip]], primes), rb, primes)
                for i, row in zip(mine[strip], got):
                    row[rids[theirs] == ids[i]] = NONE
                    at = first(row, k, NONE + 1, -NONE)
                    to = theirs[at]
                    out.append([np.full(len(at), ids[i]), np.full(len(at), hs[i]), rids[to], rhs[to], row[at]])
        return _table(POSITIVES, out)

    return cell


def _negatives(primes: list[int], k: int, low: int, high: int):
    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, hs, al, a, t = _side(left)
        rids, rhs, rl, b, _ = _side(right)
        if not len(rids) or not len(ids):
            return _table(NEGATIVES, [])
        al, rl = _codes(al, rl)
        wanted = t["wanted"].to_pylist()
        rb = residues.residues(b, primes)
        out = []
        for strip in _strips(len(ids), len(rids)):
            got = residues.scores(residues.residues(a[strip], primes), rb, primes)
            for i, row in enumerate(got, strip.start):
                row[(rl == al[i]) | (rids == ids[i])] = NONE
                for w in wanted[i]:
                    score = w["positive_score"]
                    at = first(row, k, -(-low * score // 100), high * score // 100)
                    n = len(at)
                    out.append([np.full(n, ids[i]), np.full(n, hs[i]), np.full(n, w["positive_id"]), np.full(n, w["ph"]),
                                np.full(n, score), rids[at], rhs[at], row[at]])
        return _table(NEGATIVES, out)

    return cell


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    ``rows``: vec_id long, embedding array of numbers, label. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    ship(rows.sparkSession)
    base = written(prepared(rows, anchors, scale), "negatives")
    n, n_anchors, norm = base.agg(F.count("*"), F.count_if("anchor"), F.max("norm")).first()
    parts, groups = max(1, math.ceil(n / ROWS)), max(1, math.ceil(n_anchors / ANCHORS))
    primes = residues.primes_for(math.ceil((norm or 0) * 1.001) + 1)  # |a.b| <= the larger sum of squares
    right = _dealt(base.drop("anchor", "norm"), "rp", parts, "ag", groups).groupBy("dim", "ag", "rp")
    asked = base.filter("anchor").drop("anchor", "norm")

    def cells(left: DataFrame, fn, names: list[str]) -> DataFrame:
        left = _dealt(left, "ag", groups, "rp", parts).groupBy("dim", "ag", "rp")
        return left.cogroup(right).applyInArrow(fn, ", ".join(f"{x} long" for x in names))

    found = cells(asked, _positives(primes, positives), POSITIVES)
    best = Window.partitionBy("id", "h").orderBy(F.desc("positive_score"), "positive_id", "ph")
    found = found.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= positives).drop("k")
    wanted = found.groupBy("id", "h").agg(F.collect_list(F.struct("positive_id", "ph", "positive_score")).alias("wanted"))
    asked = written(asked.join(wanted, ["id", "h"]), "anchors")  # at most ``positives`` structs a row

    out = cells(asked, _negatives(primes, negatives, low, high), NEGATIVES)
    best = Window.partitionBy("id", "h", "positive_id", "ph").orderBy(F.desc("negative_score"), "negative_id", "nh")
    return (out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
            .select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
