"""Approximate nearest neighbours by largest inner product: balanced posting lists.

Inner products become distances by one more component (what a vector's length lacks to the longest
one's). Centroids are fitted on a bounded sample with a penalty on crowded ones, one for about
``LIST`` vectors. Every vector goes to its nearest centroid's list and, at a boundary, to further lists
whose centroid is at most ``closure`` times as far (``replicas`` in all). A query walks an in-memory
graph over the centroids (neighbours plus a few long edges) and takes lists by distance ratio:
all within ``ratio`` of the nearest, between the shares ``least`` and ``most`` of the lists. Lists
longer than ``PART`` are cut into parts that are all searched, so nothing is dropped. Lists and the
queries that chose them meet as packed blocks of bounded size.

The centroids and their graph are broadcast: at most ``MOST_LISTS`` of them (a documented bound).

Edge cases. Vectors that are null, empty, zero, or hold null or non-finite components, and rows
with a null ID, take no part; nor do vectors whose length is not the most frequent one (ties: the
smaller). Rows that share ID and vector are folded first. Of different vectors under one ID the best score
counts, before any cut to ``k``, and no row of the query's own ID is a candidate. A query whose lists hold fewer
than ``k`` other IDs, though the table has more, searches all lists in a second round. Ties go to the smaller ID. Fewer candidates than ``k``: all that were found. An empty table gives an
empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, vectors

LIST, PART, QUERIES, SAMPLE, MOST_LISTS = 400, 2048, 256, 1 << 16, 1 << 14
CELLS = 1 << 20  # of rows x lists at once, and of vector components in one batch that is dealt


@dataclass(frozen=True)
class Plan:
    replicas: int = 2
    closure: float = 1.1
    ratio: float = 1.25
    least: float = 0.4
    most: float = 0.6


class Centroids:
    """Centroids of the lengthened vectors and a graph to search them."""

    def __init__(self, x: np.ndarray, lists: int, longest: float, seed: int = 3, rounds: int = 8):
        rng = np.random.default_rng(seed)
        self.longest = longest
        x = self.lengthened(x)
        c = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
        crowd = np.zeros(len(c))
        for _ in range(rounds):  # a crowded centroid looks farther away in the next round
            near = np.concatenate([((c * c).sum(1)[None] - 2 * p @ c.T + crowd[None]).argmin(1) for p in np.array_split(x, -(-len(x) // 4096))])
            size = np.bincount(near, minlength=len(c))
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
            spread = ((x - c[near]) ** 2).sum(1).mean()
            crowd = 0.1 * spread * (size / max(1.0, size.mean()) - 1).clip(-1, 4)
        self.points = c
        n = len(c)
        around = min(16, n - 1)
        self.links = []
        for a in range(0, n, 1024):
            d = (c * c).sum(1)[None] - 2 * c[a:a + 1024] @ c.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near = np.argpartition(d, around - 1, axis=1)[:, :around] if around else np.empty((len(d), 0), int)
            self.links += list(near)
        long = rng.integers(0, n, (n, 4))
        back: list = [[] for _ in range(n)]
        for i, near in enumerate(self.links):
            for j in near:
                back[j].append(i)
        self.links = [np.unique(np.concatenate([near, long[i], np.array(back[i][:32], int)]).astype(int)) for i, near in enumerate(self.links)]

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0))
        return np.concatenate([x, more[:, None]], axis=1)

    def lists_of(self, x: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs of the postings of all rows; every row has its nearest list."""
        x, c = self.lengthened(x), self.points
        k = min(plan.replicas, len(c))
        d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0))
        near = np.argsort(d, axis=1, kind="stable")[:, :k]
        dist = np.take_along_axis(d, near, 1)
        keep = dist <= plan.closure * dist[:, :1]
        keep[:, 0] = True
        row, col = np.nonzero(keep)
        return row, near[row, col]

    def search(self, q: np.ndarray, plan: Plan) -> np.ndarray:
        """Lists of a query: best-first walk over the graph, then the distance ratio."""
        n = len(self.points)
        most, least = max(1, int(np.ceil(plan.most * n))), max(1, int(np.ceil(plan.least * n)))
        if least == n:
            return np.arange(n)
        q = np.append(q, 0.0)
        seen = np.zeros(n, bool)
        dist = np.full(n, np.inf)
        seen[0] = True
        dist[0] = np.linalg.norm(self.points[0] - q)
        heap, found = [(dist[0], 0)], []  # found: the best ``most`` so far, worst first
        while heap:
            d, i = heapq.heappop(heap)
            if len(found) >= most and d > -found[0][0]:
                break
            if len(found) < most:
                heapq.heappush(found, (-d, i))
            else:
                heapq.heappushpop(found, (-d, i))
            near = self.links[i][~seen[self.links[i]]]
            if len(near):
                seen[near] = True
                dist[near] = np.linalg.norm(self.points[near] - q, axis=1)
                for j, dj in zip(near.tolist(), dist[near].tolist()):
                    heapq.heappush(heap, (dj, j))
        best = sorted((-d, i) for d, i in found)
        return np.array([i for r, (d, i) in enumerate(best) if r < least or d <= plan.ratio * best[0][0]])


def fit(rows: DataFrame, n: int, dim: int) -> Centroids:
    """Centroids from at most SAMPLE vectors (smallest hashes); ``longest`` is over all rows."""
    longest = rows.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))).first()[0] ** 0.5
    lists = int(min(MOST_LISTS, max(1, n // LIST)))
    few = min(SAMPLE, max(4096, 16 * lists))
    share = min(1.0, 1.2 * few / n)
    some = rows.filter(F.pmod(F.col("h"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("h", "vec_id").limit(few)
    x = np.array(some.select("vec").toPandas()["vec"].tolist(), np.float64).reshape(-1, dim)
    return Centroids(x, lists, longest)


def deal(own: Centroids, batches, plan: Plan, ask: bool):
    """Postings of vectors (or of queries), in batches of about CELLS components whatever comes in."""
    for whole in batches:
        if not whole.num_rows:
            continue
        n, dim = len(own.points), own.points.shape[1] - 1
        wide = dim * max(1, int(np.ceil(max(plan.least, plan.most) * n))) if ask else max(n, dim * plan.replicas)
        step = max(1, CELLS // wide)
        for a in range(0, whole.num_rows, step):
            b = whole.slice(a, step)
            x = np.asarray(b.column("vec").flatten()).reshape(-1, dim)
            if ask:
                chosen = [own.search(q, plan) for q in x]
                row, at = np.repeat(np.arange(len(x)), [len(c) for c in chosen]), np.concatenate(chosen)
            else:
                row, at = own.lists_of(x, plan)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), b.column("vec_id").take(pa.array(row)), b.column("h").take(pa.array(row)),
                                              b.column("vec").take(pa.array(row))], names=["list", "vec_id", "h", "vec"])


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20, plan: Plan = Plan()) -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id, score of the nearest found."""
    spark = embeddings.sparkSession
    common.ship(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    vec = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.filter(vectors.usable() & F.col("vec_id").isNotNull()).select("vec_id", vec.alias("vec"), is_query.alias("asks"))
    rows = rows.groupBy("vec_id", "vec").agg(F.bool_or(F.coalesce("asks", F.lit(False))).alias("asks"))
    rows = common.pinned(rows.withColumn("h", F.xxhash64("vec_id", "vec")))
    sizes = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim = sizes["dim"]
    rows = rows.filter(F.size("vec") == dim)
    shared = spark.sparkContext.broadcast(fit(rows, sizes["count"], dim))

    posted = "list int, vec_id long, h long, vec array<double>"
    lists = rows.select("vec_id", "h", "vec").mapInArrow(lambda it: deal(shared.value, it, plan, False), posted)

    def block(table: pa.Table) -> pa.Table:
        x = np.asarray(table.column("vec").combine_chunks().flatten(), "<f8")
        return pa.Table.from_pylist([{"list": table.column("list")[0].as_py(), "ids": table.column("vec_id").to_numpy().astype("<i8").tobytes(),
                                      "vecs": x.tobytes()}], schema=pa.schema([("list", pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary())]))

    def blocks(posts: DataFrame, most: int) -> DataFrame:
        posts = common.pinned(posts)
        parts = posts.groupBy("list").agg(F.ceil(F.count("*") / most).alias("__parts"))
        dealt = posts.join(parts, "list").withColumn("__part", F.pmod(F.xxhash64("vec_id", "h"), F.col("__parts")))
        return dealt.groupBy("list", "__part").applyInArrow(block, "list int, ids binary, vecs binary")

    def top(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, x = np.frombuffer(row["ids"], "<i8"), vectors.matrix(row["vecs"], dim, "<f8")
                qids, q = np.frombuffer(row["qids"], "<i8"), vectors.matrix(row["qvecs"], dim, "<f8")
                s = q @ x.T
                s[qids[:, None] == ids[None]] = -np.inf
                order = np.argsort(ids, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
                by_id = s if len(first) == len(ids) else np.maximum.reduceat(s[:, order], first, axis=1)
                cut = np.partition(by_id, -k, axis=1)[:, -k] if len(first) > k else np.full(len(q), -np.inf)
                out = []
                for i in range(len(q)):
                    at = np.flatnonzero((s[i] >= cut[i] - 1e-9 * abs(cut[i])) & (s[i] > -np.inf)) if np.isfinite(cut[i]) else np.flatnonzero(s[i] > -np.inf)
                    score = (x[at] * q[i]).sum(axis=1)  # the same sum wherever the pair meets
                    best = np.lexsort((ids[at], -score))
                    _, first = np.unique(ids[at][best], return_index=True)
                    best = best[np.sort(first)][:k]
                    out.append(list(zip((-score[best]).tolist(), ids[at][best].tolist())))
                found = pa.array([[{"s": s, "id": v} for s, v in o] for o in out], pa.list_(pa.struct([("s", pa.float64()), ("id", pa.int64())])))
                yield pa.RecordBatch.from_arrays([pa.array(qids), found], names=["query_id", "found"])

    own_lists = blocks(lists, PART)

    def answers(asking: DataFrame, plan: Plan) -> DataFrame:
        """(query_id, best): the best ``k`` distinct IDs in the lists that ``plan`` takes."""
        asked = asking.select("vec_id", "h", "vec").mapInArrow(lambda it: deal(shared.value, it, plan, True), posted)
        met = own_lists.join(blocks(asked, QUERIES).select("list", F.col("ids").alias("qids"), F.col("vecs").alias("qvecs")), "list")
        found = met.mapInArrow(top, "query_id long, found array<struct<s:double,id:long>>")
        held = lambda kept, x: (F.size(kept) >= k) | F.exists(kept, lambda y: y["id"] == x["id"])
        best = F.aggregate(F.array_sort(F.flatten(F.collect_list("found"))), F.array().cast("array<struct<s:double,id:long>>"),
                           lambda kept, x: F.when(held(kept, x), kept).otherwise(F.concat(kept, F.array(x))))
        return common.pinned(found.groupBy("query_id").agg(best.alias("best")))

    asking = rows.filter("asks")
    best = answers(asking, plan)
    others = rows.select("vec_id").distinct().limit(k + 1).count() - 1
    full = best.filter(F.size("best") >= min(k, others)).select("query_id")
    short = asking.join(full, F.col("vec_id") == F.col("query_id"), "left_anti")
    if not short.isEmpty():
        best = best.join(full, "query_id", "left_semi").unionByName(answers(short, replace(plan, least=1.0, most=1.0)))
    return best.select("query_id", F.posexplode("best").alias("r", "b")).select(
        "query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.s")).alias("score"))
