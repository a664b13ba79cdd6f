"""Embedding near-duplicates: exact cosine threshold pairs by a dual traversal of cover trees.

Vectors of one label (and dimension) form a tree over the unit sphere, where a cosine threshold is a
distance. Every node knows its center and the radius that covers all vectors below it. A level's centers are
at most ``FAN`` vectors picked farthest first from a sample, until they cover it within the level's radius if so few suffice;
they need not be among the next level's. So this is a ball tree with measured covering radii, not a strict cover
tree (nested nets, radii halved each level): bounds hold for any choice of centers, and a bounded fan keeps a round small. Two nodes whose centers are farther apart than both covering radii and
the threshold distance hold no pair, and are pruned with everything below them.

The upper levels are built by Spark jobs, one level a round, until a node holds at most ``LEAF``
vectors: a label of any size is dealt over its nodes. Vectors travel as packed blocks of at most ``LEAF``, in the
width they came in, and what a round does not need any more (checkpoint, shuffle files) is deleted at once. Every
block is split on in memory down to a few dozen vectors; centers and covering radii of these smallest nodes stay
beside it. Blocks that follow one another in the tree make a bundle, the unit of the traversal's first step: a pair
of bundles is kept if the balls of its parts allow a pair. Kept pairs go to one task each, in so many rounds that a
round moves about as much as all blocks hold, however many pairs there are. Inside a pair of bundles the traversal
goes on over blocks and smallest nodes; what it leaves is compared by a projection on ``SHADOW`` directions, which
never lengthens a distance, and what passes that by cosines in double precision against the threshold itself. A
pair of bundles returns link counts and a spanning set of its links, never all pairs. Vectors without structure (no
cluster at any scale) prune little in many dimensions; then all bundle pairs of a label are compared.

Equal vectors are folded first and weighted by their number.

Edge cases. Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a
null label, link with nothing and are components of their own. Rows with a null ID link with nothing and
are not kept. Repeated rows link with one another; an ID that comes with different vectors names a node of either.
Vectors of different length never link. An empty table gives an empty result. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

LEAF, FAN, SAMPLE, SMALL = 1024, 32, 512, 48
PIECE, BUNDLE, BALLS = 256, 1 << 22, 16  # vectors of a piece, components of a bundle
ROUND = 1 << 27  # bytes that a round of the traversal moves, if all bundles hold less
SHADOW, TILE = 16, 512
GROUP = ["label", "dim"]
DATA = ["pids", "h1", "h2", "ns", "vecs"]
LOOSE = "label string, dim int, node string, parent string, " + ", ".join(f"{c} binary" for c in DATA)
BLOCK = "label string, dim int, node string, split boolean, k1 long, k2 long, " + ", ".join(f"{c} binary" for c in DATA)
BOUND = "label string, dim int, bundle int, seq int, " + ", ".join(f"{c} binary" for c in (*DATA, "starts", "centers", "rhos"))


def classes(rows: DataFrame) -> DataFrame:
    """Equal vectors of a label folded: label, dim, h1, h2 (hashes), pid (smallest ID), n, vec."""
    return (rows.filter("h1 is not null").groupBy("label", "dim", "h1", "h2")
            .agg(F.min("vec_id").alias("pid"), F.count("*").alias("n"), F.first("vec").alias("vec")))


def _kind(embeddings: DataFrame) -> str:
    """Type that the vectors are kept in: float if they come as such, else double."""
    return "float" if embeddings.select("embedding").schema[0].dataType.elementType.typeName() == "float" else "double"


def hashed(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, dim, h1, h2, vec; the hashes are null for rows that link with nothing."""
    ok = vectors.usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    kind = _kind(embeddings)
    vec = F.transform("embedding", lambda x: x.cast(kind) + F.lit(0.0).cast(kind))  # one zero only
    return (embeddings.select("vec_id", F.col("label").cast("string").alias("label"), F.size("embedding").alias("dim"),
                              F.when(ok, vec).alias("vec"))
            .withColumn("h1", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec")))
            .withColumn("h2", F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit("second"), "vec", "label"))))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in ddl.split(", "))])


def _rows(batches):
    for b in batches:
        for i in range(b.num_rows):  # one at a time: a batch may hold many large blocks
            yield b.slice(i, 1).to_pylist()[0]


def loosened(points: DataFrame, kind: str) -> DataFrame:
    """Classes as packed pieces of the root of their label and dimension."""
    code, schema, most = "<f4" if kind == "float" else "<f8", _schema(LOOSE), PIECE

    def run(batches):
        for b in batches:
            label = b.column("label").dictionary_encode()
            dim = b.column("dim").to_numpy()
            order = np.lexsort((dim, label.indices.to_numpy()))
            own = np.stack([label.indices.to_numpy()[order], dim[order]])
            cuts = np.flatnonzero((own[:, 1:] != own[:, :-1]).any(axis=0)) + 1
            out = []
            for group in np.split(order, cuts) if len(order) else []:
                for at in range(0, len(group), most):
                    t = b.take(pa.array(group[at:at + most]))
                    ints = {c: t.column(k).to_numpy().astype("<i8").tobytes() for c, k in zip(DATA, ("pid", "h1", "h2", "n"))}
                    out.append({"label": t.column("label")[0].as_py(), "dim": t.column("dim")[0].as_py(), "node": "0", "parent": "",
                                "vecs": np.asarray(t.column("vec").flatten(), code).tobytes()} | ints)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return points.select("label", "dim", "pid", "h1", "h2", "n", "vec").mapInArrow(run, LOOSE)


def crowded(loose: DataFrame, before: DataFrame | None) -> DataFrame:
    """Nodes of more than LEAF vectors: their size, and whether they are to be split.

    A node is split while it is large, unless it is the only child of its parent: its vectors have one direction (as
    far as the centers tell), and it is a leaf of several blocks."""
    born = loose.groupBy(*GROUP, "node", "parent").agg(F.sum(F.octet_length("pids") / 8).cast("long").alias("__size")).filter(F.col("__size") > LEAF)
    if before is None:
        return born.select(*GROUP, "node", "__size", F.lit(True).alias("split"))
    up = before.select(*GROUP, F.col("node").alias("parent"), F.col("__size").alias("__all"))
    return born.join(up, [*GROUP, "parent"]).select(*GROUP, "node", "__size", (F.col("__size") != F.col("__all")).alias("split"))


def packed(loose: DataFrame, large: DataFrame) -> DataFrame:
    """Pieces of one node joined to blocks of at most LEAF vectors; ``large`` has the nodes that need several."""
    schema, most = _schema(BLOCK), LEAF

    def pack(table: pa.Table) -> pa.Table:
        first = {c: table.column(c)[0].as_py() for c in (*GROUP, "node", "split")}
        whole = {c: b"".join(table.column(c).to_pylist()) for c in DATA}
        n = len(whole["pids"]) // 8
        out = []
        for at in range(0, n, most):
            part = {c: v[len(v) // n * at:len(v) // n * (at + most)] for c, v in whole.items()}
            out.append(first | part | {k: int(np.frombuffer(part[c], "<i8", 1)[0]) for k, c in (("k1", "h1"), ("k2", "h2"))})
        return pa.Table.from_pylist(out, schema=schema)

    # A node may hold most of all vectors: its parts are dealt on their own. Nodes that need parts are few.
    one = F.xxhash64("h1", "h2")
    dealt = loose.join(F.broadcast(large), [*GROUP, "node"], "left").withColumn(
        "__part", F.pmod(one, F.coalesce(F.ceil(F.col("__size") / LEAF), F.lit(1)).cast("long")))
    dealt = dealt.select(*GROUP, "node", "__part", F.coalesce("split", F.lit(False)).alias("split"), *DATA)
    n = int(loose.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, *GROUP, "node", "__part").groupBy(*GROUP, "node", "__part").applyInArrow(pack, BLOCK)


def nets(blocks: DataFrame, large: DataFrame, level: int, kind: str) -> DataFrame:
    """Centers for every node that is split, from a bounded number of its vectors.

    Any centers give a right tree, since covering radii are measured over all vectors; so a sample does.
    """
    radius, code, width = 2.0 / 2**level, *(("<f4", 4) if kind == "float" else ("<f8", 8))

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        x = vectors.scaled(np.concatenate([vectors.matrix(v, dim, code) for v in pdf["vecs"]]))
        x = x / np.linalg.norm(x, axis=1)[:, None]
        x = x[np.lexsort(x.T)]
        r, at = radius, np.array([0])
        while len(at) < 2 and r > 1e-9:
            r /= 2
            at = vectors.farthest_first(x, FAN, r)
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "dim": [dim], "node": pdf["node"].iloc[:1],
                             "centers": [x[at].astype("<f8").tobytes()]})

    share = F.least(F.lit(1.0), F.lit(64.0) * LEAF / F.col("__size"))  # of the blocks
    some = blocks.drop("split").join(F.broadcast(large.filter("split")), [*GROUP, "node"])
    some = some.filter(F.pmod(F.xxhash64("k1"), F.lit(1 << 20)) <= share * (1 << 20))
    some = some.withColumn("take", F.greatest(F.lit(8), F.ceil(F.lit(float(SAMPLE)) * LEAF / F.col("__size"))).cast("int"))
    some = some.select(*GROUP, "node", F.expr(f"substring(vecs, 1, take * dim * {width})").alias("vecs"))
    return some.groupBy(*GROUP, "node").applyInPandas(pick, "label string, dim int, node string, centers binary")


def assigned(blocks: DataFrame, centers: DataFrame, kind: str) -> DataFrame:
    """Split nodes' vectors as packed pieces of their child nodes."""
    code, schema, most = "<f4" if kind == "float" else "<f8", _schema(LOOSE), PIECE

    def run(batches):
        for row in _rows(batches):
            raw = np.frombuffer(row["vecs"], code).reshape(-1, row["dim"])
            x = vectors.scaled(raw.astype(np.float64))
            x = x / np.linalg.norm(x, axis=1)[:, None]
            c = x[:1] if row["centers"] is None else vectors.matrix(row["centers"], row["dim"], "<f8")
            at, _ = vectors.nearest(x, c)
            ints = {k: np.frombuffer(row[k], "<i8") for k in DATA[:4]}
            out = []
            for i in np.unique(at).tolist():
                own = np.flatnonzero(at == i)
                for k in range(0, len(own), most):
                    part = own[k:k + most]
                    out.append({"label": row["label"], "dim": row["dim"], "node": f"{row['node']}.{i:02d}", "parent": row["node"],
                                "vecs": raw[part].tobytes()} | {k: v[part].tobytes() for k, v in ints.items()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return blocks.join(centers, [*GROUP, "node"], "left").mapInArrow(run, LOOSE)


def leaves(points: DataFrame, kind: str) -> list[DataFrame]:
    """The tree's leaves, as blocks, in several frames; a round moves the vectors of the nodes that are still split, the rest is left alone."""
    loose = common.settled(loosened(points, kind))
    large, done = None, []
    for level in itertools.count(1):  # every split node loses a child or becomes final
        large = common.settled(crowded(loose, large))
        blocks = common.settled(packed(loose, large))
        common.freed(loose)
        if not large.filter("split").take(1):
            break
        split = blocks.filter("split")
        centers = common.settled(nets(split, large, level, kind))
        loose = common.settled(assigned(split, centers, kind))
        done.append(common.settled(blocks.filter(~F.col("split"))))
        common.freed(blocks, centers)
    return [*done, blocks]


def bundled(blocks: DataFrame, kind: str) -> DataFrame:
    """Blocks in bundles of about BUNDLE components that follow one another in the tree, each block's vectors in the order
    of its smallest nodes, with these nodes' first rows, centers and covering radii."""
    code, schema = "<f4" if kind == "float" else "<f8", _schema(BOUND)

    def bind(table: pa.Table) -> pa.Table:
        first = {c: table.column(c)[0].as_py() for c in (*GROUP, "bundle")}
        dim, out = first["dim"], []
        names = table.select(["node", "k1", "k2"]).to_pylist()
        for seq, at in enumerate(sorted(range(len(names)), key=lambda i: tuple(names[i].values()))):
            raw = np.frombuffer(table.column("vecs")[at].as_py(), code).reshape(-1, dim)
            x = vectors.scaled(raw.astype(np.float64))
            x = x / np.linalg.norm(x, axis=1)[:, None]
            nodes = smallest(x)
            order = np.concatenate(nodes)
            centers = np.stack([x[rows].mean(axis=0) for rows in nodes]).astype("<f4")
            rhos = [np.linalg.norm(x[rows] - c, axis=1).max() for rows, c in zip(nodes, centers.astype(np.float64))]
            out.append(first | {c: np.frombuffer(table.column(c)[at].as_py(), "<i8")[order].tobytes() for c in DATA[:4]} | {
                "seq": seq, "vecs": raw[order].tobytes(), "centers": centers.tobytes(), "rhos": np.array(rhos, "<f8").tobytes(),
                "starts": np.cumsum([0, *map(len, nodes)])[:-1].astype("<i8").tobytes()})
        return pa.Table.from_pylist(out, schema=schema)

    slim = blocks.select(*GROUP, "node", "k1", "k2", (F.octet_length("pids") / 8).cast("long").alias("__n"))
    total = slim.agg(F.sum("__n")).first()[0] or 0
    most = F.greatest(F.lit(1), F.least(F.floor(F.lit(BUNDLE) / F.col("dim")), F.lit(max(LEAF, total // 32))))
    here = F.struct("node", "k1", "k2")
    before = F.sum("__n").over(Window.partitionBy(*GROUP).orderBy("node", "k1", "k2").rowsBetween(Window.unboundedPreceding, -1))
    place = slim.select(*GROUP, here.alias("here"), F.floor(F.coalesce(before, F.lit(0)) / most).alias("bundle"))
    firsts = (place.groupBy(*GROUP, "bundle").agg(F.min("here").alias("here")).groupBy(*GROUP).agg(F.collect_list("here").alias("firsts"))
              .filter(F.size("firsts") > 1))  # so few that the blocks need not move for them
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bundle = F.coalesce(F.size(F.filter("firsts", lambda x: x <= here)) - 1, F.lit(0)).cast("int")
    dealt = blocks.join(F.broadcast(firsts), GROUP, "left").withColumn("bundle", F.when(F.col("firsts").isNull(), 0).otherwise(bundle))
    dealt = dealt.drop("split", "firsts").repartition(n, *GROUP, "bundle")
    return dealt.groupBy(*GROUP, "bundle").applyInArrow(bind, BOUND)


def bundle_pairs(bundles: DataFrame, reach: float) -> DataFrame:
    """label, dim, i, j (i <= j), size (bytes to move): pairs of bundles that the balls of their parts leave."""
    def balls(table: pa.Table) -> pa.Table:
        """At most BALLS balls that cover a bundle: runs of nodes, as they follow one another."""
        table = table.sort_by("seq")
        dim = table.column("dim")[0].as_py()
        c = np.concatenate([vectors.matrix(v, dim) for v in table.column("centers").to_pylist()])
        rho = np.concatenate([np.frombuffer(v, "<f8") for v in table.column("rhos").to_pylist()])
        runs = np.array_split(np.arange(len(c)), min(BALLS, len(c)))
        mid = [c[r].mean(axis=0) for r in runs]
        far = [float((np.linalg.norm(c[r] - m, axis=1) + rho[r]).max()) for r, m in zip(runs, mid)]
        return pa.table({"label": table.column("label")[:1], "dim": table.column("dim")[:1], "bundle": table.column("bundle")[:1],
                         "size": pa.array([sum(table.column("size").to_pylist())], pa.int64()),
                         "balls": pa.array([np.column_stack([mid, far]).astype("<f8").tobytes()])})

    def near(batches):
        for row in _rows(batches):
            one, two = (vectors.matrix(row[k], row["dim"] + 1, "<f8") for k in ("one", "two"))
            gap = apart(one[:, :-1], two[:, :-1]) - one[:, -1:] - two[:, -1]
            if row["i"] == row["j"] or gap.min() <= reach + 1e-6:
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("label", "dim", "i", "j", "size")}], schema=_schema(kept))

    kept = "label string, dim int, i int, j int, size long"
    size = functools.reduce(lambda x, y: x + y, (F.octet_length(c) for c in (*DATA, "centers", "rhos", "starts"))).cast("long")
    slim = common.settled(bundles.select(*GROUP, "bundle", "seq", "centers", "rhos", size.alias("size")).groupBy(*GROUP, "bundle").applyInArrow(
        balls, "label string, dim int, bundle int, size long, balls binary"))
    one, two = (slim.select(*GROUP, F.col("bundle").alias(i), F.col("size").alias(f"{i}_size"), F.col("balls").alias(k))
                for i, k in (("i", "one"), ("j", "two")))
    met = one.join(two, GROUP).filter("i <= j").withColumn("size", F.when(F.col("i") == F.col("j"), F.col("i_size")).otherwise(F.col("i_size") + F.col("j_size")))
    return met.select(*GROUP, "i", "j", "size", "one", "two").mapInArrow(near, kept)


class Node:
    """A node of the tree in memory: rows, center, covering radius, children."""

    __slots__ = ("rows", "center", "rho", "children")

    def __init__(self, x: np.ndarray, rows: np.ndarray):
        self.rows, self.center, self.children = rows, x[rows].mean(axis=0), []
        self.rho = float(np.linalg.norm(x[rows] - self.center, axis=1).max())
        if len(rows) > SMALL and self.rho > 1e-9:
            part = x[rows]
            at, _ = vectors.nearest(part, part[vectors.farthest_first(part, 16, self.rho / 2)])
            groups = [rows[at == k] for k in np.unique(at)]
            if len(groups) > 1:
                self.children = [Node(x, g) for g in groups]


def smallest(x: np.ndarray) -> list[np.ndarray]:
    """Rows of the smallest nodes of the tree over unit vectors, as they follow one another; neighbours that are
    SMALL together are one."""
    out, stack = [], [Node(x, np.arange(len(x)))]
    while stack:
        node = stack.pop()
        stack += node.children[::-1]
        if node.children:
            continue
        if out and len(out[-1]) + len(node.rows) <= SMALL:
            out[-1] = np.concatenate([out[-1], node.rows])
        else:
            out.append(node.rows)
    return out


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of a to all of b, right to about 1e-7 for rows of unit length at most."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0.0))


class Bundle:
    """A bundle in memory: vectors, their norms and shadows, blocks, smallest nodes with centers and covering radii."""

    def __init__(self, table: pa.Table, code: str):
        table = table.sort_by("seq")
        dim = table.column("dim")[0].as_py()
        glued = lambda c, kind: np.concatenate([np.frombuffer(v, kind) for v in table.column(c).to_pylist()])
        self.pid, self.h1, self.h2, self.n = (glued(c, "<i8") for c in DATA[:4])
        self.x = vectors.scaled(glued("vecs", code).reshape(-1, dim).astype(np.float64))
        self.norm = np.linalg.norm(self.x, axis=1)
        p = self.x @ directions(dim) / self.norm[:, None]
        square, one = (p * p).sum(axis=1)[:, None], np.ones((len(p), 1))
        self.left = np.concatenate([-2 * p, square, one], axis=1).astype(np.float32)
        self.right = np.ascontiguousarray(np.concatenate([p, one, square], axis=1).astype(np.float32).T)
        sizes = [len(v) // 8 for v in table.column("pids").to_pylist()]
        counts = [len(v) // 8 for v in table.column("starts").to_pylist()]
        offset = np.repeat(np.cumsum([0, *sizes])[:-1], counts)
        self.ends = np.append(glued("starts", "<i8") + offset, len(self.pid))  # smallest node k: rows ends[k] to ends[k + 1]
        self.blocks = np.cumsum([0, *counts])  # block k: smallest nodes blocks[k] to blocks[k + 1]
        self.centers, self.rhos = glued("centers", "<f4").reshape(-1, dim).astype(np.float64), glued("rhos", "<f8")


def directions(dim: int) -> np.ndarray:
    """SHADOW orthonormal directions, as columns; all of them in no more dimensions than that."""
    if dim <= SHADOW:
        return np.eye(dim)
    return np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, SHADOW)))[0]


def traverse(a: Bundle, b: Bundle, cosine: float, reach: float):
    """Yields (rows of a, rows of b, mask of links) wherever there are links; b is a: each pair once.

    Balls of smallest nodes decide. Where they spare little of a run of blocks, its rows are compared together, else
    those of each block, or of each smallest node."""
    size_a, size_b = np.diff(a.ends), np.diff(b.ends)

    def down(lo: int, hi: int, near: np.ndarray, blocks: np.ndarray):
        """(rows, mask of smallest nodes of b) for the smallest nodes lo to hi of a; ``blocks``: where blocks begin among them."""
        some = near.any(axis=0)
        if hi - lo == 1 or (near @ size_b) @ size_a[lo:hi] >= 0.3 * size_a[lo:hi].sum() * size_b[some].sum():
            yield (a.ends[lo], a.ends[hi]), some
            return
        cuts = [*(blocks if len(blocks) > 1 else range(lo, hi)), hi]
        for x, y in zip(cuts, cuts[1:]):
            yield from down(x, y, near[x - lo:y - lo], np.array([x]))

    at = 0
    while at < len(a.blocks) - 1:
        lo = a.blocks[at]
        to = max(at + 1, int(np.searchsorted(a.ends[a.blocks], a.ends[lo] + TILE, "right")) - 1)
        hi, own = a.blocks[to], a.blocks[at:to]
        near = apart(a.centers[lo:hi], b.centers) <= a.rhos[lo:hi, None] + b.rhos + reach + 1e-6
        if a is b:
            near[:, :lo] = False
        for rows, some in down(lo, hi, near, own):
            edge = b.ends[np.flatnonzero(np.diff(np.concatenate([[False], some, [False]]).astype(np.int8)))]
            wide = edge[2::2] - edge[1:-1:2] > SMALL  # small gaps cost less than another run
            for cols in zip(edge[::2][np.append(True, wide)], edge[1::2][np.append(wide, True)]) if len(edge) else []:
                yield from compared(a, b, rows, cols, cosine, reach)
        at = to


def compared(a: Bundle, b: Bundle, rows: tuple, cols: tuple, cosine: float, reach: float):
    """As ``traverse``, for rows of a and of b in two ranges, TILE by TILE."""
    most = np.float32(reach * reach + 1e-5)  # what rounding to floats may add
    for r0 in range(rows[0], rows[1], TILE):
        r1 = min(r0 + TILE, rows[1])
        for c0 in range(max(cols[0], r0 + 1) if a is b else cols[0], cols[1], TILE):
            c1 = min(c0 + TILE, cols[1])
            gap = a.left[r0:r1] @ b.right[:, c0:c1]
            if gap.min() > most:
                continue
            maybe = gap <= most
            i, j = np.flatnonzero(maybe.any(axis=1)) + r0, np.flatnonzero(maybe.any(axis=0)) + c0
            near = a.x[i] @ b.x[j].T / (a.norm[i][:, None] * b.norm[j][None]) >= cosine
            if a is b:
                near &= i[:, None] < j[None]
            if near.any():
                yield i, j, near


def joined(root: np.ndarray, i: np.ndarray, j: np.ndarray, near: np.ndarray) -> np.ndarray:
    """``root`` (smallest known index of each row's component) with rows i joined to rows j wherever ``near``."""
    own, at = np.unique(np.concatenate([root[i], root[j]]), return_inverse=True)
    if len(own) == 1:
        return root
    ties = np.zeros((len(own), len(own)), bool)
    r, c = np.nonzero(near)
    ties[at[:len(i)][r], at[len(i):][c]] = True
    u, v = np.nonzero(ties)
    low = np.arange(len(own))
    while True:
        new = low.copy()
        np.minimum.at(new, u, low[v])
        np.minimum.at(new, v, low[u])
        new = new[new]
        if (new == low).all():
            break
        low = new
    to = np.arange(len(root))
    to[own] = own[low]
    return to[root]


def linked(bundles: DataFrame, pairs: DataFrame, kind: str, cosine: float, reach: float) -> DataFrame:
    """Per pair of bundles and linked vector: pid, h1, h2, n (weight of its links there), root (pid of its links' smallest)."""
    out = "pid long, h1 long, h2 long, n long, root long"
    code, schema = "<f4" if kind == "float" else "<f8", _schema(out)

    def join(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("bundle"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        a = Bundle(table.filter(pa.array(side == i)), code)
        b = a if i == j else Bundle(table.filter(pa.array(side == j)), code)
        off = 0 if a is b else len(a.pid)
        pid, h1, h2, ns = ((getattr(a, c) if a is b else np.concatenate([getattr(a, c), getattr(b, c)])) for c in ("pid", "h1", "h2", "n"))
        got, root = np.zeros(len(pid), np.int64), np.arange(len(pid))
        for ra, rb, near in traverse(a, b, cosine, reach):
            rb = rb + off
            got[ra] += near @ ns[rb]
            got[rb] += near.T @ ns[ra]
            root = joined(root, ra, rb, near)
        at = np.flatnonzero(got)
        low = np.full(len(pid), np.iinfo(np.int64).max)
        np.minimum.at(low, root, pid)
        return pa.table([pa.array(c[at]) for c in (pid, h1, h2, got, low[root])], schema=schema)

    spark = bundles.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count, moved = pairs.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    held = pairs.filter("i = j").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rounds = max(1, -(-moved // max(held, ROUND)))
    n = max(least, 2 * count // rounds)
    found = []
    for k in range(rounds):  # a round moves about as much as all bundles hold
        now = pairs.filter(F.pmod(F.xxhash64(*GROUP, "i", "j"), F.lit(rounds)) == k)
        sides = now.select(*GROUP, "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("bundle"))
        met = bundles.join(F.broadcast(sides), [*GROUP, "bundle"]).repartition(n, *GROUP, "i", "j")
        found.append(common.settled(met.groupBy(*GROUP, "i", "j").applyInArrow(join, out)))
    return functools.reduce(DataFrame.unionByName, found)


def unpacked(bundles: DataFrame) -> DataFrame:
    """h1, h2, n, pid of all classes."""
    def run(batches):
        for row in _rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row[c], "<i8")) for c in ("h1", "h2", "ns", "pids")], names=["h1", "h2", "n", "pid"])

    return bundles.select("pids", "h1", "h2", "ns").mapInArrow(run, "h1 long, h2 long, n long, pid long")


def near_duplicates(embeddings: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    common.ship(embeddings.sparkSession)
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    rows, kind = hashed(embeddings), _kind(embeddings)
    blocks = leaves(classes(rows), kind)
    bundles = common.settled(bundled(functools.reduce(DataFrame.unionByName, blocks), kind))
    common.freed(*blocks)
    pairs = common.settled(bundle_pairs(bundles, reach))
    found = linked(bundles, pairs, kind, cosine, reach)
    points = common.settled(unpacked(bundles))
    common.freed(bundles)
    counts = found.groupBy("h1", "h2").agg(F.sum("n").alias("__n"))
    roots = common.components(found.select(F.col("pid").alias("u"), F.col("root").alias("v")))
    info = (points.join(counts, ["h1", "h2"], "left")
            .join(roots, F.col("pid") == F.col("node"), "left")
            .select("h1", "h2", (F.coalesce("__n", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "pid").alias("root")))
    out = rows.select("vec_id", "h1", "h2").join(info, ["h1", "h2"], "left")
    comp = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp, F.lit(False)).alias("kept"))
