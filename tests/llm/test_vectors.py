"""Operators on vectors against brute force."""

import threading
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import common, covertree, postings

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n long, root long, score double"


def odd_vectors(n=700, dim=8, seed=4):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(60, dim))
    x = (base[rnd.integers(0, 60, n)] + 0.07 * rnd.normal(size=(n, dim))) * rnd.uniform(0.5, 3, (n, 1))
    rows = [[i * 3, v.astype("f4").tolist(), int(l)] for i, (v, l) in enumerate(zip(x, rnd.integers(0, 3, n)))]
    for i in range(0, 60, 2):
        rows[i][1], rows[i][2] = rows[1][1], rows[1][2]  # one common vector
    rows[70][1], rows[71][1], rows[72][1] = None, [0.0] * dim, []
    rows[73][1] = [*rows[73][1][:-1], None]
    rows[74][1] = [*rows[74][1][:-1], float("nan")]
    rows[75][1] = [*rows[75][1][:-1], float("inf")]
    rows[76][1] = rows[76][1][:-1]  # shorter
    rows[77][2] = None
    rows[78][0] = None
    rows.append(list(rows[5]))
    rnd.shuffle(rows)
    return [(*r, "x", 1, 2, 0.5) for r in rows]


def fine(r):
    e = r[1]
    return bool(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)


@pytest.mark.parametrize("leaf", [1024, 40])
def test_cover_tree(spark, monkeypatch, leaf):
    monkeypatch.setattr(covertree, "LEAF", leaf)
    rows = odd_vectors()
    use = [fine(r) and r[2] is not None and r[0] is not None for r in rows]
    n = len(rows)
    link = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if use[i] and use[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                link[i][j] = link[j][i] = bool(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98)
    low = [r[0] for r in rows]
    for _ in range(n):
        new = [min([low[i], *(low[j] for j in range(n) if link[i][j])]) if use[i] else low[i] for i in range(n)]
        if new == low:
            break
        low = new
    want = sorted(((r[0], sum(link[i]), low[i], r[0] is not None and r[0] == low[i]) for i, r in enumerate(rows)), key=str)
    assert sum(w[1] for w in want) > 1000
    got = covertree.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), 0.98)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_cover_tree_without_rows(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("part", [2048, 16])
def test_nearest(spark, monkeypatch, part):
    monkeypatch.setattr(postings, "PART", part)
    monkeypatch.setattr(postings, "QUERIES", part)
    monkeypatch.setattr(postings, "LIST", 25)
    rows = odd_vectors(900)
    use = {(r[0], tuple(r[1])) for r in rows if fine(r) and r[0] is not None and len(r[1]) == 8}
    got = {}
    for r in postings.nearest(spark.createDataFrame(rows, SCHEMA).repartition(4), F.pmod("vec_id", F.lit(20)) == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    queries = [q for q in use if q[0] % 20 == 0]
    assert {*got} == {q[0] for q in queries}
    for i, e in queries:
        best = sorted((-float(np.array(e) @ np.array(x)), v) for v, x in use if v != i)[:20]
        mine = sorted(got[i])
        assert [m[0] for m in mine] == list(range(1, 21)) and len({m[1] for m in mine}) == 20
        score = {v: float(np.array(e) @ np.array(x)) for v, x in use}
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hit += len({v for _, v in best} & {m[1] for m in mine})
        total += 20
    assert hit / total >= 0.9


def test_nearest_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (3, [0.0, 2.0], None)], "vec_id long, embedding array<float>, label int")
    rows = [tuple(r) for r in postings.nearest(few, F.pmod("vec_id", F.lit(20)) == 0, k=20).orderBy("query_id", "rank").collect()]
    assert rows == [(0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.5)]
    assert postings.nearest(few.limit(0), F.pmod("vec_id", F.lit(20)) == 0).count() == 0


@pytest.mark.parametrize("plan", [postings.Plan(), postings.Plan(least=1.0, most=1.0)])
@pytest.mark.parametrize("size", [400, 25])
def test_nearest_beside_an_id_that_comes_often(spark, monkeypatch, size, plan):
    """One ID a hundred times with one vector, another with a hundred different ones, both nearer than all others."""
    monkeypatch.setattr(postings, "LIST", size)
    rnd = np.random.default_rng(6)
    q = np.array([3.0, 0.0, 0.0, 0.0])
    rows = [(0, q.tolist())] + [(i, rnd.normal(size=4).tolist()) for i in range(1, 60)]
    rows += [(100, [9.0, 0.0, 0.0, 0.0])] * 100 + [(101, [8.0, float(y), 0.0, 0.0]) for y in rnd.normal(size=100)] + [(102, [7.0 - i / 100, 0.0, 0.0, 0.0]) for i in range(100)]
    use = {(i, tuple(np.array(e, "f4").astype(float))) for i, e in rows}
    score = {}
    for i, e in use - {(0, tuple(q))}:
        score[i] = max(score.get(i, -np.inf), float(np.array(e) @ q))
    want = sorted(((-s, i) for i, s in score.items()))[:20]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    mine = sorted((r["rank"], r.vec_id, r.score) for r in postings.nearest(df, F.col("vec_id") == 0, k=20, plan=plan).collect())
    assert [m[0] for m in mine] == list(range(1, 21)) and len({m[1] for m in mine}) == 20
    assert all(abs(score[i] - s) < 1e-9 for _, i, s in mine)
    if size == 400 or plan.least == 1:
        assert [m[1] for m in mine] == [i for _, i in want]


def test_dealt_batches_are_bounded(monkeypatch):
    """10,000 rows in one batch, 40 lists: what is expanded at once stays near CELLS."""
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(10_000, 4))
    own = postings.Centroids(x[:1000], 40, float(np.linalg.norm(x, axis=1).max()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(x))), pa.array(range(len(x))), pa.array(x.tolist())], names=["vec_id", "h", "vec"])
    for ask in (False, True):
        monkeypatch.setattr(postings, "CELLS", 1 << 40)
        want = [*postings.deal(own, [batch, batch.slice(0, 0)], postings.Plan(), ask)]
        monkeypatch.setattr(postings, "CELLS", 4096)
        got = [*postings.deal(own, [batch, batch.slice(0, 0)], postings.Plan(), ask)]
        assert len(want) == 1 and max(b.num_rows * 4 for b in got) <= 4096
        assert pa.Table.from_batches(got).equals(pa.Table.from_batches(want))


def test_cover_tree_of_one_direction(spark):
    """More scaled copies of one vector than a leaf holds, at the real LEAF: they cannot be split by distance."""
    rnd = np.random.default_rng(2)
    v = rnd.normal(size=8)
    n = covertree.LEAF + 76
    rows = [(i, (v * (1 + i / 7)).tolist(), "a") for i in range(n)] + [(n + i, rnd.normal(size=8).tolist(), "b") for i in range(50)]
    got = {r.vec_id: r for r in covertree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), 0.98).collect()}
    assert all(got[i].n_links == n - 1 and got[i].component_id == 0 and got[i].kept == (i == 0) for i in range(n))


def test_cover_tree_keeps_doubles(spark):
    """Finite doubles beyond the range of float, and ones that differ by less than a float can tell."""
    rows = [(1, [1e300, 1e300], 5), (2, [1e299, 1e299], 5), (3, [1.0, 0.0], 5), (4, [1.0, 1e-12], 5), (5, [0.0, -1.0], 5)]
    got = [tuple(r) for r in covertree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), 0.98).orderBy("vec_id").collect()]
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)]


def test_nearest_recall_at_production_settings(spark):
    """The registered search over the whole table, against brute force; repeated vectors tie and go by ID."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    rows = table.unionByName(table.filter("vec_id < 40").selectExpr("vec_id + 100000 as vec_id", "embedding"))
    x = {r.vec_id: np.array(r.embedding, np.float64) for r in rows.collect()}
    ids = np.array(sorted(x))
    all_of = np.stack([x[i] for i in ids])
    got = {}
    for r in postings.nearest(rows, F.pmod("vec_id", F.lit(20)) == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {*got} == {i for i in x if i % 20 == 0}
    hit = 0
    for i, mine in got.items():
        score = all_of @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:20]
        mine = sorted(mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1])) and len(mine) == 20
        hit += len({int(ids[j]) for j in order} & {m[1] for m in mine})
    assert hit / (20 * len(got)) >= 0.9


def files_of(spark):
    """Shuffle and checkpoint files of the session with their sizes."""
    dirs = [*spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString(), spark.sparkContext.getCheckpointDir().removeprefix("file:")]
    found = {}
    for path in (p for d in dirs for p in Path(d).rglob("*")):
        try:
            found[str(path)] = path.stat().st_size if path.is_file() else 0
        except OSError:
            pass  # deleted meanwhile
    return found


def test_settled_and_freed_leave_no_files(spark):
    before = files_of(spark)
    df = spark.range(20_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    got = common.settled(df)
    assert spark.conf.get(key, None) == setting
    new = {f for f in files_of(spark) if f not in before}
    assert not [f for f in new if "shuffle" in f] and [f for f in new if "part-" in f]
    assert sorted(r.n for r in got.collect()) == sorted([2857] * 6 + [2858])
    common.freed(got)
    assert not [f for f in files_of(spark) if f not in before and "part-" in f]


def test_cover_tree_without_structure_stays_small_on_disk(spark, monkeypatch):
    """Nothing can be pruned, all leaves of a label meet: shuffle files and checkpoints together stay below the budget of 4 times
    the table (about 390 bytes a row as Parquet), at any time."""
    monkeypatch.setattr(covertree, "LEAF", 128)
    monkeypatch.setattr(covertree, "ROUND", 1 << 20, raising=False)
    rnd = np.random.default_rng(7)
    n = 5_000
    x = rnd.normal(size=(n, 64)).astype("f4")
    x[1::1000] = x[0::1000] * 1.5
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(2)
    table.write.parquet(path := common.scratch(spark, "table"))
    before, most, over, limit = files_of(spark), [0], threading.Event(), 4 * 390 * n

    def watch():
        while not over.wait(0.05):
            most[0] = max(most[0], sum(size for f, size in files_of(spark).items() if f not in before))
            if most[0] > limit:
                spark.sparkContext.cancelAllJobs()

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = covertree.near_duplicates(spark.read.parquet(path), 0.98).collect()
    finally:
        over.set()
        watcher.join()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.n_links} == {i + k: (1, i) for i in range(0, n, 1000) for k in (0, 1)}
    assert most[0] <= limit


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cover_tree_in_many_bundles_and_rounds(spark, monkeypatch, kind):
    """Bundles of a few blocks, dealt in several rounds; a cluster that spans bundles, and chains of links."""
    monkeypatch.setattr(covertree, "LEAF", 24)
    monkeypatch.setattr(covertree, "BUNDLE", 20 * 60)
    monkeypatch.setattr(covertree, "ROUND", 1)
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(900, 20))
    x[:300] = x[0] + 0.1 * rnd.normal(size=(300, 20))
    for i in range(301, 340):
        x[i] = x[i - 1] + 0.6 * rnd.normal(size=20) / np.sqrt(20) * np.linalg.norm(x[i - 1]) / 4
    x = x.astype("f4").astype(float)
    ids = rnd.permutation(900) * 2
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = (unit @ unit.T >= 0.98) & ~np.eye(900, dtype=bool)
    low = ids.copy()
    for _ in range(900):
        new = np.array([min(low[i], *low[link[i]]) if link[i].any() else low[i] for i in range(900)])
        if (new == low).all():
            break
        low = new
    df = spark.createDataFrame([(int(i), v.tolist(), 4) for i, v in zip(ids, x)], f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_duplicates(df, 0.98).collect()}
    assert link[:300, :300].sum() > 10_000 and link[300:340, 300:340].sum() > 20
    assert got == {int(i): (int(c), int(k), bool(k == i)) for i, c, k in zip(ids, link.sum(axis=1), low)}
