"""Hard negatives against brute force in Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import negatives, residues

SCHEMA = "vec_id long, embedding array<double>, label int, h string, dim int, rank int, wanted string, positive_id long"
ANCHOR = "vec_id % 10 = 0"


@pytest.mark.parametrize("dim,top", [(0, 5), (1, 9), (64, 300), (700, 1 << 12), (9, 1 << 25), (3000, 120)])
def test_exact_products(dim, top):
    rnd = np.random.default_rng(dim)
    a, b = rnd.integers(-top, top + 1, (17, dim)), rnd.integers(-top, top + 1, (31, dim))
    if dim:
        a[0], b[0], a[1], b[1] = top, top, -top, top  # the extremes
    primes = residues.primes_for(max(1, dim * top * top))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert residues.scores(residues.residues(a, primes), residues.residues(b, primes), primes).tolist() == want


def brute(rows, positives=5, negatives=10):
    """Rows as (id, vector, label); repeated rows once."""
    seen = {}
    for i, e, label, *_ in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        c = tuple(math.floor(256 * x) for x in e)
        if sum(x * x for x in c) < 1 << 56:
            seen[i, c, label] = None
    out = []
    for i, a, la in seen:
        if i % 10:
            continue
        score = [(sum(x * y for x, y in zip(a, c)), j, label) for j, c, label in seen if j != i and len(c) == len(a)]
        score.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in score if s[2] == la][:positives]:
            near = [s for s in score if s[2] != la and 30 * p <= 100 * s[0] <= 90 * p][:negatives]
            out += [(i, j, k, n[1], p, n[0]) for k, n in enumerate(near, 1)]
    return sorted(out)


def odd_rows(n=400, dim=6):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(n, dim)).round(1) * rnd.uniform(0.01, 2, (n, 1))
    rows = [[i, v.tolist(), int(k)] for i, (v, k) in enumerate(zip(x, rnd.choice(4, n, p=[0.7, 0.1, 0.1, 0.1])))]
    for i in range(0, 80, 2):
        rows[i][1] = rows[40][1]  # ties in score, under several labels
    rows[100][1], rows[110][1], rows[120][1], rows[121][1] = None, [], [0.0] * dim, []
    rows[130][1] = [*rows[130][1][:-1], None]
    rows[131][1] = [*rows[131][1][:-1], math.nan]
    rows[132][1] = [*rows[132][1][:-1], -math.inf]
    rows[140][1], rows[141][1] = [1e300] * dim, [3e4] * dim
    rows[150][1] = rows[150][1][:-1]
    rows[160][2], rows[170][0] = None, None
    rows += [list(rows[200]), list(rows[200]), list(rows[7])]
    rnd.shuffle(rows)
    return [(*r, "x", 1, 2, "w", 3) for r in rows]


@pytest.mark.parametrize("sizes", [(2048, 8192, 1 << 22), (7, 50, 64)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("ANCHORS", "ROWS", "STRIP"), sizes):
        monkeypatch.setattr(negatives, name, value)
    rows = odd_rows()
    want = brute(rows)
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), F.expr(ANCHOR))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 500


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [0.0, 1.0], 1), (1, [0.9, 0.1], 1), (1, [0.1, 0.9], 1), (2, [0.5, 0.0], 2), (3, [0.0, 0.5], 2)]
    got = negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), F.expr(ANCHOR))
    assert sorted(map(tuple, got.collect())) == brute([(i, np.float32(e).tolist(), k) for i, e, k in rows])


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, F.expr(ANCHOR)).collect() == []
    one = spark.createDataFrame([(10, [0.5], 1, "x", 1, 2, "w", 3)], SCHEMA)
    assert negatives.mine(one, F.expr(ANCHOR)).collect() == []
    assert negatives.mine(one, F.lit(None).cast("boolean")).collect() == []
