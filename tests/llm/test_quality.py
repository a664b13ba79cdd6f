"""The ordinal classifier: held-out accuracy, invariants and odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.llm import quality
from ledgerlark.llm.common import ship

from odd_cases import none, odd  # noqa: F401

SF01 = "/root/testdata/sf0.01"


def test_held_out(spark):
    ship(spark)
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    held = F.pmod("doc_id", F.lit(5)) == 0
    model = quality.fit(docs, labels.filter(~held))
    rows = quality.classify(docs, model).join(quality.graded(labels.filter(held)), "doc_id").collect()
    clean = [r.selected for r in rows if r.grade == 2]
    foul = [r.selected for r in rows if r.grade < 2]
    assert np.mean(clean) > 0.9 and np.mean(foul) < 0.45 and len(foul) > 10
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(3)]
    assert mean[0] < mean[2] and mean[1] < mean[2]


def test_planted_toxic_and_clean(spark):
    """Documents unlike any labelled one but for their words."""
    ship(spark)
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = quality.fit(docs, labels)
    text = docs.join(quality.graded(labels).filter("grade = 2"), "doc_id").orderBy("doc_id").limit(20).select("doc_id", "text")
    foul = text.select("doc_id", F.concat("text", F.lit(" you idiot what a pathetic loser, such scum and trash")).alias("text"))
    assert quality.classify(text, model).filter("selected").count() >= 19
    assert quality.classify(foul, model).filter("selected").count() <= 4


def test_same_model_at_any_partitioning(spark):
    ship(spark)
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    a, b = quality.fit(docs, labels, max_rows=150), quality.fit(docs.repartition(7), labels.repartition(3), max_rows=150)
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()
    assert a.thresholds[0] < a.thresholds[1]


def test_an_id_in_many_rows_counts_once(spark):
    ship(spark)
    rows = [(i, f"text {i}") for i in range(40)] + [(3, f"other text {i}") for i in range(200)] + [(4, "text 4")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = quality.graded(spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int"))
    slots, grades = quality.sample_slots(docs.repartition(4), labels, 20, 17)
    assert len(slots) == len(grades) == 20
    again, same = quality.sample_slots(docs.repartition(7), labels, 20, 17)
    assert all((a == b).all() for a, b in zip(slots, again)) and (grades == same).all()
    assert len(quality.sample_slots(docs, labels, 1000, 17)[0]) == 30


def test_gradient():
    """Fitted on clear data, the ranks follow the grades; thresholds ascend."""
    rnd = np.random.default_rng(1)
    grades = rnd.integers(0, 3, 600)
    slots = [np.unique(np.concatenate([[10 + g], rnd.integers(100, 160, 20)])) for g in grades]
    model = quality.OrdinalModel.fit(slots, grades)
    score = np.array([model.weights[s].sum() for s in slots])
    tails = model.tails(score)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails.sum(axis=1).round()).astype(int) == grades).mean() > 0.95


def test_odd_rows(spark, odd, none):
    ship(spark)
    marks = "doc_id long, quality int, toxic int, text string"
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(30)] + [(3, 1, 1, None), (3, 1, 0, None), (None, 1, 1, None), (4, None, None, None), (999, 1, 0, None)], marks)
    assert {r.doc_id: r.grade for r in quality.graded(labels).collect()}[3] == 0
    assert 4 in {r.doc_id for r in quality.graded(labels).collect()}  # its other row counts
    model = quality.fit(odd, labels)
    rows = quality.classify(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.p_good <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    kept = quality.select(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.selected for r in rows)
    assert quality.classify(none, model).count() == 0
    for few in (labels.limit(0), labels.filter("quality = 1 and toxic = 0")):
        assert quality.fit(odd, few) is None
    assert quality.fit(none, labels) is None
    assert quality.classify(odd, None).filter("selected and p_good = 1 and expected_grade is null").count() == odd.count()
    assert quality.select(odd, None).count() == odd.count()


def plain_score(model, text):
    """Weights summed feature by feature, from the features' definition."""
    import math
    import re
    import zlib
    slot = lambda name: zlib.crc32(name.encode()) % quality.DIMS
    words, found = text.split(), set()
    for w in words:
        kinds = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w]
        found.add(slot("s:" + "".join(k for i, k in enumerate(kinds) if not i or k != kinds[i - 1])))
        found.add(slot("w:" + re.sub(r"^[\W_]+|[\W_]+$", "", w).lower()))
    n, lines = len(words), text.split("\n")
    if not n:
        found.add(slot("p:empty"))
    else:
        found |= {slot(f"p:distinct:{int(10 * len(set(words)) / n) if n >= quality.FEW else 'short'}"), slot(f"p:long:{min(int(sum(map(len, words)) / n), 20)}"),
                  slot(f"p:again:{int(10 * sum(a == b for a, b in zip(words, words[1:])) / n)}"), slot(f"p:size:{int(math.log2(n))}"),
                  slot(f"p:lines:{int(8 * len(set(lines)) / len(lines))}")}
    score = sum(float(model.weights[i]) for i in found)
    return [1 / (1 + math.exp(t - score)) for t in model.thresholds]


def test_scores_against_plain_python(spark):
    ship(spark)
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet").limit(150), spark.read.parquet(f"{SF01}/labels.parquet")
    more = spark.createDataFrame([(-1, "x" * 40 + " " + "-" * 12 + "word" + "!" * 20 + " A1b2"), (-2, ""), (-3, "_under_ 'quoted' " * 5)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(more)
    model = quality.fit(spark.read.parquet(f"{SF01}/documents.parquet"), labels, max_rows=300)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.classify(docs, model).collect():
        tails = plain_score(model, texts[r.doc_id])
        assert abs(r.expected_grade - sum(tails)) < 1e-6 and abs(r.p_good - tails[-1]) < 1e-6


def test_gradient_by_finite_differences():
    """One step of the fit goes along the derivative of the penalised likelihood, as differences of it say."""
    rnd = np.random.default_rng(4)
    grades = rnd.integers(0, 3, 120)
    slots = [np.unique(rnd.integers(0, 12, 5)) for _ in grades]

    def loss(w, theta, l2=3e-4):
        score = np.array([w[s].sum() for s in slots])
        edge = np.concatenate([[-np.inf], theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))]), [np.inf]])
        cdf = lambda z: 1 / (1 + np.exp(-z))
        return -np.log(cdf(edge[grades + 1] - score) - cdf(edge[grades] - score)).mean() + l2 / 2 * (w @ w)

    w, theta = rnd.normal(size=12) / 3, np.array([-0.4, 0.2])
    gw, gtheta = quality.slopes(w, theta, np.repeat(np.arange(120), [len(s) for s in slots]), np.concatenate(slots), grades, 3, 3e-4)
    for k in range(12):
        d = np.eye(12)[k] * 1e-5
        assert abs((loss(w + d, theta) - loss(w - d, theta)) / 2e-5 - gw[k]) < 1e-7
    for k in range(2):
        d = np.eye(2)[k] * 1e-5
        assert abs((loss(w, theta + d) - loss(w, theta - d)) / 2e-5 - gtheta[k]) < 1e-7
