"""The chunked trainer and the sparse design against NumPy, with many categories."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark import config as C
from ledgerlark.operators import features as feat
from ledgerlark.operators.model import LogisticModel, chunk_bounds
from ledgerlark.operators.queue import check_model_shape

SCHEMA = ("transaction_id long, amount_paid double, prior_transaction_count double, prior_average_amount double, same_bank int, "
          "self_transfer int, has_prior_history int, transaction_hour int, transaction_weekday int, payment_currency string, "
          "receiving_currency string, payment_format string, is_laundering int, data_split string")


def rows(n, formats, seed=5):
    rnd = np.random.default_rng(seed)
    out = []
    for i in range(n):
        prior = int(rnd.integers(0, 4))
        fmt = None if i % 41 == 0 else f"format {rnd.integers(formats)}"
        out.append((i * 3, float(rnd.lognormal(4, 2)), float(prior), float(rnd.lognormal(4, 1)) if prior else 0.0, int(rnd.random() < 0.2),
                    int(rnd.random() < 0.1), int(prior > 0), int(rnd.integers(24)), int(rnd.integers(1, 8)),
                    ["Euro", "US Dollar"][i % 2], ["Euro", "US Dollar", "Yen"][i % 3], fmt, int(rnd.random() < 0.2),
                    "train" if i < n * 0.8 and i % 10 else "test"))
    return out


def numpy_design(data):
    a = [np.array([r[k] for r in data], float) for k in range(9)]
    amount, count, average = a[1], a[2], a[3]
    ratio = np.where(average > 0, amount / np.where(average > 0, average, 1), 0)
    numeric = np.column_stack([np.log1p(amount), np.log1p(count), np.log1p(average), np.log1p(np.clip(ratio, 0, 1e9)), a[4], a[5], a[6],
                               np.sin(2 * np.pi * a[7] / 24), np.cos(2 * np.pi * a[7] / 24),
                               np.sin(2 * np.pi * (a[8] - 1) / 7), np.cos(2 * np.pi * (a[8] - 1) / 7)])
    train = np.array([r[13] == "train" for r in data])
    mean = numeric[train].mean(axis=0)
    scale = np.sqrt(np.maximum((numeric[train] ** 2).mean(axis=0) - mean**2, 1e-12))
    z, at, slots = (numeric - mean) / scale, len(C.NUMERIC_FEATURES), []
    for k in (9, 10, 11):
        values = sorted({r[k] or "UNKNOWN" for r, t in zip(data, train) if t})
        code = {v: i for i, v in enumerate(values)}
        slots.append([at + code.get(r[k] or "UNKNOWN", len(values)) for r in data])
        at += len(values) + 1
    return z, np.array(slots).T, train, at


def numpy_train(data, cfg):
    z, slots, train, width = numpy_design(data)
    y = np.array([r[12] for r in data], float)
    n, p = train.sum(), y[train].sum()
    balance = np.where(y == 1, n / (2 * p), n / (2 * (n - p)))
    w, squares, b, b_square = np.zeros(width), np.full(width, cfg.accumulator_init), 0.0, cfg.accumulator_init
    for _ in range(cfg.epochs):
        for a in range(0, len(data), cfg.chunk_rows):
            at = np.flatnonzero(train[a:a + cfg.chunk_rows]) + a
            if not len(at):
                continue
            x = np.zeros((len(at), width))
            x[:, :11] = z[at]
            x[np.arange(len(at))[:, None], slots[at]] = 1
            error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y[at]) * balance[at]
            g = x.T @ error / len(at) + cfg.l2 * w
            squares += g**2
            w -= cfg.learning_rate * g / np.sqrt(squares)
            b_square += error.mean() ** 2
            b -= cfg.learning_rate * error.mean() / math.sqrt(b_square)
    return w, b


@pytest.mark.parametrize("chunk_rows", [130, 1000, 200_000])
def test_weights_equal_numpy(spark, chunk_rows):
    data = rows(1000, 60)
    cfg = C.TrainConfig(chunk_rows=chunk_rows)
    f = spark.createDataFrame(data, SCHEMA).repartition(5)
    model = LogisticModel.fit(f, F.col("data_split") == "train", cfg)
    w, b = numpy_train(data, cfg)
    got = [r["weight"] for r in model.coefficients(spark).orderBy("position").collect()]
    assert len(got) == len(w) and np.abs(np.array(got) - w).max() < 1e-9 and abs(model.bias - b) < 1e-9
    check_model_shape(model)
    z, slots, _, _ = numpy_design(data)
    want = 1 / (1 + np.exp(-np.clip(z @ w[:11] + w[slots].sum(axis=1) + b, -30, 30)))
    scores = {r["transaction_id"]: r["review_score"] for r in model.score(f).collect()}
    assert all(abs(scores[r[0]] - s) < 1e-9 for r, s in zip(data, want))


def test_design_with_fifty_thousand_categories(spark):
    """No bound on the vocabulary: it is joined, never written as literals."""
    data = [(*r[:11], f"format {i % 50_000}", *r[12:]) for i, r in enumerate(rows(2000, 1) * 50)]
    data = [(i, *r[1:13], "train" if i < 60_000 else "test") for i, r in enumerate(data)]
    f = spark.createDataFrame(data, SCHEMA)
    train = f.filter("data_split = 'train'")
    stats, vocab = feat.standardizer(train), feat.vocabulary(train)
    assert feat.category_sizes(vocab) == {"payment_currency": 2, "receiving_currency": 3, "payment_format": 50_000}
    d = feat.design(f, stats, vocab)
    assert d.agg(F.max(F.element_at("slots", 3)), F.count_distinct(F.element_at("slots", 3))).collect()[0][:] == (11 + 3 + 4 + 49_999, 50_000)
    model = LogisticModel.fixed(train)
    assert model.score(f).filter("review_score is null").isEmpty()
    check_model_shape(model)


def test_unseen_and_null_categories(spark):
    data = rows(200, 5)
    f = spark.createDataFrame(data, SCHEMA)
    train = f.filter("data_split = 'train'")
    model = LogisticModel.fixed(train)
    other = f.limit(1).withColumn("payment_currency", F.lit("never seen"))
    names = {s["name"]: s["value"] for s in model.with_terms(other).select(model.contributions().alias("c")).first()["c"]}
    assert names["payment_currency=UNKNOWN"] == 0.0
    assert train.filter("payment_format is null").count() and "UNKNOWN" in {r.value for r in model.categories.collect()}


def test_chunks_and_faults(spark):
    f = spark.createDataFrame(rows(100, 3), SCHEMA)
    assert chunk_bounds(f, 40) == [(None, 117), (117, 237), (237, None)]
    assert chunk_bounds(f, 200_000) == [(None, None)] and chunk_bounds(f.limit(0), 10) == [(None, None)]
    with pytest.raises(ValueError):
        chunk_bounds(f, 0)
    with pytest.raises(ValueError):
        LogisticModel.fit(f.filter("is_laundering = 0"), F.col("data_split") == "train")


def test_model_shape_check(spark):
    model = LogisticModel.fixed(spark.createDataFrame(rows(100, 3), SCHEMA))
    check_model_shape(model)
    cut = model.categories.filter("value <> 'Euro'")
    for bad in (dict(numeric=model.numeric[:-1]), dict(categories=cut), dict(unknown={"payment_format": 0.0}),
                dict(categories=model.categories.withColumn("weight", F.when(F.col("category_index") > 0, F.col("weight"))))):
        with pytest.raises(ValueError):
            check_model_shape(LogisticModel(**{**model.__dict__, **bad}))
