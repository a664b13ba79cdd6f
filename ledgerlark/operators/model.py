"""Class-weighted logistic regression: training, scoring, coefficients.

A model is eleven means, scales and weights, a bias, and a table of category weights that is joined on
(column, value), so a vocabulary may have any size. Training (F10) takes ordered chunks of IDs, a few passes
over all of them: one distributed gradient per chunk, then one AdaGrad step on the driver, which holds the weight
vector and its accumulators only. Objective: class-balanced mean log loss + l2/2 * |w|^2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import written
from . import features as feat
from .scale import assign_ids

# --- Fixed demonstration weights (used for the SQL-checkable scoring query) --------
FIXED_NUMERIC_WEIGHTS = (0.8, -0.3, -0.5, 1.2, 0.1, 0.4, -0.2, 0.05, -0.05, 0.02, -0.02)
FIXED_BIAS = -3.0
FIXED_CATEGORY_STEP = 0.05
# ---------------------------------------------------------------------------------
_BIAS, _ROWS = -1, -2  # slots of the sums that are no weights


@dataclass
class LogisticModel:
    means: list[float]
    scales: list[float]
    numeric: list[float]
    categories: DataFrame  # column_name, value, category_index, weight
    unknown: dict[str, float]  # weight of an unseen value, per categorical column in design order
    bias: float
    version: str = C.MODEL_VERSION

    # --- construction ---------------------------------------------------------
    @staticmethod
    def stats_of(train: DataFrame) -> tuple[list[float], list[float]]:
        row = feat.standardizer(train).collect()[0]
        return ([row[f"{n}__mean"] for n in C.NUMERIC_FEATURES],
                [row[f"{n}__scale"] for n in C.NUMERIC_FEATURES])

    @classmethod
    def fixed(cls, train: DataFrame) -> "LogisticModel":
        """Deterministic weights by rule (category slot i of column j: +-step*(i+1))."""
        means, scales = cls.stats_of(train)
        sign = F.when(F.col("column_name").isin(list(C.CATEGORICAL_FEATURES[1::2])), F.lit(-1.0)).otherwise(F.lit(1.0))
        weight = sign * F.lit(FIXED_CATEGORY_STEP) * (F.col("category_index") + 1)
        return cls(means, scales, list(FIXED_NUMERIC_WEIGHTS), feat.vocabulary(train).withColumn("weight", weight),
                   dict.fromkeys(C.CATEGORICAL_FEATURES, 0.0), FIXED_BIAS, "fixed_rule_v1")

    @classmethod
    def fit(cls, f: DataFrame, is_train: Column, cfg: C.TrainConfig = C.TrainConfig(),
            label: str = "is_laundering") -> "LogisticModel":
        """AdaGrad over chunks of ``cfg.chunk_rows`` consecutive rows of ``f`` by transaction_id, train rows only.

        Each step moves the gradient of one chunk: a partial sum per task and slot, then per slot. The design
        is written once, sorted by ID, and a step reads its ID range. The driver holds three numbers per slot.
        """
        spark = f.sparkSession
        train = f.filter(is_train)
        stats = feat.standardizer(train)
        vocab = feat.vocabulary(train)
        sizes = feat.category_sizes(vocab)
        counts = feat.class_weights(train, label).collect()[0]
        if not counts["positives"] or counts["positives"] == counts["n"]:
            raise ValueError("training data needs both classes")
        balance = (counts["negative_weight"], counts["positive_weight"])
        bounds = chunk_bounds(f, cfg.chunk_rows)
        rows = feat.design(train, stats, vocab, sizes).select("transaction_id", "z", "slots", F.col(label).cast("double").alias("y"))
        rows = written(rows.repartitionByRange("transaction_id").sortWithinPartitions("transaction_id"), "design")

        width = len(C.NUMERIC_FEATURES) + sum(n + 1 for n in sizes.values())
        w, squares = np.zeros(width), np.full(width, cfg.accumulator_init)
        bias, bias_square = 0.0, cfg.accumulator_init
        for _ in range(cfg.epochs):
            for low, high in bounds:
                part = rows if low is None else rows.filter(F.col("transaction_id") > low)
                part = part if high is None else part.filter(F.col("transaction_id") <= high)
                gradient, bias_sum, n = chunk_gradient(part, w, bias, balance)
                if not n:
                    continue
                step = gradient / n + cfg.l2 * w
                squares += step * step
                w -= cfg.learning_rate * step / np.sqrt(squares)
                bias_square += (bias_sum / n) ** 2
                bias -= cfg.learning_rate * (bias_sum / n) / math.sqrt(bias_square)
        offsets = feat.category_offsets(sizes)
        weights = spark.createDataFrame(pa.table({"_slot": np.arange(width), "weight": w}))
        categories = vocab.withColumn("_slot", _slot_of(offsets)).join(weights, "_slot").drop("_slot")
        means, scales = zip(*[(r[f"{n}__mean"], r[f"{n}__scale"]) for r in stats.collect() for n in C.NUMERIC_FEATURES])
        return cls(list(means), list(scales), w[:len(C.NUMERIC_FEATURES)].tolist(), categories,
                   {c: float(w[o + sizes[c]]) for c, o in offsets.items()}, float(bias), C.MODEL_VERSION)

    # --- application ------------------------------------------------------------
    def with_terms(self, f: DataFrame) -> DataFrame:
        """``f`` with the weight of each row's categories, joined from the category table."""
        return feat.join_categories(f, self.categories, list(self.unknown), ["weight"])

    def _numeric_terms(self) -> list[tuple[str, Column]]:
        z = feat.standardized(means=self.means, scales=self.scales)
        return [(n, x * F.lit(w)) for n, x, w in zip(C.NUMERIC_FEATURES, z, self.numeric)]

    def _category_weight(self, c: str) -> Column:
        return F.coalesce(F.col(f"_ll_weight_{c}"), F.lit(float(self.unknown[c])))

    def logit(self) -> Column:
        """Over a frame that ``with_terms`` gave."""
        total = F.lit(self.bias)
        for _, term in self._numeric_terms():
            total = total + term
        for c in self.unknown:
            total = total + self._category_weight(c)
        return total

    def score(self, f: DataFrame, split: Column | None = None) -> DataFrame:
        """review_score = sigmoid(clip(logit, -30, 30)), with split and model version."""
        z = F.least(F.greatest(self.logit(), F.lit(-30.0)), F.lit(30.0))
        s = self.with_terms(f).select(*f.columns, (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("review_score"))
        if split is not None:
            s = s.withColumn("data_split", split)
        return s.withColumn("model_version", F.lit(self.version))

    def contributions(self) -> Column:
        """array<struct<name, value>> of every non-zero term (zero one-hots are absent), after ``with_terms``."""
        items = [F.struct(F.lit(n).alias("name"), term.alias("value")) for n, term in self._numeric_terms()]
        for c in self.unknown:
            seen = F.when(F.col(f"_ll_weight_{c}").isNotNull(), feat.category(c)).otherwise(F.lit(C.UNKNOWN_CATEGORY))
            items.append(F.struct(F.concat(F.lit(f"{c}="), seen).alias("name"), self._category_weight(c).alias("value")))
        return F.array(*items)

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """feature name and weight of every slot, in design order."""
        sizes = feat.category_sizes(self.categories, list(self.unknown))
        offsets = feat.category_offsets(sizes)
        fixed = [(i + 1, n, float(w)) for i, (n, w) in enumerate(zip(C.NUMERIC_FEATURES, self.numeric))]
        fixed += [(offsets[c] + sizes[c] + 1, f"{c}={C.UNKNOWN_CATEGORY}", float(w)) for c, w in self.unknown.items()]
        seen = self.categories.select((_slot_of(offsets) + 1).cast("int").alias("position"),
                                      F.concat("column_name", F.lit("="), "value").alias("feature"), "weight")
        return spark.createDataFrame(fixed, "position int, feature string, weight double").unionByName(seen)


def _slot_of(offsets: dict[str, int]) -> Column:
    """Slot of a row of the vocabulary."""
    first = F.coalesce(*[F.when(F.col("column_name") == c, F.lit(o)) for c, o in offsets.items()])
    return (first + F.col("category_index")).cast("long")


def chunk_bounds(f: DataFrame, chunk_rows: int) -> list[tuple[int | None, int | None]]:
    """ID ranges (after, through] of ``chunk_rows`` consecutive rows each; one number per chunk on the driver."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    numbered = assign_ids(f.select("transaction_id"), ["transaction_id"], "_position")
    ends = [r[0] for r in numbered.filter(F.col("_position") % chunk_rows == 0).select("transaction_id").orderBy("transaction_id").collect()]
    return list(zip([None, *ends], [*ends, None]))


def chunk_gradient(rows: DataFrame, w: np.ndarray, bias: float, balance: tuple[float, float]) -> tuple[np.ndarray, float, int]:
    """(gradient sums, bias gradient sum, rows) of the weighted log loss over sparse design ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast((w, bias, balance))
    n_numeric = len(C.NUMERIC_FEATURES)
    marks = (_BIAS, _ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, b, (negative, positive) = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            z = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(n, n_numeric)
            slots = batch.column("slots").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            logit = np.clip(z @ weights[:n_numeric] + weights[slots].sum(axis=1) + b, -30, 30)
            error = (1 / (1 + np.exp(-logit)) - y) * np.where(y == 1, positive, negative)
            used, at = np.unique(slots, return_inverse=True)
            sums = np.bincount(at.ravel(), np.repeat(error, slots.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.arange(n_numeric), used, marks]).astype(np.int64)),
                 pa.array(np.concatenate([error @ z, sums, [error.sum(), n]]))], names=["slot", "total"])

    got = rows.mapInArrow(run, "slot long, total double").groupBy("slot").agg(F.sum("total").alias("total")).toArrow()
    shared.unpersist()
    slot, total = got["slot"].to_numpy(), got["total"].to_numpy()
    gradient = np.zeros(len(w))
    gradient[slot[slot >= 0]] = total[slot >= 0]
    return gradient, float(total[slot == _BIAS].sum()), int(total[slot == _ROWS].sum())


def extreme_coefficients(coefs: DataFrame, n: int = 8) -> DataFrame:
    """the n lowest and n highest weights."""
    low = coefs.orderBy("weight", "feature").limit(n).withColumn("side", F.lit("negative"))
    high = coefs.orderBy(F.desc("weight"), "feature").limit(n).withColumn("side", F.lit("positive"))
    return low.unionByName(high)
