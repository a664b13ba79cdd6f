"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
score into grades: P(grade <= k) = sigmoid(threshold_k - score). Selection uses the tail
probability P(grade >= floor); the expected grade ranks documents.

Grades of ``labels`` (see ``graded``): 0 toxic, 1 poor, 2 good.

The fit uses at most ``max_rows`` labelled documents (a documented bound), chosen by a seeded hash
of the ID, so the same documents give the same model at any partitioning. Scoring reads every
document and whole texts.

Edge cases. Null text counts as empty; a text without words has only the document features.
Repeated label rows of a document count once, with the worst grade; labels with a null ID, null or
contradictory marks, or of unknown documents are left out. Without labelled rows, or with a single
grade, there is nothing to separate: every document gets a null expected grade, tail probability 1
and stays. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

DIMS = 1 << 18
MEMO = 1 << 18
SHIFT = 20  # two slots are kept as one number
GRADES = 3
FEW = 30  # words below which the share of distinct ones says nothing: such texts have the feature "short"


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of labels(doc_id, quality, toxic)."""
    grade = (F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
             .when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 2))
    return (labels.select("doc_id", grade.alias("grade")).dropna()
            .groupBy("doc_id").agg(F.min("grade").alias("grade")))


def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % DIMS


def _shape(word: str) -> str:
    out = []
    for c in word:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def word_slots(word: str) -> int:
    """Features of a word: its bare lower-case form and its letter shape (two slots in one number)."""
    bare = word.strip("".join(c for c in {*word} if not c.isalnum())).lower()
    return _slot("w:" + bare) << SHIFT | _slot("s:" + _shape(word))


def page_slots(words: list[str], distinct: int, lines: list[str]) -> list[int]:
    """Features of a document: repetition, word length and size, in steps."""
    n = len(words)
    if not n:
        return [_slot("p:empty")]
    long = sum(map(len, words)) / n
    again = sum(map(operator.eq, words, words[1:])) / n
    return [_slot(f"p:distinct:{int(10 * distinct / n) if n >= FEW else 'short'}"), _slot(f"p:long:{min(int(long), 20)}"),
            _slot(f"p:again:{int(10 * again)}"), _slot(f"p:size:{int(math.log2(n))}"), _slot(f"p:lines:{int(8 * len({*lines}) / len(lines))}")]


class Words(dict):
    """word -> what ``of`` says of it; emptied when full, which costs time only."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word):
        if len(self) >= MEMO:
            self.clear()
        out = self[word] = self.of(word)
        return out


def text_slots(text: str | None, memo: dict) -> np.ndarray:
    """Distinct feature slots of a text."""
    text = text or ""
    words = text.split()
    own = {*words}
    pairs = np.fromiter(map(memo.__getitem__, own), np.int64, len(own))
    page = np.array(page_slots(words, len(own), text.split("\n")), np.int64)
    return np.unique(np.concatenate([pairs >> SHIFT, pairs & (1 << SHIFT) - 1, page])).astype(np.int32)


def slopes(w: np.ndarray, theta: np.ndarray, row: np.ndarray, idx: np.ndarray, grades: np.ndarray, n_grades: int,
           l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the penalised mean loss by the weights and by ``theta`` (first cut, then log gaps).

    Document ``row[i]`` has the feature ``idx[i]``.
    """
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    score = np.bincount(row, w[idx], len(grades))
    cut = theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))])
    edge = np.concatenate([[-np.inf], cut, [np.inf]])
    hi, lo = sig(edge[grades + 1] - score), sig(edge[grades] - score)
    p = np.maximum(hi - lo, 1e-12)
    fh, fl = hi * (1 - hi) / p, lo * (1 - lo) / p  # d log p / d edges
    gs = (fh - fl) / len(grades)  # d loss / d score
    gcut = np.array([(np.where(grades == k + 1, fl, 0) - np.where(grades == k, fh, 0)).mean() for k in range(n_grades - 1)])
    gtheta = np.concatenate([[gcut.sum()], [np.exp(theta[j]) * gcut[j:].sum() for j in range(1, len(theta))]])
    return np.bincount(idx, gs[row], len(w)) + l2 * w, gtheta


class OrdinalModel:
    """score = sum of the weights of a text's features; thresholds ascend."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.., one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))

    @staticmethod
    def fit(slots: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, steps: int = 200,
            rate: float = 0.1, l2: float = 3e-4, least_docs: int = 8) -> OrdinalModel:
        """Full-batch Adam on the penalised likelihood, over features of ``least_docs`` documents or more."""
        row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
        flat = np.concatenate(slots)
        known = np.bincount(flat, minlength=DIMS) >= least_docs
        row, flat = row[known[flat]], flat[known[flat]]
        used, idx = np.unique(flat, return_inverse=True)
        share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / len(grades), 1e-3, 1 - 1e-3)
        cuts = np.log(share / (1 - share))
        theta = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])  # first cut, then log gaps
        w = np.zeros(len(used))
        m = [np.zeros_like(w), np.zeros_like(theta)]
        v = [np.zeros_like(w), np.zeros_like(theta)]
        for t in range(1, steps + 1):
            gw, gtheta = slopes(w, theta, row, idx, grades, n_grades, l2)
            for x, g, a, b in ((w, gw, m[0], v[0]), (theta, gtheta, m[1], v[1])):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                x -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8) * (1 - t / (steps + 1))
        full = np.zeros(DIMS, np.float32)
        full[used] = w
        return OrdinalModel(full, theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))]))


def sample_slots(documents: DataFrame, grades: DataFrame, max_rows: int, seed: int) -> tuple[list, np.ndarray]:
    """Features and grades of at most ``max_rows`` labelled documents; of rows that share an ID, the one whose
    text has the smallest hash, so that no ID counts twice or brings more rows to the driver."""
    some = grades.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_rows)
    rows = (documents.select("doc_id", common.text_or_empty().alias("text"))
            .join(F.broadcast(some.select("doc_id", "grade")), "doc_id"))  # at most max_rows pairs of numbers
    one = F.min(F.struct(F.xxhash64("text", F.lit(seed)).alias("h"), "text", "grade")).alias("one")
    rows = rows.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.grade")

    def run(batches):
        memo = Words(word_slots)
        for b in common.small_slices(batches, "text"):
            got = [text_slots(x, memo).tolist() for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("grade"), pa.array(got, pa.list_(pa.int32()))],
                                             names=["doc_id", "grade", "slots"])

    got = rows.mapInArrow(run, "doc_id long, grade int, slots array<int>").toPandas()
    got = got.assign(first=got["slots"].map(lambda s: tuple(s[:8]))).sort_values(["doc_id", "first"])
    return [np.asarray(s, np.int64) for s in got["slots"]], got["grade"].to_numpy(np.int64)


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 8000, seed: int = 17) -> OrdinalModel | None:
    """Model from a bounded labelled sample; None where it has fewer than two grades."""
    slots, grades = sample_slots(documents, graded(labels), max_rows, seed)
    return OrdinalModel.fit(slots, grades) if len({*grades.tolist()}) > 1 else None


def _scored(documents: DataFrame, model: OrdinalModel):
    """Function from a batch of texts to (expected grade, tail probability of the top grade); the weights
    (1 MB) are broadcast once, and a worker keeps its word table from task to task."""
    common.ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def score(texts) -> tuple[np.ndarray, np.ndarray]:
        weights, cuts = shared.value
        tag = zlib.crc32(weights.tobytes())
        memo = common.kept(f"quality:{tag}", lambda: Words(word_slots))
        sums = np.array([weights[text_slots(x.as_py(), memo)].sum(dtype=np.float64) for x in texts])
        tails = OrdinalModel(weights, cuts).tails(sums)
        return tails.sum(axis=1), tails[:, -1]

    return score


def classify(documents: DataFrame, model: OrdinalModel | None, floor: float = 0.5) -> DataFrame:
    """Per document: doc_id, expected_grade, p_good, selected (p_good >= floor)."""
    if model is None:
        return documents.select("doc_id", F.lit(None).cast("double").alias("expected_grade"), F.lit(1.0).alias("p_good"),
                                F.lit(True).alias("selected"))
    score = _scored(documents, model)

    def run(batches):
        for b in common.small_slices(batches, "text"):
            grade, good = score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(grade), pa.array(good), pa.array(good >= floor)],
                                             names=["doc_id", "expected_grade", "p_good", "selected"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, expected_grade double, p_good double, selected boolean")


def select(documents: DataFrame, model: OrdinalModel | None, floor: float = 0.5) -> DataFrame:
    """The documents whose tail probability reaches ``floor``, with their own columns only."""
    if model is None:
        return documents
    score = _scored(documents, model)

    def run(batches):
        for b in common.small_slices(batches, "text"):
            yield b.filter(pa.array(score(b.column("text"))[1] >= floor))

    return documents.mapInArrow(run, documents.schema)
