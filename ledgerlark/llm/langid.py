"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased and cut into letter runs between boundary marks; its subwords are the grams of 2 to
4 code points inside a run or at its edges, hashed to buckets. The mean of their embeddings goes through a
linear softmax. Both layers are trained by stochastic gradient descent in numpy, one example at a time, on
whole texts and on a few short windows of them, so that short texts are learned too. A part of the sample
is kept from training: on it a temperature calibrates the probabilities, and a cutoff is chosen from which
the accepted predictions reach a wanted precision (rejection). As the model is linear in the mean, scoring adds
one number per subword and language from a table of embedding times softmax weights.

The fit uses at most ``max_rows`` labelled documents and ``max_langs`` languages, the most frequent first
(documented bounds): as many of each language, chosen by a seeded hash of the ID, so the same documents
give the same model at any partitioning. Scoring reads every document and whole texts, long ones in slices.

Edge cases. A text that is null or has no letter is ``und`` with score 0, and never accepted. Nothing is
learned from rows with a null ID or language. Of rows that share an ID one is learned from: the smallest
language, and the text of the smallest hash; every row is predicted. Without anything to learn from, all
is ``und``; with one language its score is 1. Equal scores go to the smaller language name. Grams that
training did not see add nothing. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 16
DIMS = 16
ORDERS = (2, 3, 4)
SLICE = 1 << 19  # code points at a time
WINDOWS = (1, 2, 4, 8, 16)  # words of the short training windows
UNKNOWN = "und"
_MIX = np.uint32(0x9E3779B1)  # odd, near 2^32 times the golden ratio


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def grams(buffer: str, letter: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(letter marks, a bucket per order) at the first ``n`` places of ``buffer``; BUCKETS where no gram starts."""
    code = np.frombuffer((buffer + "\n" * (n + max(ORDERS) - 1 - len(buffer))).encode("utf-32-le"), "<u4")
    is_letter = letter[code]
    code = np.where(is_letter, code, 0).astype(np.uint32)
    out, inner = [], None
    rolled = code[:n] * _MIX
    for order in range(2, max(ORDERS) + 1):
        last = code[order - 1:n + order - 1]
        rolled = (rolled ^ (rolled >> np.uint32(15))) * _MIX + last
        if order == 2:
            valid = is_letter[:n] | is_letter[1:n + 1]
        else:
            step = is_letter[order - 2:n + order - 2]
            inner = step if inner is None else inner & step
            valid = inner
        if order in ORDERS:
            bucket = ((rolled * _MIX) >> np.uint32(32 - 16)).astype(np.int32)
            out.append(np.where(valid, bucket, BUCKETS))
    return is_letter[:n], out


def pieces(texts: list[str | None], size: int):
    """(numbers of the texts, starts, buffer, places): short texts together, a long one in slices of its own.

    Each text has a boundary before and after it; a buffer has what the grams of its last places reach.
    """
    group, starts, parts, total = [], [], [], 0
    for i, text in enumerate(texts):
        low = "\n" + (text or "").lower()
        if len(low) > size:
            for a in range(0, len(low), size):
                yield [i], [0], low[a:a + size + max(ORDERS) - 1], min(size, len(low) - a)
            continue
        if total + len(low) > size:
            yield group, starts, "".join(parts), total
            group, starts, parts, total = [], [], [], 0
        group.append(i)
        starts.append(total)
        parts.append(low)
        total += len(low)
    if group:
        yield group, starts, "".join(parts), total


def bag(text: str, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, share) of a text's grams."""
    counts = np.zeros(BUCKETS + 1, np.int64)
    for _, _, buffer, n in pieces([text], SLICE):
        for b in grams(buffer, letter, n)[1]:
            counts += np.bincount(b, minlength=BUCKETS + 1)
    at = np.flatnonzero(counts[:BUCKETS])
    return at.astype(np.int32), (counts[at] / max(1, counts[at].sum())).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    langs: list[str]
    embeddings: np.ndarray  # BUCKETS x DIMS; zero where training saw no gram
    weights: np.ndarray  # DIMS x languages
    bias: np.ndarray
    temperature: float = 1.0
    cutoff: float = 0.0

    def logits(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        mean = np.array([w @ self.embeddings[i] if len(i) else np.zeros(DIMS) for i, w in bags]).reshape(len(bags), DIMS)
        return mean @ self.weights + self.bias

    def table(self) -> np.ndarray:
        """What one gram adds to each language's score: languages x (BUCKETS + 1), last column zero."""
        return np.concatenate([(self.embeddings @ self.weights).T, np.zeros((len(self.langs), 1))], axis=1)

    @staticmethod
    def fit(bags: list, of: np.ndarray, langs: list[str], groups: np.ndarray, epochs: int = 4, rate: float = 0.5,
            precision: float = 0.99, seed: int = 11) -> LanguageModel:
        """``of``: language number per bag; ``groups``: document number per bag, every fifth kept for calibration."""
        rnd = np.random.default_rng(seed)
        c = len(langs)
        emb = rnd.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS))
        weights, bias = np.zeros((DIMS, c)), np.zeros(c)
        kept = groups % 5 == 4 if len({*groups.tolist()}) >= 10 else np.zeros(len(bags), bool)
        train = [i for i in np.flatnonzero(~kept) if len(bags[i][0])]
        seen = np.zeros(BUCKETS, bool)
        for i in train:
            seen[bags[i][0]] = True
        emb[~seen] = 0
        total, step = epochs * len(train), 0
        for _ in range(epochs):
            for i in rnd.permutation(train):
                at, share = bags[i]
                lr = rate * (1 - step / total)
                mean = share @ emb[at]
                slope = softmax(mean @ weights + bias)
                slope[of[i]] -= 1
                back = weights @ slope
                weights -= lr * np.outer(mean, slope) / max(1e-3, mean @ mean)  # normalised steps: a mean of
                bias -= 0.1 * lr * slope                                        # many grams is small
                emb[at] -= (lr / float(share @ share)) * np.outer(share, back)
                step += 1
        model = LanguageModel(langs, emb, weights, bias)
        held = [i for i in np.flatnonzero(kept) if len(bags[i][0])]
        if held:
            model.calibrate(model.logits([bags[i] for i in held]), of[held], precision)
        return model

    def calibrate(self, logits: np.ndarray, of: np.ndarray, precision: float) -> None:
        """Temperature of the largest likelihood, then the lowest cutoff whose accepted predictions are that precise."""
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 241))
        p = [softmax(logits / t)[np.arange(len(of)), of] for t in grid]
        self.temperature = float(grid[int(np.argmax([np.log(np.maximum(x, 1e-12)).mean() for x in p]))])
        p = softmax(logits / self.temperature)
        best = p.max(axis=1)
        order = np.argsort(-best, kind="stable")
        good = np.cumsum(p.argmax(axis=1)[order] == of[order]) / np.arange(1, len(of) + 1)
        fine = np.flatnonzero(good >= precision)
        self.cutoff = float(best[order[fine[-1]]]) if len(fine) else 1.0


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether crc32 of the ID as text leaves 2 modulo 4; false for a null ID."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sample(documents: DataFrame, max_rows: int, max_langs: int, seed: int) -> DataFrame:
    """(doc_id, lang, text) of at most ``max_rows`` documents, as many of each language as there are."""
    known = documents.filter("doc_id is not null and lang is not null").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(min(max_langs, max_rows)).collect()}
    each = max_rows // max(1, len(counts))
    place = F.xxhash64("doc_id", F.lit(seed))
    # A hash range that holds about four times the wanted rows of a language, so that no task ranks all of a common one.
    share = F.lit(-1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 4 * each / n))).otherwise(share)
    near = known.filter(F.pmod(place, F.lit(1 << 30)) <= share * float(1 << 30))
    order = Window.partitionBy("lang").orderBy(F.pmod(place, F.lit(1 << 30)), "doc_id")
    some = near.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= each)
    rows = (documents.select("doc_id", common.text_or_empty().alias("text"))
            .join(F.broadcast(some.select("doc_id", "lang")), "doc_id"))  # at most max_rows pairs
    one = F.min(F.struct(F.xxhash64("text", F.lit(seed)).alias("h"), "text")).alias("one")
    return rows.groupBy("doc_id", "lang").agg(one).select("doc_id", "lang", "one.text")


def windows(doc_id: int, text: str) -> list[str]:
    """The text, and short windows of words at places that the ID chooses."""
    words = text.split()
    out = [text]
    for k in WINDOWS:
        if len(words) > k:
            at = zlib.crc32(f"{doc_id}:{k}".encode()) % (len(words) - k + 1)
            out.append(" ".join(words[at:at + k]))
    return out


def fit(documents: DataFrame, max_rows: int = 2000, max_langs: int = 200, seed: int = 11) -> LanguageModel | None:
    """Model learned from ``documents`` (doc_id, text, lang); None where there is no language."""
    common.ship(documents.sparkSession)

    def run(batches):
        letter = common.kept("letters", letters)
        for b in common.small_slices(batches, "text"):
            rows = [(i, lang, *bag(w, letter)) for i, lang, text in zip(*(b.column(x).to_pylist() for x in ("doc_id", "lang", "text")))
                    for w in windows(i, text)]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.list_(pa.int32())), pa.array(cols[3], pa.list_(pa.float32()))],
                                             names=["doc_id", "lang", "at", "share"])

    got = sample(documents, max_rows, max_langs, seed).mapInArrow(run, "doc_id long, lang string, at array<int>, share array<float>").toPandas()
    if not len(got):
        return None
    got = got.assign(size=got["at"].map(len), low=got["at"].map(lambda x: tuple(x[:4]))).sort_values(["doc_id", "size", "low"])
    langs = sorted(set(got["lang"]))
    bags = [(np.asarray(a, np.int32), np.asarray(s, np.float32)) for a, s in zip(got["at"], got["share"])]
    number = {x: i for i, x in enumerate(langs)}
    groups = np.unique(got["doc_id"].to_numpy(), return_inverse=True)[1]
    return LanguageModel.fit(bags, got["lang"].map(number).to_numpy(), langs, groups)


def score_texts(texts: list[str | None], table: np.ndarray, bias: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean score per language, whether there is a letter) per text."""
    c = len(table)
    sums, count, found = np.zeros((len(texts), c)), np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
    for numbers, starts, buffer, n in pieces(texts, max(64, SLICE * 4 // max(4, c))):
        is_letter, buckets = grams(buffer, letter, n)
        for k in range(c):
            sums[numbers, k] += np.add.reduceat(sum(table[k][b] for b in buckets), starts)
        count[numbers] += np.add.reduceat(sum((b < BUCKETS).astype(np.int64) for b in buckets), starts)
        found[numbers] |= np.logical_or.reduceat(is_letter, starts)
    return sums / np.maximum(count, 1)[:, None] + bias, found


def predict(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Per document: doc_id, lang_pred, score (calibrated probability), accepted (score at the cutoff or above)."""
    if model is None:
        return documents.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    common.ship(documents.sparkSession)
    # at most max_langs x BUCKETS doubles
    shared = documents.sparkSession.sparkContext.broadcast((model.table(), model.bias, model.langs, model.temperature, model.cutoff))

    def run(batches):
        table, bias, langs, temperature, cutoff = shared.value
        letter, names = common.kept("letters", letters), np.array([*langs, UNKNOWN], object)
        for b in common.small_slices(batches, "text"):
            z, found = score_texts(b.column("text").to_pylist(), table, bias, letter)
            p = softmax(z / temperature)
            best = np.where(found, p.argmax(axis=1), len(langs))
            score = np.where(found, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score),
                                              pa.array(found & (score >= cutoff))],
                                             names=["doc_id", "lang_pred", "score", "accepted"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")
