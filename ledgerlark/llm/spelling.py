"""Spelling variant grouping: Bloom-guided neighbourhoods of a counted vocabulary.

Each word generates its edits: every deletion, and every replacement by a larger letter, so that each pair
of words that differ by one code point is met exactly once (an insertion is a deletion of the longer
word). Edits are probed as hashes against broadcast length-sharded blocked Bloom filters; only positives
become words, shuffle, and meet the vocabulary in an exact join that removes false positives. Filters are broadcast
in rounds of at most ``max_bytes``, whatever the size of the vocabulary.

A word's form is its near word of largest count (ties: smallest in code-point order) where that count is at
least ``ratio`` times its own; counts at least double from word to form, so forms lead to a root in few
steps, found by pointer jumping.

Edge cases. Null or empty texts have no words. A document with a null ID has no letter deleted. Repeated
rows count each. Words of any length are taken: an edit of a very long word costs one hash. An empty
vocabulary gives no rows; a null word or count in a vocabulary is left out, and rows of one word are
added up. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from .common import ship, small_slices, written

FILTER_BYTES = 64 << 20  # of a round: what is broadcast at a time
FLUSH = 1 << 18  # words a task counts before it hands them on
CELLS = 1 << 18  # code points of a matrix of words
WORDS_PER_TASK = 50_000


def count_words(documents: DataFrame, least_length: int = 5, least_count: int = 3, modulus: int | None = 97) -> DataFrame:
    """(word, n) of ``documents`` (doc_id, text): maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.

    Let h be crc32 of "<doc_id>:<run>"; where ``modulus`` divides it, code point h % length is left out of the
    run. Words have ``least_length`` code points and ``least_count`` occurrences or more.
    """
    ship(documents.sparkSession)

    def run(batches):
        rx = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")  # shorter runs cannot grow
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                              names=["word", "n"])

        for b in small_slices(batches, "text"):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                runs = Counter(rx.findall((text or "").encode().lower().decode()))  # bytes.lower() is A-Z only
                if modulus and doc_id is not None:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for word, n in runs.items():
                        h = zlib.crc32(word.encode(), start)
                        if h % modulus == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        counts[word] += n
                else:
                    counts.update(runs)
                if len(counts) >= FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    found = documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return (found.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_count))


def _by_length(batch: pa.RecordBatch):
    """(length, places, words) of a batch, in matrices of bounded size."""
    words = batch.column("word").to_pylist()
    size = np.array([len(w) for w in words])
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        step = max(1, CELLS // max(1, int(length)))
        for a in range(0, len(at), step):
            part = at[a:a + step]
            yield int(length), part, [words[i] for i in part]


def build(vocabulary: DataFrame, r: bloom.Round) -> np.ndarray:
    """The filters of a round: bits are OR-ed per block before and after the shuffle; at most a round's bytes
    come to the driver."""
    names = [f"lane{j}" for j in range(bloom.LANES)]

    def run(batches):
        for b in batches:
            for length, _, words in _by_length(b):
                key = bloom.keys(bloom.letters_of(words))
                block = r.place(length, key)
                mine = block >= 0
                bits = bloom.lanes(key[mine]).view(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(block[mine]), *(pa.array(bits[:, j].copy()) for j in range(bloom.LANES))],
                                                 names=["block", *names])

    words = vocabulary.filter(F.col("size").isin(sorted(r.parts))).select("word")
    bits = words.mapInArrow(run, "block long, " + ", ".join(f"{x} int" for x in names))
    got = bits.groupBy("block").agg(*(F.bit_or(x).alias(x) for x in names)).toArrow()
    out = np.zeros((r.total, bloom.LANES), np.uint32)
    if got.num_rows:
        out[got["block"].to_numpy()] = np.stack([got[x].to_numpy().view(np.uint32) for x in names], axis=1)
    return out


def positives(vocabulary: DataFrame, r: bloom.Round, filters: np.ndarray, alphabet: list[int], tasks: int) -> DataFrame:
    """(word, n, other): edits that the filters of a round may hold."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(filters)

    def edits(length, words):
        """(place of the word, other)"""
        m = bloom.letters_of(words)
        if length - 1 in r.parts:
            key, first = bloom.deletions(m)
            block = np.where(first, r.place(length - 1, key), -1)
            for i in bloom.probe(shared.value, block.ravel(), key.ravel()).tolist():
                row, at = divmod(i, length)
                yield row, words[row][:at] + words[row][at + 1:]
        if length in r.parts:
            for letter in alphabet:
                key, smaller = bloom.replacements(m, letter)
                block = np.where(smaller, r.place(length, key), -1)
                for i in bloom.probe(shared.value, block.ravel(), key.ravel()).tolist():
                    row, at = divmod(i, length)
                    yield row, words[row][:at] + chr(letter) + words[row][at + 1:]

    def run(batches):
        for b in batches:
            for length, places, words in _by_length(b):
                rows, others = [], []
                for row, other in edits(length, words):
                    rows.append(places[row])
                    others.append(other)
                some = b.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([some.column("word"), some.column("n"), pa.array(others, pa.string())],
                                                 names=["word", "n", "other"])

    reach = sorted({*r.parts} | {x + 1 for x in r.parts})
    words = vocabulary.filter(F.col("size").isin(reach)).select("word", "n").repartition(tasks)
    return words.mapInArrow(run, "word string, n long, other string")


def near_words(vocabulary: DataFrame, max_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, other, m): each pair of near words of ``vocabulary`` (word, n, size), once."""
    counts = {r.size: r["count"] for r in vocabulary.groupBy("size").count().collect()}  # one row per word length
    alphabet = sorted(ord(r.c) for r in vocabulary.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct().collect())
    tasks = max(1, math.ceil(sum(counts.values()) / WORDS_PER_TASK))
    found = None
    for r in bloom.plan(counts, max_bytes):
        some = positives(vocabulary, r, build(vocabulary, r), alphabet, tasks)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return vocabulary.selectExpr("word", "n", "word as other", "n as m").limit(0)
    return found.join(vocabulary.selectExpr("word as other", "n as m"), "other").select("word", "n", "other", "m")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form) without cycles: every step skips as far as the last one reached."""
    at = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")


def group(counted: DataFrame, ratio: int = 2, max_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word of ``counted`` (word, n): word, form, root, n, n_near, form_n."""
    spark: SparkSession = counted.sparkSession
    ship(spark)
    once = counted.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = written(once.withColumn("size", F.char_length("word")), "vocabulary")
    link = F.explode(F.array(F.struct("word", "other", "m"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("m"))))
    links = near_words(vocabulary, max_bytes).select(link.alias("l")).select("l.*")
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    out = written(vocabulary.join(best, "word", "left")
                  .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                          F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")), "words")
    root = roots(out.filter("form is not null"))
    return out.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
