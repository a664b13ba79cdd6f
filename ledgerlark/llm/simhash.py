"""SimHash near-duplicates: meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits share a value within half the radius of both. So every
distinct fingerprint emits all its variants within half the radius, variants are shuffled, and the
fingerprints that meet at a variant are deduplicated and verified. A variant has at most as many
neighbours as its ball has members (65 for radius 2), which bounds every group by geometry, and equal
fingerprints are folded before anything is emitted.

Edge cases. Null and empty texts, and texts of white space, have no words and fingerprint zero,
which links like any other. Fewer words than a shingle: the whole sequence is the one shingle.
Repeated rows and IDs keep their rows; a component is named by its smallest ID (nulls count last; null
only if it has no other). An empty table gives an empty result. Other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
VARIANTS = 1 << 20  # that a task emits


def fingerprint_text(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):  # a very long text never holds more than these bits at once
        z = min(n, a + (1 << 16))
        h = np.fromiter((xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in zip(starts[a:z], ends[a:z])), np.uint64, z - a)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        k = len(bits) // 255 * 255  # sums of up to 255 bits fit a byte
        counts += bits[:k].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[k:].sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * c > n else "0" for c in counts.tolist()), 2)


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint of a text column as a signed long with the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_text(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(text)


def ball(value: Column, radius: int) -> Column:
    """All values within ``radius`` bits of a long column."""
    out, ring = F.array(value), F.array(value)
    for _ in range(radius):
        ring = F.array_distinct(F.flatten(F.transform(ring, lambda x: F.transform(
            F.sequence(F.lit(0), F.lit(63)), lambda i: x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))))
        out = F.array_union(out, ring)
    return out


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that reach the same components as all pairs within ``radius``.

    All that meet at a variant lie within twice the half radius of one another. For an even radius
    that is the radius itself, so linking each to the smallest loses no connection; for an odd one
    the pairs of the (bounded) group are verified one by one.
    """
    half = math.ceil(radius / 2)
    if half == 1:
        flips = [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")) for i in range(64)]
        variants = F.array(F.col("fp"), *flips)
    else:
        variants = ball(F.col("fp"), half)
    # dealt by what comes out: a fingerprint has 65 variants at half radius 1, and AQE would join the few MB that go in
    tasks = max(1, math.ceil(prints.count() * sum(math.comb(64, i) for i in range(half + 1)) / VARIANTS))
    met = (prints.repartition(tasks, "fp").select("fp", F.explode(variants).alias("variant")).groupBy("variant")
           .agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1))
    if radius % 2 == 0:
        pairs = met.select(F.array_min("near").alias("u"), F.explode("near").alias("v"))
    else:
        pairs = met.select(F.explode("near").alias("u"), "near").select("u", F.explode("near").alias("v"))
    return pairs.filter("u < v").distinct().filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Per row: doc_id, fp (long), text_key (hash of the text), component (a fingerprint), component_id.

    The per-document table of numbers is pinned once; links run over distinct fingerprints only.
    """
    text = common.text_or_empty()
    docs = common.pinned(documents.select("doc_id", text.alias("text"))
                         .select("doc_id", F.xxhash64("text").alias("text_key"), fingerprint(F.col("text"), shingle).alias("fp")))
    prints = docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = common.components(links(prints.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    member = prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("component"))
    named = member.groupBy("component").agg(F.min("least").alias("component_id"))
    member = member.select("fp", "component").join(named, "component")
    return docs.join(member, "fp").select("doc_id", "fp", "text_key", "component", "component_id")


def deduplicate(documents: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group, with the documents' own columns: the smallest ID, then the smallest text hash.

    Of rows that share ID and text one stays.
    """
    groups = near_duplicates(documents, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    first = groups.groupBy("component").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_key")
    stay = common.keyed(documents).join(first.select(F.col("doc_id").alias("first"), "text_key"),
                                        F.expr("id <=> first and key = text_key"), "left_semi")
    return stay.dropDuplicates(["id", "key"]).select("row.*")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
