"""Index of accepted payload hashes, for duplicates across files (A10).

The index holds one narrow row per accepted record, in folders by the first hex digits of the hash. A load
reads only the folders of the prefixes that its own hashes have, and of those rows only what passes a
Bloom filter of its hashes: a fixed number of 64-bit words, so the broadcast side has a known size whatever the file.
What passes meets the incoming hashes in an exact join, so the filter changes the work, not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "record_hash string, file_id long, prefix string"
PREFIX_DIGITS = 1  # 16 folders; more digits for a longer history
FILTER_WORDS = 1 << 17  # 8 million bits, 2 MB with their numbers


def prefix(record_hash: str | Column = "record_hash") -> Column:
    return F.substring(record_hash, 1, PREFIX_DIGITS)


def index_rows(raw: DataFrame) -> DataFrame:
    """(record_hash, file_id, prefix) of the accepted rows of ``raw``, dealt so that a load writes few files a folder."""
    rows = raw.filter("validation_status = 'accepted'").select("record_hash", "file_id", prefix().alias("prefix"))
    return rows.repartition("prefix", F.substring("record_hash", 1, PREFIX_DIGITS + 1)).sortWithinPartitions("prefix", "record_hash")


def touched(incoming: DataFrame) -> list[str]:
    """Prefixes of the incoming hashes, 16^PREFIX_DIGITS at most."""
    return sorted(r[0] for r in incoming.select(prefix().alias("p")).distinct().collect())


def _bit() -> tuple[Column, Column]:
    """(word, mask) of a record_hash in the filter."""
    at = f"pmod(xxhash64(record_hash), {FILTER_WORDS * 64})"
    return F.expr(f"cast(floor({at} / 64) as int)"), F.expr(f"shiftleft(1L, cast({at} % 64 as int))")


def bloom(incoming: DataFrame) -> DataFrame:
    """The filter as (word, bits): one row per word that has a bit, FILTER_WORDS at most."""
    word, mask = _bit()
    return incoming.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))


def seen(index: DataFrame, incoming: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """The distinct hashes of ``incoming`` (record_hash) that ``index`` holds."""
    hashes = incoming.select("record_hash").distinct()
    word, mask = _bit()
    some = index.filter(F.col("prefix").isin(touched(hashes) if prefixes is None else prefixes))
    maybe = (some.withColumn("_word", word).join(F.broadcast(bloom(hashes)), "_word")
             .filter(F.col("_bits").bitwiseAND(mask) != 0))
    return hashes.join(maybe.select("record_hash"), "record_hash", "left_semi")
