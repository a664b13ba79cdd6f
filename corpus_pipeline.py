"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. quality: documents that the ordinal classifier rejects (toxic or poor) go.
2. simhash: of each group of near-duplicates the document with the smallest ID stays.
3. secrets: every span that the secret scan finds is masked; all documents stay.
4. mix: token budgets by domain, language and source choose the documents, each at most once.
5. tokens: byte-level BPE ids of each document, with digests of ids and decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm import bpe, mixing, quality, secrets, simhash
from ledgerlark.llm.common import ship, table, written
from ledgerlark.llm.queries import byte_ranks, pieces_pattern

#: One epoch at most, so that no document comes back after deduplication.
MIX = mixing.Plan(share=0.9, max_epochs=1)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labelled ones among ``docs``; keeps tail probability 0.5 and more."""
    ship(spark)
    return quality.select(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three-word shingles, at most two differing bits."""
    ship(spark)
    return simhash.deduplicate(docs, shingle=3, radius=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.select(docs, MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ship(spark)
    return bpe.digests(bpe.round_trip(docs, byte_ranks(), pieces_pattern()))


STAGES = [("quality", keep_good), ("simhash", one_of_each_group), ("secrets", mask_secrets), ("mix", mix),
          ("tokens", tokens)]

#: SQL can express neither the classifier nor the encoder; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
