"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, covertree, langid, lengths, mixing, negatives, postings, quality, secrets, simhash, spelling,
               suffixes, tokenfiles)
from .common import scratch, ship, table


def tokenizer_path(name: str) -> str:
    """A public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def byte_ranks() -> dict[bytes, int]:
    return bpe.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.remove(table(spark, sf_dir, "documents"), least=50))


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, k=20)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return tokenfiles.checksums(tokenfiles.read(spark, folder))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), byte_ranks(), pieces_pattern())
    return lengths.histogram(ids.select((F.octet_length("ids") / 4).cast("long").alias("n_tokens")))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.chosen(table(spark, sf_dir, "documents"), mixing.Plan()).drop("text_key")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), byte_ranks(), pieces_pattern()))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs.filter(~langid.held_out())))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.mine(rows.select("vec_id", "embedding", moved.alias("label")), F.pmod("vec_id", F.lit(100)) == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.count_words(table(spark, sf_dir, "documents"), least_length=5, least_count=3, modulus=97))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    ship(spark)
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {f.__name__: f for f in (
    op1_secret_scan, op2_repeated_passages, op3_cover_tree, op4_nearest, op5_simhash, op6_token_files, op7_token_counts, op8_mix, op9_byte_bpe, op10_quality,
    op11_language, op12_hard_negatives, op13_spelling, pipeline)}
