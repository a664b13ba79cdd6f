"""File discovery, fingerprints and line scans of transaction CSV files.

Line numbers are exact per file without pulling a file into one task: each input
split counts its lines once (a small per-split table), split offsets are summed
per file, and every line gets offset + position inside its split.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import written

BOM = "﻿"


def discover(spark: SparkSession, directory: str, pattern: str = "*Trans.csv") -> list[str]:
    """A3: files matching a glob in a directory, sorted by path, empty ones too (listing only, no content read)."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return sorted(map(_as_read, listing.inputFiles()))


def _as_read(uri: str) -> str:
    """A listed URI as readers give the path of a row."""
    return re.sub("^file:/+", "file:/", unquote(uri))


CELL_LIMIT = 64 << 20  # files up to this size are digested in one cell, larger ones as a stream


def fingerprint(spark: SparkSession, paths: list[str], cell_limit: int = CELL_LIMIT) -> DataFrame:
    """A4: SHA-256 and byte size per file, one file per row; content stays on executors.

    The sizes come from the listing. A file above ``cell_limit`` is digested as a stream (``streamed_digest``).
    """
    schema = "path string, sha256 string, byte_size long"
    if not paths:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load(paths)
    sizes = {r["path"]: r["length"] for r in files.select("path", "length").collect()}  # listing only: a number per file
    out = files.filter(F.col("length") <= cell_limit).select(
        "path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"))
    large = [p for p, n in sizes.items() if n > cell_limit]
    empty = [(p, hashlib.sha256().hexdigest(), 0) for p in map(_as_read, files.inputFiles()) if p not in sizes]  # no reader returns them
    for p in large:  # beside the scan of the small files a task each; a union of single partitions alone would be one task
        out = out.unionByName(streamed_digest(spark, p))
    return out.unionByName(spark.createDataFrame(empty, schema)) if empty else out


def streamed_digest(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and byte size of a file in constant memory, in one task, over any file system Spark reads.

    The splits are read one after the other, and the pieces between line feeds are fed to an incremental digest
    as they come: nothing is shuffled, sorted or held. Splits that come in another order than their places are
    refused. The reader drops a byte order mark at the start and a line feed at the end, so two digests run, with
    and without the mark, and the file's size tells which bytes were there.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("byte_size"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))

    def run(batches):
        path = size = None
        plain, marked = hashlib.sha256(), hashlib.sha256(codecs.BOM_UTF8)
        total = last = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if path is None:
                path, size = batch.column("path")[0].as_py(), batch.column("byte_size")[0].as_py()
            blocks = np.append(last, batch.column("block").to_numpy())
            if (blocks[1:] < blocks[:-1]).any():
                raise ValueError(f"{path}: splits read out of order")
            last = blocks[-1]
            some = (b"\n" if total else b"") + b"\n".join(batch.column("piece").to_pylist())
            plain.update(some)
            marked.update(some)
            total += len(some) + (not total)  # a line feed per piece, the last one's too
        if path is None:
            return
        for digest, extra in ((plain, 0), (marked, 3)):
            if total + extra == size:
                digest.update(b"\n")
            if total + extra - size in (0, 1):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()]), pa.array([size], pa.int64())],
                                                 names=["path", "sha256", "byte_size"])
                return
        raise ValueError(f"{path}: {size} bytes listed, lines of {total} bytes read")

    return raw.coalesce(1).mapInArrow(run, "path string, sha256 string, byte_size long")


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A1: every physical line of every file with its 1-based line number and raw text
    (line terminators removed, a leading UTF-8 BOM dropped from line 1). The files are read once: the lines are
    written to the shared folder with their places, and numbered from there."""
    if not paths:
        return spark.createDataFrame([], "path string, line_number long, raw_text string")
    raw = written(spark.read.text(paths)
                  .select(F.col("_metadata.file_path").alias("path"),
                          F.col("_metadata.file_block_start").alias("block_start"),
                          F.monotonically_increasing_id().alias("_mono"), F.col("value").alias("raw_text")), "lines")
    splits = raw.groupBy("path", "block_start").agg(F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "block_start", "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    j = raw.join(offsets, ["path", "block_start"])
    line_no = F.col("_offset") + (F.col("_mono") - F.col("_first")) + 1
    text = F.when(line_no == 1, F.regexp_replace("raw_text", f"^{BOM}", "")).otherwise(F.col("raw_text"))
    return j.select("path", line_no.alias("line_number"), text.alias("raw_text"))


def first_line(spark: SparkSession, path: str) -> DataFrame:
    """Line 1 of a file: (path, raw_text), no row for an empty file. Stops after the first row of the first block."""
    return (spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0).limit(1)
            .select(F.lit(path).alias("path"), F.regexp_replace("value", f"^{BOM}", "").alias("raw_text")))


def header_status(first: DataFrame, expected: tuple[str, ...] = C.HEADERS) -> DataFrame:
    """A2: per file, null when its first line is exactly the header, else what was expected and found."""
    from ..functions.contract import is_strict_csv, split_fields
    line = F.col("raw_text")
    want = F.array(*[F.lit(h) for h in expected])
    found = F.when(is_strict_csv(line), split_fields(line))
    text = F.concat(F.lit("header_mismatch: expected "), F.to_json(want), F.lit("; got "), F.coalesce(F.to_json(found), line))
    return first.select("path", F.when(found == want, F.lit(None).cast("string")).otherwise(text).alias("error"))


MODEL_SCHEMA = T.StructType([
    T.StructField("transaction_time", T.TimestampNTZType()),
    T.StructField("from_bank", T.StringType()), T.StructField("from_account", T.StringType()),
    T.StructField("to_bank", T.StringType()), T.StructField("to_account", T.StringType()),
    T.StructField("amount_received", T.DecimalType(38, 12)), T.StructField("receiving_currency", T.StringType()),
    T.StructField("amount_paid", T.DecimalType(38, 12)), T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()), T.StructField("is_laundering", T.ShortType()),
])


def plan_loads(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """A5: what to do with each file found (path, sha256): skip a content that is completed, load a failed or unfinished one
    again under its file_id, load a new one; of several files with one content the first path is loaded.

    ``manifest``: the latest row per file (file_id, sha256, status). New files have a null file_id.
    """
    known = manifest.groupBy("sha256").agg(F.min(F.struct((F.col("status") != "completed").alias("open"), "file_id")).alias("_m"))
    first = found.groupBy("sha256").agg(F.min("path").alias("_first"))
    j = found.join(first, "sha256").join(known, "sha256", "left")
    action = (F.when(F.col("_m").isNotNull() & ~F.col("_m.open"), "skip").when(F.col("path") != F.col("_first"), "same content")
              .when(F.col("_m").isNotNull(), "load again").otherwise("load"))
    return j.select("path", "sha256", action.alias("action"), F.col("_m.file_id").alias("file_id"))


def load_transactions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Positional modelling CSV load with a fixed schema and source-order IDs: (rows, refused rows).

    Amounts are read as text and tested first (F26): a row with an amount that decimal(38,12) cannot hold exactly is
    refused with its texts, never rounded; IDs count all rows. Timestamps as the contract takes them.
    """
    from ..functions.contract import capacity_ok, parse_timestamp
    from ..operators.scale import assign_ids
    amounts = ("amount_received", "amount_paid")
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name in (*amounts, "transaction_time") else f.dataType) for f in MODEL_SCHEMA.fields])
    df = (spark.read.schema(text).option("header", True).option("mode", "FAILFAST").csv(path)
          .withColumn("_file", F.col("_metadata.file_path")).withColumn("_pos", F.monotonically_increasing_id()))
    rows = assign_ids(df, ["_file", "_pos"], "transaction_id").drop("_file", "_pos")
    rows = rows.withColumn("transaction_time", parse_timestamp(F.col("transaction_time"))[1])
    fits = capacity_ok(F.col(amounts[0])) & capacity_ok(F.col(amounts[1]))
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in amounts else F.col(f.name) for f in MODEL_SCHEMA.fields]
    refused = rows.filter(~fits).withColumnsRenamed({a: f"{a}_text" for a in amounts})
    return rows.filter(fits).select("transaction_id", *typed), refused


def generate(spark: SparkSession, n: int, per_day: int = 10_000, accounts: int = 1_000,
             start: str = "2022-09-01") -> DataFrame:
    """Synthetic load rows: n rows, per_day per day, amount (i % 1000) + 1, cycling accounts."""
    i = F.col("id")
    ts = F.timestamp_add("SECOND", (i % per_day) * (86400 // per_day),
                         F.date_add(F.lit(start).cast("date"), (i / per_day).cast("int")).cast("timestamp_ntz"))
    amount = ((i % 1000) + 1).cast("decimal(24,6)")
    return spark.range(n).select(
        ts.alias("event_time"), F.lit("001").alias("from_bank"),
        F.format_string("A%04d", (i % accounts).cast("int")).alias("from_account"),
        F.lit("002").alias("to_bank"), F.format_string("B%04d", ((i + 1) % accounts).cast("int")).alias("to_account"),
        amount.alias("amount_received"), F.lit("US Dollar").alias("receiving_currency"),
        amount.alias("amount_paid"), F.lit("US Dollar").alias("payment_currency"),
        F.lit("ACH").alias("payment_format"), F.lit(0).alias("is_laundering"))


def to_csv_lines(df: DataFrame) -> DataFrame:
    """Render transaction rows as contract CSV text lines (inverse of the parser)."""
    amt = lambda c: F.regexp_replace(F.regexp_replace(F.col(c).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return df.select(F.concat_ws(",", F.date_format("event_time", "yyyy/MM/dd HH:mm"), "from_bank", "from_account",
                                 "to_bank", "to_account", amt("amount_received"), "receiving_currency",
                                 amt("amount_paid"), "payment_currency", "payment_format",
                                 F.col("is_laundering").cast("string")).alias("raw_text"))
