"""Operational health as one relation over the event logs (C26, D1, D2), and run verification (D3).

The logs are append-only: files, correction files, promotion runs, publications. One pass folds them to the latest row
per key, a second to one row per pipeline; the status is a column with a fixed precedence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000_000  # ``seq`` counts nanoseconds
FILES, CORRECTIONS, RUNS, PUBLICATIONS = "files", "corrections", "runs", "publications"
_NUMBERS = ("total_rows", "accepted_rows", "rejected_rows", "duplicate_candidates", "last_raw_record_id", "last_correction_id")


def events(by: Sequence[str], **logs: DataFrame) -> DataFrame:
    """One event table of the logs named ``files``, ``corrections``, ``runs`` and ``publications``."""
    keys = {FILES: "file_id", CORRECTIONS: "file_id", RUNS: "run_id", PUBLICATIONS: "publication_id"}
    out = None
    for log, df in logs.items():
        numbers = [F.col(c).cast("long").alias(c) if c in df.columns else F.lit(None).cast("long").alias(c) for c in _NUMBERS]
        newest = F.col("max_event_time") if "max_event_time" in df.columns else F.lit(None).cast("timestamp_ntz")
        moves = F.col("mode") == "incremental" if "mode" in df.columns else F.lit(True)
        part = df.select(*by, F.lit(log).alias("log"), F.col(keys[log]).cast("long").alias("key"), "status", F.col("seq").cast("long").alias("seq"),
                         *numbers, newest.alias("max_event_time"), moves.alias("moves_cursor"))
        out = part if out is None else out.unionByName(part)
    return out


def _latest(log: str, status: str) -> Column:
    return F.max(F.when((F.col("log") == log) & (F.col("status") == status), F.col("seq")))


def health(logs: DataFrame, pending: DataFrame, published: DataFrame, now: int, by: Sequence[str] = ()) -> DataFrame:
    """One row per pipeline (``by`` values of ``pending``, which has one row each).

    ``pending``: pending_source_rows, pending_corrections. ``published``: published_rows, imbalanced_files. ``now``: a seq.
    A file's status is that of its newest event; a run or publication is an event of its own.
    """
    by = list(by)
    file_log = F.col("log").isin(FILES, CORRECTIONS)
    # A file is started and completed or failed under one key; runs and publications are told apart by their seq.
    once = F.when(file_log, F.col("key")).otherwise(F.col("seq"))
    row = F.struct("status", "seq", "key", *_NUMBERS, "max_event_time", "moves_cursor")
    started = F.max(F.when(F.col("status") == "started", F.col("seq")))
    last = (logs.groupBy(*by, "log", once.alias("_once")).agg(F.max_by(row, "seq").alias("_r"), started.alias("started_seq"))
            .select(*by, "log", "_r.*", "started_seq"))
    a_file, a_correction = F.col("log") == FILES, F.col("log") == CORRECTIONS
    total = lambda c: F.coalesce(F.sum(F.when(a_file, F.col(c))), F.lit(0)).alias(c)
    n_of = lambda log, s: F.count_if(log & (F.col("status") == s))
    cursor = (F.col("log") == RUNS) & (F.col("status") == "promoted") & F.col("moves_cursor")
    one = last.groupBy(*by).agg(
        F.count_if(a_file).alias("files"), n_of(a_file, "failed").alias("failed_source_files"),
        n_of(a_correction, "failed").alias("failed_correction_files"),
        (n_of(a_file, "started") + n_of(a_correction, "started")).alias("_loading"),
        *[total(c) for c in _NUMBERS[:4]],
        F.max_by(F.struct("key", "status", "seq", "started_seq"), F.when(a_file, F.struct("started_seq", "key"))).alias("_file"),
        F.max_by(F.struct("last_raw_record_id", "last_correction_id", "max_event_time", "key"), F.when(cursor, F.col("seq"))).alias("_state"),
        _latest(FILES, "completed").alias("_completed"), _latest(RUNS, "promoted").alias("_promoted"),
        _latest(RUNS, "failed").alias("_run_failed"), _latest(PUBLICATIONS, "failed").alias("_publish_failed"),
        _latest(PUBLICATIONS, "published").alias("_published"),
        F.max(F.when((F.col("log") == PUBLICATIONS) & (F.col("status") == "published"), F.col("key"))).alias("publication_id"))
    j = pending.join(one, by, "left").join(published, by, "left") if by else \
        pending.crossJoin(one).crossJoin(published)  # one row each
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    after = lambda failure, success: F.coalesce(F.col(failure), F.lit(-1)) > F.coalesce(success, F.lit(-1))
    status = (F.when(count("failed_source_files") + count("failed_correction_files") > 0, "FAILED FILES")
              .when(count("_loading") > 0, "LOADING")
              .when(after("_publish_failed", F.col("_published")), "PUBLICATION FAILED")
              .when(after("_run_failed", F.greatest("_promoted", "_published")), "PROMOTION FAILED")
              .when(count("pending_source_rows") + count("pending_corrections") > 0, "AWAITING PROMOTION")
              .when(F.greatest("_promoted", "_completed") > F.coalesce("_published", F.lit(-1)), "AWAITING PUBLICATION")
              .when(F.col("publication_id").isNull() & (count("files") == 0), "NO DATA")
              .when(F.col("publication_id").isNull(), "NO PUBLICATION")
              .otherwise("PUBLISHED"))
    seconds = lambda x: F.round(x / SECOND, 6)
    done = F.col("_file.status") == "completed"
    return j.select(
        *by, status.alias("status"), F.col("_file.key").alias("latest_file_id"), F.col("_file.status").alias("latest_file_status"),
        F.when(done, seconds(F.col("_file.seq") - F.col("_file.started_seq"))).alias("latest_file_ingestion_seconds"),
        count("files").alias("files"), *[count(c).alias(c) for c in _NUMBERS[:4]],
        count("published_rows").alias("published_rows"), count("imbalanced_files").alias("imbalanced_files"), "publication_id",
        seconds(F.lit(now) - F.col("_published")).alias("publication_age_seconds"),
        count("pending_source_rows").alias("pending_source_rows"), count("pending_corrections").alias("pending_corrections"),
        count("failed_source_files").alias("failed_source_files"), count("failed_correction_files").alias("failed_correction_files"),
        F.col("_state.key").alias("last_promotion_run_id"), F.col("_state.last_raw_record_id").alias("last_raw_record_id"),
        F.col("_state.last_correction_id").alias("last_correction_id"), F.col("_state.max_event_time").alias("max_event_time"),
        F.col("_publish_failed").alias("last_publication_failure"),
        F.col("_run_failed").alias("last_promotion_failure"))


def verification(counts: DataFrame, min_source_rows: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """D3: (check_name, passed) rows from one row of counts; the run passes if all pass.

    ``counts``: source_rows, accepted, rejected, duplicates, incomplete_files, raw_rows, staged_rows, core_rows, signal_rows, mart_rows,
    unbalanced_files, amount_differences, pending_rows, caught_up.
    """
    c = F.col
    checks = {
        "minimum_source_rows": c("source_rows") >= min_source_rows,
        "all_files_completed": c("incomplete_files") == 0,
        "manifest_arithmetic": c("source_rows") == c("accepted") + c("rejected") + c("duplicates"),
        "manifest_to_raw": c("source_rows") == c("raw_rows"),
        "accepted_to_staging": c("accepted") == c("staged_rows"),
        "staging_to_core": c("staged_rows") == c("core_rows"),
        "core_to_risk": c("core_rows") == c("signal_rows"),
        "core_to_mart": c("core_rows") == c("mart_rows"),
        "row_reconciliation": c("unbalanced_files") == 0,
        "amount_reconciliation": c("amount_differences") == 0,
        "no_pending_accepted_rows": c("pending_rows") == 0,
        "publication_caught_up": c("caught_up"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("check_name"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in checks.items()])
    return counts.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def unready(raw: DataFrame, corrections: DataFrame, files: DataFrame, correction_files: DataFrame,
            last_raw_record_id: Column | int, last_correction_id: Column | int) -> DataFrame:
    """(gate, n) of the gates that keep a publication from starting: rows not promoted yet, files still loading.

    ``files`` and ``correction_files`` hold the latest row of each file.
    """
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    gate = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("gate"), "n")
    parts = [gate(raw.filter((F.col("validation_status") == "accepted") & (F.col("raw_record_id") > lit(last_raw_record_id))), "unpromoted source rows"),
             gate(corrections.filter(F.col("correction_id") > lit(last_correction_id)), "unpromoted corrections"),
             gate(files.filter("status = 'started'"), "source files still loading"),
             gate(correction_files.filter("status = 'started'"), "correction files still loading")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).filter("n > 0")
