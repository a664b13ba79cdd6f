"""Stateful plans on the parquet store: ingest files, promote batches, publish marts.

Every step is a set of DataFrame jobs plus a few driver-side scalars read from
small control tables (manifest, run logs: one row per file or run). Re-running a
step after a crash is safe: raw rows are replaced per file partition, staging,
dimension and fact rows are insert-if-absent by key, cursors advance only after
all writes, and a publication becomes visible only when its pointer is renamed
into place (§7.4 of the survey).

Published tables are partitioned by publication and event date. A publication writes the
affected days under its own number, and a Parquet index says which publication holds each day
and file, so untouched history is neither rewritten nor read. The fact is partitioned by the date of
the original; corrections are merged on read, by day, and can be compacted to the latest per row.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C
from ..functions import contract
from ..operators import classify as cls
from ..operators import hashindex
from ..operators import health as hl
from ..operators import intervals as iv
from ..operators import promotion as pro
from ..operators import reconcile as rec
from ..operators import risk, snapshot
from ..operators.scale import assign_ids
from ..session import written
from ..sources import lines as src
from ..sources.store import Store

MANIFEST_SCHEMA = ("file_id long, path string, sha256 string, byte_size long, status string, "
                   "total_rows long, accepted_rows long, rejected_rows long, duplicate_candidates long, "
                   "error string, seq long")
RUN_SCHEMA = ("run_id long, mode string, raw_after long, raw_through long, correction_after long, "
              "correction_through long, last_raw_record_id long, last_correction_id long, "
              "max_event_time timestamp_ntz, staged_rows long, fact_rows long, corrections_applied long, "
              "new_accounts long, late_arriving_rows long, status string, error string, seq long")
PUB_SCHEMA = ("publication_id long, raw_cursor long, correction_cursor long, last_file_id long, "
              "affected_days long, affected_files long, signal_rows long, mart_rows long, "
              "status string, error string, seq long")
PUBLISHED = "published"
BANK_SCHEMA = "bank_key long, bank_code string"
ACCOUNT_SCHEMA = "account_key long, bank_key long, account_code string"
RECONCILIATIONS = ("row_reconciliation", "amount_reconciliation")
# The fact is partitioned by the date its original was paid on; corrections carry the place of the row they change.
FACT_SCHEMA = ("source_raw_record_id long, source_file_id long, event_time timestamp_ntz, from_account_key long, to_account_key long, "
               "amount_received decimal(24,6), receiving_currency string, amount_paid decimal(24,6), payment_currency string, "
               "payment_format string, is_laundering boolean, current_correction_id long, source_date date")
FACT_CORRECTION_SCHEMA = ("correction_id long, target_raw_record_id long, event_time timestamp_ntz, from_account_key long, "
                          "to_account_key long, amount_received decimal(24,6), receiving_currency string, amount_paid decimal(24,6), "
                          "payment_currency string, payment_format string, is_laundering boolean, source_file_id long, source_date date")
INDEX_SCHEMA = "kind string, key string, v long"
LATEST = "latest_corrections"
SNAPSHOT_KEYS = {"signal": ["transaction_key"], "mart": ["event_date", "from_bank", "payment_currency", "payment_format"],
                 "row_reconciliation": ["file_id"], "amount_reconciliation": ["file_id", "payment_currency"], "index": ["kind", "key"]}


def _seq() -> int:
    return time.time_ns()


def _latest(df: DataFrame, key: str) -> DataFrame:
    """Latest log row per key (highest seq)."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), "seq").alias("_r")).select("_r.*")


class Pipeline:
    """Transaction pipeline state under one store root (single writer)."""

    def __init__(self, spark: SparkSession, root: str, risk_cfg: C.RiskConfig = C.RiskConfig(),
                 policy: C.QualityPolicy = C.QualityPolicy()):
        self.spark = spark
        self.store = Store(spark, root)
        self.risk_cfg = risk_cfg
        self.policy = policy

    # --- control tables -------------------------------------------------------------
    def _log(self, table: str, row: dict, schema: str) -> None:
        self.store.append_rows(table, [{**row, "seq": _seq()}], schema)

    def manifest(self, table: str = "manifest") -> DataFrame:
        return _latest(self.store.read(table, MANIFEST_SCHEMA), "file_id")

    def _visible(self, table: str, manifest: str, key: str) -> DataFrame | None:
        """Rows of completed files only: what a failed or unfinished load left behind is never read."""
        df = self.store.read(table)
        if df is None:
            return None
        done = self.manifest(manifest).filter(F.col("status") == "completed")
        return df.join(done.select(F.col("file_id").alias(key)), key, "left_semi")

    def raw(self) -> DataFrame | None:
        return self._visible("raw", "manifest", "file_id")

    def corrections(self) -> DataFrame | None:
        return self._visible("corrections", "correction_manifest", "correction_file_id")

    def _max(self, table: str, col: str) -> int:
        df = self.store.read(table)
        if df is None:
            return 0
        return df.agg(F.coalesce(F.max(col), F.lit(0))).collect()[0][0]

    def _runs(self) -> DataFrame:
        return self.store.read("promotion_runs", RUN_SCHEMA)

    def state(self) -> dict:
        """B16 state: cursors and max event time after the last successful incremental run."""
        ok = self._runs().filter((F.col("status") == "promoted") & (F.col("mode") == "incremental"))
        row = ok.orderBy(F.col("seq").desc()).limit(1).collect()
        if not row:
            return {"last_raw_record_id": 0, "last_correction_id": 0, "max_event_time": None, "run_id": 0}
        r = row[0]
        return {"last_raw_record_id": r["last_raw_record_id"], "last_correction_id": r["last_correction_id"],
                "max_event_time": r["max_event_time"], "run_id": r["run_id"]}

    # --- A: ingest ------------------------------------------------------------------
    def _begin(self, table: str, path: str) -> tuple[int, str, int, dict | None]:
        """A4/A5: fingerprint, then skip a completed copy or reuse a failed/started file ID."""
        fp = src.fingerprint(self.spark, [path]).collect()[0]
        sha, size = fp["sha256"], fp["byte_size"]
        prior = self.manifest(table).filter(F.col("sha256") == sha).collect()
        if prior:
            p = prior[0]
            if p["status"] == "completed":
                return p["file_id"], sha, size, {"file_id": p["file_id"], "status": "skipped"}
            file_id = p["file_id"]
        else:
            file_id = self._max(table, "file_id") + 1
        self._log(table, {"file_id": file_id, "path": path, "sha256": sha, "byte_size": size,
                          "status": "started"}, MANIFEST_SCHEMA)
        return file_id, sha, size, None

    def _assert_unchanged(self, path: str, sha: str, size: int) -> None:
        """The file must not change while it is loaded."""
        fp = src.fingerprint(self.spark, [path]).collect()[0]
        if fp["sha256"] != sha or fp["byte_size"] != size:
            raise RuntimeError("source_changed_during_load")

    def ingest_file(self, path: str) -> dict:
        """Load one transaction file into raw with statuses, quarantine and manifest."""
        file_id, sha, size, skipped = self._begin("manifest", path)
        if skipped:
            return skipped
        try:
            error = src.header_status(src.first_line(self.spark, path)).collect()
            if not error:
                raise ValueError("empty_file")
            if error[0]["error"] is not None:
                raise ValueError(error[0]["error"])
            data = src.scan_lines(self.spark, [path]).filter(F.col("line_number") >= 2).select(
                F.lit(file_id).cast("long").alias("file_id"),
                F.col("line_number").alias("source_row_number"), "raw_text")
            parsed = written(cls.parse_lines(data), "parsed")
            n_lines = parsed.count()
            valid = parsed.filter(F.size("reason_codes") == 0)
            classified = cls.classify_parsed(parsed, self._accepted(valid, file_id))
            start = self._max_raw_id(file_id)
            # Line numbers of one file are already dense and ordered, so the raw ID is an
            # offset of the line number (the general distributed numbering is not needed here).
            with_ids = classified.withColumn(
                "raw_record_id", F.col("source_row_number") - F.lit(1) + F.lit(start).cast("long"))
            # Raw files are range-split and sorted by ID (about 128 MB of source per file, at
            # least one per core), so promotion windows on raw_record_id skip files and row
            # groups by their min/max statistics.
            parts = max(self.spark.sparkContext.defaultParallelism, -(-size // (128 << 20)))
            with_ids = with_ids.repartitionByRange(parts, "raw_record_id").sortWithinPartitions("raw_record_id")
            self.store.overwrite_partitions("raw", with_ids, ["file_id"])
            self._assert_unchanged(path, sha, size)
            loaded = self.store.read("raw").filter(F.col("file_id") == file_id)
            counts = cls.manifest_counts(loaded).collect()
            # Rows of a load that fails later stay in the index, but count only once their file is completed. A
            # second attempt may add them again: a hash it no longer accepts is accepted in another file.
            self.store.append("accepted_index", hashindex.index_rows(loaded), ["prefix"])
            c = counts[0].asDict() if counts else {"total_rows": 0, "accepted_rows": 0, "rejected_rows": 0,
                                                   "duplicate_candidates": 0}
            if c["total_rows"] != n_lines:
                raise RuntimeError("raw_count_mismatch")
            if c["total_rows"] != c["accepted_rows"] + c["rejected_rows"] + c["duplicate_candidates"]:
                raise RuntimeError("manifest_counts_do_not_add_up")
            self._log("manifest", {"file_id": file_id, "path": path, "sha256": sha, "byte_size": size,
                                   "status": "completed", **{k: c[k] for k in (
                                       "total_rows", "accepted_rows", "rejected_rows", "duplicate_candidates")}},
                      MANIFEST_SCHEMA)
            return {"file_id": file_id, "status": "completed", **c}
        except Exception as exc:
            self._log("manifest", {"file_id": file_id, "path": path, "sha256": sha, "byte_size": size,
                                   "status": "failed", "error": str(exc)[:2000]}, MANIFEST_SCHEMA)
            raise

    def _accepted(self, valid: DataFrame, file_id: int) -> DataFrame | None:
        """A10: hashes of ``valid`` rows that completed files have accepted, from the touched parts of the index."""
        if not self.store.exists("accepted_index"):
            return None
        done = self.manifest().filter((F.col("status") == "completed") & (F.col("file_id") != file_id)).select("file_id")
        index = self.store.read("accepted_index", hashindex.SCHEMA).join(done, "file_id", "left_semi")
        return hashindex.seen(index, valid)

    def _max_raw_id(self, exclude_file: int) -> int:
        raw = self.store.read("raw")
        if raw is None:
            return 0
        return raw.filter(F.col("file_id") != exclude_file) \
            .agg(F.coalesce(F.max("raw_record_id"), F.lit(0))).collect()[0][0]

    def ingest_corrections(self, path: str) -> dict:
        """A correction file is all-or-nothing; targets must be accepted raw rows."""
        file_id, sha, size, skipped = self._begin("correction_manifest", path)
        if skipped:
            return skipped
        try:
            error = src.header_status(src.first_line(self.spark, path), (C.CORRECTION_TARGET_HEADER, *C.HEADERS)).collect()
            if not error:
                raise ValueError("empty_correction_file")
            if error[0]["error"] is not None:
                raise ValueError(f"correction_{error[0]['error']}")
            lines = src.scan_lines(self.spark, [path])
            rows = lines.filter(F.col("line_number") >= 2)
            parsed = written(cls.parse_corrections(rows.select("line_number", "raw_text")), "corrections")
            bad = parsed.filter(F.col("error").isNotNull()).select("line_number", F.col("error").alias("e")) \
                .orderBy("line_number").limit(1).collect()
            if bad:
                raise ValueError(f"correction row {bad[0]['line_number']}: {bad[0]['e']}")
            raw = self.raw()
            if raw is None:
                raise ValueError("no transaction file is loaded yet")
            missing = cls.missing_targets(parsed, raw).orderBy("line_number").limit(1).collect()  # A16
            if missing:
                raise ValueError(f"correction target {missing[0]['target_raw_record_id']} is not an accepted row")
            start = self._max("corrections", "correction_id")
            rows_out = parsed.select(F.lit(file_id).cast("long").alias("correction_file_id"),
                                     F.col("line_number").alias("source_row_number"), "target_raw_record_id",
                                     "raw_text", "payload", "record_hash")
            with_ids = assign_ids(rows_out, ["source_row_number"], "correction_id", start)
            self.store.overwrite_partitions("corrections", with_ids, ["correction_file_id"])
            self._assert_unchanged(path, sha, size)
            n = self.store.read("corrections").filter(F.col("correction_file_id") == file_id).count()
            if n != parsed.count():
                raise RuntimeError("correction_count_mismatch")
            self._log("correction_manifest", {"file_id": file_id, "path": path, "sha256": sha, "byte_size": size,
                                              "status": "completed", "total_rows": n, "accepted_rows": n,
                                              "rejected_rows": 0, "duplicate_candidates": 0}, MANIFEST_SCHEMA)
            return {"file_id": file_id, "status": "completed", "corrections": n}
        except Exception as exc:
            self._log("correction_manifest", {"file_id": file_id, "path": path, "sha256": sha,
                                              "byte_size": size, "status": "failed",
                                              "error": str(exc)[:2000]}, MANIFEST_SCHEMA)
            raise

    # --- B: promote ---------------------------------------------------------------------
    def _fact(self) -> DataFrame | None:
        return self.store.read("fact", FACT_SCHEMA) if self.store.exists("fact") else None

    def _latest_corrections(self) -> DataFrame | None:
        """The latest applied correction per row: the compacted ones, and those applied since."""
        if not self.store.exists("fact_corrections"):
            return None
        deltas = self.store.read("fact_corrections", FACT_CORRECTION_SCHEMA)
        v = self.store.current_version(LATEST)
        if v is not None:
            deltas = deltas.filter(F.col("correction_id") > self.store.read_pointer(LATEST, v)["through"])
            deltas = deltas.unionByName(self.store.read_version(LATEST, "latest", v, FACT_CORRECTION_SCHEMA))
        return pro.latest_correction(deltas)

    def compact_corrections(self) -> int | None:
        """Write the latest correction per row as a version, so that reads fold only later ones; its last ID."""
        latest = self._latest_corrections()
        if latest is None:
            return None
        n = self.store.next_version(LATEST)
        self.store.write_version_table(LATEST, "latest", n, latest)
        through = self.store.read_version(LATEST, "latest", n, FACT_CORRECTION_SCHEMA).agg(F.max("correction_id")).first()[0] or 0
        self.store.commit_version(LATEST, n, {"through": through})
        return through

    def fact_current(self, days: list | None = None) -> DataFrame | None:
        """Current fact: immutable originals with the latest applied correction per row.

        With ``days``, the rows whose current date is among them: reads the originals of those days and of the days that
        a correction moved rows from, as partition filters; a list of dates is as long as a calendar.
        """
        base, latest = self._fact(), self._latest_corrections()
        if base is None:
            return None
        if days is not None:
            of = lambda col, values: F.col(col).isin([F.lit(str(d)).cast("date") for d in values])
            moved = [] if latest is None else [r[0] for r in latest.filter(F.to_date("event_time").isin(
                [F.lit(str(d)).cast("date") for d in days])).select("source_date").distinct().collect()]
            read = sorted({str(d) for d in [*days, *moved]})
            base = base.filter(of("source_date", read))
            latest = None if latest is None else latest.filter(of("source_date", read))
        out = base if latest is None else pro.apply_corrections(base, latest.drop("source_file_id", "source_date"))
        return out if days is None else out.filter(F.to_date("event_time").isin([F.lit(str(d)).cast("date") for d in days]))

    def promote(self, mode: str = "incremental", raw_limit: int | None = None,
                correction_limit: int | None = None, backfill: tuple[int, int] | None = None,
                correction_backfill: tuple[int, int] | None = None) -> dict:
        """Promote one window of accepted raw rows and corrections (None: all that is pending).

        A backfill takes ID ranges (after, through] of rows, of corrections, or of both.
        """
        if any(limit is not None and limit <= 0 for limit in (raw_limit, correction_limit)):
            raise ValueError("limits must be positive")
        if mode not in ("incremental", "backfill"):
            raise ValueError("mode must be incremental or backfill")
        if mode == "incremental" and (backfill is not None or correction_backfill is not None):
            raise ValueError("ranges need backfill mode")
        st = self.state()
        bounds = {"raw_after": None, "raw_through": None, "correction_after": None, "correction_through": None}
        try:
            raw = self.raw()
            if raw is None:
                return {"status": "skipped"}
            if mode == "backfill":
                if backfill is None and correction_backfill is None:
                    raise ValueError("backfill needs a range")
                raw_after, raw_through = backfill or (0, 0)
                corr_after, corr_through = correction_backfill or (0, 0)
                pro.check_backfill(raw_after, raw_through, self._max("raw", "raw_record_id"))
                pro.check_backfill(corr_after, corr_through, self._max("corrections", "correction_id"))
            else:
                w = pro.raw_window(raw, st["last_raw_record_id"], raw_limit).collect()[0]
                raw_after, raw_through = w["raw_after"], w["raw_through"]
                corr_after, corr_through = st["last_correction_id"], st["last_correction_id"]
                corr_raw = self.corrections()
                fact = self._fact()
                if corr_raw is not None:
                    fact_ids = fact if fact is not None else self.spark.createDataFrame(
                        [], "source_raw_record_id long")
                    cw = pro.correction_window(corr_raw, fact_ids, st["last_correction_id"], raw_through,
                                               correction_limit).collect()[0]
                    corr_after, corr_through = cw["correction_after"], cw["correction_through"]
            bounds = {"raw_after": raw_after, "raw_through": raw_through,
                      "correction_after": corr_after, "correction_through": corr_through}
            if raw_through == raw_after and corr_through == corr_after:
                return {"status": "skipped", **bounds}                                    # B4
            window = raw.filter(pro.in_range("raw_record_id", raw_after, raw_through))
            staged_all = self.store.read("staging")
            # Idempotency joins only need existing rows inside the window's ID range.
            in_win = lambda df, col: None if df is None else df.filter(
                pro.in_range(col, raw_after, raw_through))
            had = lambda table, col: 0 if (df := in_win(table, col)) is None else df.count()
            had_staged, had_fact = had(staged_all, "raw_record_id"), had(self._fact(), "source_raw_record_id")
            new_staged = pro.stage(window, in_win(staged_all, "raw_record_id"))
            self.store.append("staging", new_staged)
            staged_all = self.store.read("staging")
            staged_win = staged_all.filter(pro.in_range("raw_record_id", raw_after, raw_through))
            n_acc = window.filter(F.col("validation_status") == C.ACCEPTED).count()
            n_stg = staged_win.count()
            if n_acc != n_stg:                                                            # B7
                raise RuntimeError(f"{n_acc} accepted rows, {n_stg} staged rows")
            corr_win = None
            if corr_through > corr_after:
                in_corr = pro.in_range("correction_id", corr_after, corr_through)
                events = self.corrections()
                events = None if events is None else events.filter(in_corr)
                if events is None or events.isEmpty():
                    raise RuntimeError("no completed correction in the range")
                had_corr = self.store.read("staging_corrections")
                self.store.append("staging_corrections", pro.stage_corrections(events, None if had_corr is None else had_corr.filter(in_corr)))  # B6
                corr_win = self.store.read("staging_corrections").filter(in_corr)
                if corr_win.count() != events.count():                                     # B7
                    raise RuntimeError("some corrections were not staged")
            banks = self.store.read("bank_dim")
            new_banks = pro.upsert_banks(banks, staged_win, corr_win)
            self.store.append("bank_dim", new_banks)
            banks = self.store.read("bank_dim")
            accounts = self.store.read("account_dim")
            new_accounts = pro.upsert_accounts(accounts, banks, staged_win, corr_win)
            self.store.append("account_dim", new_accounts)
            accounts = self.store.read("account_dim")
            new_fact = pro.insert_fact(staged_win, banks, accounts, in_win(self._fact(), "source_raw_record_id"))
            self.store.append("fact", new_fact.withColumn("source_date", F.to_date("event_time")), ["source_date"])
            fact = self._fact()
            n_fact = fact.filter(pro.in_range("source_raw_record_id", raw_after, raw_through)).count()
            if n_fact != n_stg:                                                           # B11
                raise RuntimeError(f"{n_stg} staged rows, {n_fact} fact rows")
            applied = 0
            if corr_win is not None:
                place = fact.select(F.col("source_raw_record_id").alias("target_raw_record_id"), "source_file_id", "source_date")
                keyed = written(pro.with_account_keys(corr_win, banks, accounts)
                                .select("correction_id", "target_raw_record_id", *pro.FACT_VALUE_COLS)
                                .join(place, "target_raw_record_id", "left"), "corrections")
                orphans = keyed.filter("source_date is null").count()
                if orphans:                                                               # B12
                    raise RuntimeError(f"{orphans} corrections have no fact row")
                if self.store.exists("fact_corrections"):
                    prior = self.store.read("fact_corrections", FACT_CORRECTION_SCHEMA)
                    keyed = keyed.join(prior.filter(in_corr).select("correction_id"), "correction_id", "left_anti")
                latest = self._latest_corrections()
                news = pro.latest_correction(keyed)
                if latest is not None:
                    older = latest.select("target_raw_record_id", F.col("correction_id").alias("_had"))
                    news = news.join(older, "target_raw_record_id", "left").filter("_had is null or _had < correction_id")
                applied = news.count()
                self.store.append("fact_corrections", keyed.select(*self.store.read("fact_corrections", FACT_CORRECTION_SCHEMA).columns))
            wm = st["max_event_time"]
            late = 0
            if mode == "incremental" and wm is not None:                                  # B15
                late = staged_win.filter(F.col("event_time") < F.lit(wm)).count()
            ev = staged_win.select("event_time")
            if corr_win is not None:
                ev = ev.unionByName(corr_win.select("event_time"))
            batch_max = ev.agg(F.max("event_time")).collect()[0][0]
            new_max = max([t for t in (wm, batch_max) if t is not None], default=None)   # B16
            incremental = mode == "incremental"
            run = {"run_id": st["run_id"] + 1 if incremental else st["run_id"], "mode": mode, **bounds,
                   "last_raw_record_id": raw_through if incremental else st["last_raw_record_id"],
                   "last_correction_id": corr_through if incremental else st["last_correction_id"],
                   "max_event_time": new_max if incremental else wm,
                   "staged_rows": n_stg - had_staged, "fact_rows": n_fact - had_fact, "corrections_applied": applied,
                   "new_accounts": new_accounts.count(), "late_arriving_rows": late, "status": "promoted"}
            self._log("promotion_runs", run, RUN_SCHEMA)                                  # B17
            return run
        except Exception as exc:                                                          # B19
            self._log("promotion_runs", {"run_id": st["run_id"], "mode": mode, **bounds, "status": "failed",
                                         "error": str(exc)[:2000]}, RUN_SCHEMA)
            raise

    def catch_up(self, **kw) -> list[dict]:
        """Promote until a run is skipped. Cursors only advance, so this ends; by default in one window."""
        out = []
        while not out or out[-1]["status"] != "skipped":
            out.append(self.promote(**kw))
        return out

    # --- C: publish ---------------------------------------------------------------------
    def _publications(self) -> DataFrame:
        return self.store.read("publication_log", PUB_SCHEMA)

    def published_index(self) -> DataFrame:
        """(kind, key, v): the publication that last wrote each day and each reconciled file."""
        now = self.store.current_version(PUBLISHED)
        if now is None:
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        index = self.spark.read.schema(INDEX_SCHEMA).parquet(self.store.path(PUBLISHED, "index"))
        return index.filter(F.col("v") <= now).groupBy("kind", "key").agg(F.max("v").alias("v"))

    def read_published(self, table: str) -> DataFrame | None:
        """Current published table: each day (reconciliations: each file) from the publication that last wrote it.

        One scan of all versions, joined to the index on its partition columns.
        """
        now = self.store.current_version(PUBLISHED)
        if now is None:
            return None
        kind, key, kept = ("file", "file_id", "long") if table in RECONCILIATIONS else ("day", "event_date", "date")
        mine = self.published_index().filter(F.col("kind") == kind).select(F.col("key").cast(kept).alias(key), "v")
        schema = StructType.fromJson(self.store.read_pointer(PUBLISHED, now)["schemas"][table])
        return self.store.read_versions(PUBLISHED, table, schema).filter(F.col("v") <= now).join(mine, [key, "v"], "left_semi").select(*schema.names)

    def _fact_rows(self, fact: DataFrame) -> DataFrame:
        from ..queries import fact_with_codes
        return fact_with_codes(fact, self.store.read("bank_dim", BANK_SCHEMA), self.store.read("account_dim", ACCOUNT_SCHEMA))

    def _stored(self, table: str, pub_id: int, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        """Write a published table under the publication and read the written rows back."""
        self.store.write_version_table(PUBLISHED, table, pub_id, df, by)
        return self.store.read_version(PUBLISHED, table, pub_id, df.schema)

    def _unpublished(self) -> tuple[dict | None, DataFrame, DataFrame]:
        """(last publication, promotion runs since it, files completed since it)."""
        last = self._publications().filter(F.col("status") == "published").orderBy(F.col("seq").desc()).limit(1).collect()
        prev = last[0] if last else None
        since = F.lit(prev["seq"] if prev else 0)
        runs = self._runs().filter((F.col("status") == "promoted") & (F.col("seq") > since))
        files = self.manifest().filter((F.col("status") == "completed") & (F.col("seq") > since))
        return prev, runs, files

    def _unready(self, raw: DataFrame | None, manifest: DataFrame, st: dict) -> DataFrame:
        none = self.spark.createDataFrame([], "raw_record_id long, validation_status string, correction_id long")
        corr = self.corrections()
        return hl.unready(none if raw is None else raw, none if corr is None else corr, manifest, self.manifest("correction_manifest"),
                          st["last_raw_record_id"], st["last_correction_id"])

    def _reconciled(self, pub_id: int, manifest: DataFrame, raw: DataFrame, staging: DataFrame, base: DataFrame,
                    files: DataFrame) -> tuple[DataFrame, DataFrame]:
        """C14-C16 of ``files``, stored. A file's rows have consecutive IDs, so staging, fact and corrections are read
        between the first and last ID of the files only (file and row group statistics skip the rest)."""
        ends = files.agg(F.min("file_id"), F.max("file_id")).first()
        of_files = raw.filter(F.col("file_id").between(*ends)) if ends[0] is not None else raw.limit(0)
        of_files = of_files.join(files, "file_id", "left_semi")
        lo, hi = of_files.agg(F.min("raw_record_id"), F.max("raw_record_id")).first()
        near = lambda df, c: df.limit(0) if lo is None else df.filter(F.col(c).between(lo, hi))
        staged, core, latest = near(staging, "raw_record_id"), near(base, "source_raw_record_id"), self._latest_corrections()
        rows_r = self._stored("row_reconciliation", pub_id, rec.row_reconciliation(manifest, of_files, staged, core, files))
        latest = self.spark.createDataFrame([], FACT_CORRECTION_SCHEMA) if latest is None else near(latest, "target_raw_record_id")
        current = pro.apply_corrections(core, latest.drop("source_file_id", "source_date"))
        paid = of_files.filter(F.col("validation_status") == C.ACCEPTED).select(
            "file_id", F.col("payload.payment_currency").alias("payment_currency"), contract.amount_value(F.col("payload.amount_paid")).alias("amount_paid"))
        return rows_r, self._stored("amount_reconciliation", pub_id, rec.amount_reconciliation(paid, staged, latest, current, files))

    def publish(self) -> dict:
        """Refresh affected days, run every gate on the written data, then commit."""
        st = self.state()
        raw = self.raw()
        manifest = self.manifest()
        unready = self._unready(raw, manifest, st).collect()                              # C1, C2
        if unready:
            raise RuntimeError("not ready to publish: " + "; ".join(f"{r['n']} {r['gate']}" for r in unready))
        prev, runs, new_files = self._unpublished()
        last_file = self._max("manifest", "file_id")
        if raw is None or (runs.isEmpty() and new_files.isEmpty()):
            return {"status": "skipped", "publication_id": prev["publication_id"] if prev else None}  # C3
        pub_id = self.store.next_version(PUBLISHED)
        try:
            staging = self.store.read("staging")
            staging = pro.stage(raw.limit(0)) if staging is None else staging
            base = self._fact()
            base = self.spark.createDataFrame([], FACT_SCHEMA) if base is None else base
            all_corr = self.store.read("fact_corrections", FACT_CORRECTION_SCHEMA)
            # Rows that any run since the last publication promoted, backfills included.
            new_staged = iv.covered(staging, "raw_record_id", iv.merged(runs, "raw_after", "raw_through"))
            new_corr = iv.covered(all_corr, "correction_id", iv.merged(runs, "correction_after", "correction_through"))
            # Corrections carry the date and file of the row they change, so the fact is not searched for them.
            originals = new_corr.select(F.col("target_raw_record_id").alias("source_raw_record_id"), "source_file_id",
                                        F.col("source_date").cast("timestamp_ntz").alias("event_time"))
            days = written(iv.affected_days(new_staged, new_corr, originals, all_corr), "days")           # C4
            files = written(iv.affected_files(new_files, new_staged, new_corr, originals), "files")       # C5
            day_list = sorted(r[0] for r in days.collect())  # a calendar's length, for partition filters
            fact = self.fact_current(day_list)
            fact = base if fact is None else fact
            w_signal = self._stored("signal", pub_id, risk.risk_signal(self._fact_rows(fact), self.risk_cfg), ["event_date"])
            # The mart is built from the written signal: no second pass over the rules.
            w_mart = self._stored("mart", pub_id, risk.daily_mart(w_signal, self.risk_cfg), ["event_date"])
            rows_r, amounts = self._reconciled(pub_id, manifest, raw, staging, base, files)
            quality = rec.quality_gate(manifest, files, self.policy.max_rejected_fraction)
            failures = [f"{r['gate']} ({r['n']} in all, first file {r['file_id']})" for r in
                        rec.gate_failures(rows_r, amounts, quality).groupBy("gate")
                        .agg(F.count(F.lit(1)).alias("n"), F.min("file_id").alias("file_id")).orderBy("gate").collect()]  # C17
            # C18-C20 from one comparison per currency: core, signal and mart rows, and the paid totals.
            sums = rec.currency_diff(fact, w_mart).agg(
                F.coalesce(F.sum("core_rows"), F.lit(0)).alias("core"), F.coalesce(F.sum("mart_rows"), F.lit(0)).alias("mart"),
                F.count_if(F.col("amount_delta") != 0).alias("n"), F.min(F.when(F.col("amount_delta") != 0, F.col("payment_currency"))).alias("c")).first()
            sig_rows = w_signal.count()
            if sums["core"] != sig_rows:                                                   # C18
                failures.append(f"risk coverage: {sums['core']} core rows, {sig_rows} signal rows")
            if sums["mart"] != sig_rows:                                                   # C19
                failures.append(f"mart count: {sums['mart']} != {sig_rows}")
            if sums["n"]:                                                                  # C20
                failures.append(f"mart amount differs for {sums['n']} currencies, first {sums['c']}")
            if failures:
                raise RuntimeError("; ".join(failures))
            index = days.select(F.lit("day").alias("kind"), F.col("event_date").cast("string").alias("key")).unionByName(
                files.select(F.lit("file").alias("kind"), F.col("file_id").cast("string").alias("key")))
            self.store.write_version_table(PUBLISHED, "index", pub_id, index)
            schemas = {"signal": w_signal, "mart": w_mart, "row_reconciliation": rows_r, "amount_reconciliation": amounts}
            self.store.commit_version(PUBLISHED, pub_id, {"schemas": {k: d.schema.jsonValue() for k, d in schemas.items()}})  # C22
            out = {"publication_id": pub_id, "raw_cursor": st["last_raw_record_id"],
                   "correction_cursor": st["last_correction_id"], "last_file_id": last_file,
                   "affected_days": len(day_list), "affected_files": files.count(),
                   "signal_rows": sig_rows, "mart_rows": w_mart.count(), "status": "published"}
            self._log("publication_log", out, PUB_SCHEMA)                                  # C21
            return out
        except Exception as exc:
            self._log("publication_log", {"publication_id": pub_id, "status": "failed",
                                          "error": str(exc)[:2000]}, PUB_SCHEMA)
            raise

    # --- D: health ------------------------------------------------------------------------
    def _pending(self) -> DataFrame:
        st, raw, corr = self.state(), self.raw(), self.corrections()
        none = self.spark.createDataFrame([], "raw_record_id long, validation_status string, correction_id long")
        rows = (none if raw is None else raw).agg(F.count_if((F.col("validation_status") == C.ACCEPTED)
                                                             & (F.col("raw_record_id") > st["last_raw_record_id"])).alias("pending_source_rows"))
        events = (none if corr is None else corr).agg(F.count_if(F.col("correction_id") > st["last_correction_id"]).alias("pending_corrections"))
        return rows.crossJoin(events)  # one row each

    def health(self) -> DataFrame:
        """One row of counters, times and the status, over the event logs."""
        mart, recon = self.read_published("mart"), self.read_published("row_reconciliation")
        none = self.spark.createDataFrame([], "transaction_count long, is_balanced boolean")
        published = (none if mart is None else mart).agg(F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("published_rows")).crossJoin(
            (none if recon is None else recon).agg(F.count_if(~F.coalesce("is_balanced", F.lit(False))).alias("imbalanced_files")))
        logs = hl.events([], files=self.store.read("manifest", MANIFEST_SCHEMA), corrections=self.store.read("correction_manifest", MANIFEST_SCHEMA),
                         runs=self._runs(), publications=self._publications())
        return hl.health(logs, self._pending(), published, _seq())

    def snapshot(self) -> dict[str, DataFrame]:
        """Every published table and the current publication, to be compared with another (``snapshot.compare``)."""
        out = {t: self.read_published(t) for t in SNAPSHOT_KEYS if t != "index"}
        return {**{t: d for t, d in out.items() if d is not None}, "index": self.published_index()}

    def _digests(self) -> DataFrame:
        parts = [snapshot.digest(df, SNAPSHOT_KEYS[t]).withColumn("table_name", F.lit(t)) for t, df in sorted(self.snapshot().items())]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def save_snapshot(self, name: str) -> None:
        """Keep the digests of what is published under a name; a name that exists is refused."""
        self.store.write_once(f"snapshots/{name}", self._digests())

    def changed_since(self, name: str) -> DataFrame:
        """(table_name) of published tables whose rows are not those of a saved snapshot."""
        keys = ["table_name", "bucket"]
        mark = lambda d, side: d.select(*keys, F.struct("rows", "sum_1", "sum_2").alias(side))
        both = mark(self.store.read(f"snapshots/{name}"), "_then").join(mark(self._digests(), "_now"), keys, "full")
        return both.filter(~F.col("_then").eqNullSafe(F.col("_now"))).select("table_name").distinct()

    def _caught_up(self) -> bool:
        """The last publication covers every completed file and every promotion run."""
        prev, runs, files = self._unpublished()
        return prev is not None and not runs.limit(1).count() and not files.limit(1).count()

    def verify_run(self, min_source_rows: int = 1) -> DataFrame:
        """D3: full-run verification as (check_name, passed) rows; the run passes if all pass."""
        files = self.manifest().filter(F.col("status") == "completed")
        total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
        counts = self.manifest().agg(total("total_rows", "source_rows"), total("accepted_rows", "accepted"), total("rejected_rows", "rejected"),
                                     total("duplicate_candidates", "duplicates"), F.count_if(F.col("status") != "completed").alias("incomplete_files"))
        raw, staging, base, fact = self.raw(), self.store.read("staging"), self._fact(), self.fact_current()
        signal, mart = self.read_published("signal"), self.read_published("mart")
        none = self.spark.createDataFrame([], "transaction_count long")
        for name, df in (("raw_rows", raw), ("staged_rows", staging), ("core_rows", fact), ("signal_rows", signal)):
            counts = counts.crossJoin((none if df is None else df).agg(F.count(F.lit(1)).alias(name)))  # one row each
        counts = counts.crossJoin((none if mart is None else mart).agg(total("transaction_count", "mart_rows")))
        uneven = different = none.agg(F.count(F.lit(1)))
        if raw is not None and staging is not None and base is not None:
            latest = self._latest_corrections()
            latest = self.spark.createDataFrame([], FACT_CORRECTION_SCHEMA) if latest is None else latest
            uneven = rec.row_reconciliation(files, raw, staging, base, files).agg(F.count_if(~F.coalesce("is_balanced", F.lit(False))))
            paid = raw.filter(F.col("validation_status") == C.ACCEPTED).select(
                "file_id", F.col("payload.payment_currency").alias("payment_currency"), contract.amount_value(F.col("payload.amount_paid")).alias("amount_paid"))
            different = rec.amount_reconciliation(paid, staging, latest, fact, files).agg(
                F.count_if((F.col("raw_staging_delta") != 0) | (F.col("effective_core_delta") != 0)))
        counts = (counts.crossJoin(uneven.toDF("unbalanced_files")).crossJoin(different.toDF("amount_differences"))
                  .crossJoin(self._pending().select(F.col("pending_source_rows").alias("pending_rows")))
                  .withColumn("caught_up", F.lit(self._caught_up())))
        return hl.verification(counts, min_source_rows)
