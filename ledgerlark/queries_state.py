"""Registered queries of the stateful parts: snapshots, run intervals, gates, health and verification.

Their inputs (runs, logs, changed copies) are derived from the driver tables, with faults planted by ID.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import queries as Q
from .operators import classify as cls
from .operators import health as hl
from .operators import intervals as iv
from .operators import reconcile as rec
from .operators import snapshot as snap
from .queries import register

# --- D4: snapshot equality -----------------------------------------------------------------


def two_snapshots(spark, sf_dir) -> tuple[dict, dict, dict]:
    """Tables of the world and a copy in which rows of ``core`` are changed, lost and doubled; ``files`` is missing."""
    core = Q.txn(spark, sf_dir).select("raw_record_id", "file_id", "event_time", "payment_currency", "amount_paid")
    daily = core.groupBy(F.to_date("event_time").alias("event_date"), "payment_currency").agg(F.sum("amount_paid").alias("paid"))
    r = F.col("raw_record_id") % 5000
    cent = F.when(r == 17, F.lit("0.01").cast("decimal(24,6)")).otherwise(0)
    other = core.filter(r != 33).withColumn("amount_paid", (F.col("amount_paid") + cent).cast("decimal(24,6)"))
    other = other.unionByName(core.filter(r == 51))
    keys = {"core": ["raw_record_id"], "daily": ["event_date"], "files": ["file_id"]}
    return {"core": core, "daily": daily, "files": core.select("file_id").distinct()}, {"core": other, "daily": daily.repartition(3)}, keys


@register("snapshot_compare")
def q_snapshot_compare(spark, sf_dir):
    return snap.compare(*two_snapshots(spark, sf_dir))


@register("snapshot_differences")
def q_snapshot_differences(spark, sf_dir):
    a, b, keys = two_snapshots(spark, sf_dir)
    return snap.differences(a["core"], b["core"], keys["core"]).select("raw_record_id", "amount_paid", "side", "times")


# --- C4/C5: what a publication must refresh ---------------------------------------------------


def planted_runs(spark, sf_dir) -> DataFrame:
    """Promotion runs over short, partly overlapping ID ranges, one in a few thousand events."""
    e, n = Q.events(spark, sf_dir), F.col("event_id")
    return e.filter((n % 2500).isin(100, 130)).select(
        n.alias("raw_after"), (n + F.when(n % 5000 < 2500, 40).otherwise(0)).alias("raw_through"),
        n.alias("correction_after"), (n + 60).alias("correction_through"))


def refreshed(spark, sf_dir):
    runs = planted_runs(spark, sf_dir)
    staged, corr = Q.staged_world(spark, sf_dir), Q.corrections_world(spark, sf_dir)
    new_staged = iv.covered(staged, "raw_record_id", iv.merged(runs, "raw_after", "raw_through"), 1000)
    new_corr = iv.covered(corr, "correction_id", iv.merged(runs, "correction_after", "correction_through"), 1000)
    base = staged.withColumnRenamed("raw_record_id", "source_raw_record_id")
    return new_staged, new_corr, base, corr


@register("publish_affected_days")
def q_affected_days(spark, sf_dir):
    return iv.affected_days(*refreshed(spark, sf_dir))


@register("publish_affected_files")
def q_affected_files(spark, sf_dir):
    new_staged, new_corr, base, _ = refreshed(spark, sf_dir)
    return iv.affected_files(Q.txn(spark, sf_dir).filter("event_id = 3").select("file_id"), new_staged, new_corr, base)


@register("publish_covered_rows")
def q_covered(spark, sf_dir):
    new_staged, new_corr, _, _ = refreshed(spark, sf_dir)
    return new_staged.select(F.lit("raw").alias("kind"), F.col("raw_record_id").alias("id")).unionByName(
        new_corr.select(F.lit("correction").alias("kind"), F.col("correction_id").alias("id")))


# --- C1, C2, C17: gates --------------------------------------------------------------------------


@register("publish_unready")
def q_unready(spark, sf_dir):
    """Cursors a little behind the data, one file of four still loading."""
    raw = Q.staged_world(spark, sf_dir).withColumn("validation_status", F.when(F.col("raw_record_id") % 3 == 0, "rejected").otherwise("accepted"))
    corr = Q.corrections_world(spark, sf_dir)
    files = raw.groupBy(F.col("source_file_id").alias("file_id")).agg(F.lit("x").alias("x")) \
        .select("file_id", F.when(F.col("file_id") == 3, "started").otherwise("completed").alias("status"))
    last_raw, last_corr = raw.agg(F.max("raw_record_id")).first()[0] - 50, corr.agg(F.max("correction_id")).first()[0] - 99
    return hl.unready(raw, corr, files, files.filter("file_id <> 3"), last_raw, last_corr)


@register("publish_gate_failures")
def q_gate_failures(spark, sf_dir):
    manifest = cls.manifest_counts(Q.classified_lines(spark, sf_dir))
    return rec.gate_failures(Q.q_reconcile_rows(spark, sf_dir), Q.q_reconcile_amounts(spark, sf_dir),
                             rec.quality_gate(manifest.filter("file_id < 3"), manifest, 0.05)).distinct()


# --- C26, D1-D3: health and verification ------------------------------------------------------------
_LATER = 10**12  # seq of a stage of the planted logs: files, runs, publications, what came after


def planted_logs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event logs of nine pipelines (event_id modulo 9), each in another state; rows pending, rows published."""
    e = Q.events(spark, sf_dir).select("event_id", "ts", (F.col("event_id") % 9).alias("pipeline"))
    n, p = F.col("event_id"), F.col("pipeline")
    file_id = F.floor(n / 9) % 40
    outcome = F.when((p == 1) & (file_id == 3), "failed").when((p == 2) & (file_id == 4), "started").when(p == 7, "skipped").otherwise("completed")
    loads = e.filter("pipeline < 8").select("pipeline", file_id.alias("file_id"), F.explode(F.array(
        F.struct(F.lit("started").alias("status"), (n * 10).alias("seq")), F.struct(outcome.alias("status"), (n * 10 + 5).alias("seq")))).alias("r"),
        (file_id + 10).alias("total_rows"), (file_id + 9).alias("accepted_rows"), F.lit(1).alias("rejected_rows"), F.lit(0).alias("duplicate_candidates"))
    files = loads.select("pipeline", "file_id", "r.*", "total_rows", "accepted_rows", "rejected_rows", "duplicate_candidates")
    corrections = e.filter("pipeline < 7 and event_id % 180 < 9").select("pipeline", n.alias("file_id"), F.lit("completed").alias("status"), n.alias("seq"))
    run = lambda df, status, stage: df.select(
        "pipeline", n.alias("run_id"), F.lit(status).alias("status"), (n + stage * _LATER).alias("seq"), F.lit("incremental").alias("mode"),
        n.alias("last_raw_record_id"), F.floor(n / 2).alias("last_correction_id"), F.col("ts").cast("timestamp_ntz").alias("max_event_time"))
    some = e.filter("pipeline < 7 and event_id % 90 < 9")
    runs = run(some, "promoted", 1).unionByName(run(some.filter("pipeline = 4"), "failed", 3)).unionByName(run(some.filter("pipeline = 6"), "promoted", 3))
    publication = lambda df, status, stage: df.select(
        "pipeline", n.alias("publication_id"), F.lit(status).alias("status"), (n + stage * _LATER).alias("seq"))
    few = e.filter("pipeline < 7 and event_id % 900 < 9")
    publications = publication(few, "published", 2).unionByName(publication(few.filter("pipeline = 3"), "failed", 3))
    logs = hl.events(["pipeline"], files=files, corrections=corrections, runs=runs, publications=publications)
    pending = e.groupBy("pipeline").agg(F.count_if((p == 5) & (n % 10 == 0)).alias("pending_source_rows"),
                                        F.count_if((p == 5) & (n % 100 == 0)).alias("pending_corrections"))
    published = e.filter("pipeline < 7").groupBy("pipeline").agg(F.count(F.lit(1)).alias("published_rows"), F.count_if(n % 1000 == 0).alias("imbalanced_files"))
    return logs, pending, published


@register("pipeline_health")
def q_health(spark, sf_dir):
    return hl.health(*planted_logs(spark, sf_dir), now=4 * _LATER, by=["pipeline"])


@register("run_verification")
def q_verification(spark, sf_dir):
    """A sound run, and one whose layers lost rows of some hashes."""
    c = Q.classified_lines(spark, sf_dir)
    is_ = lambda s: F.col("validation_status") == s
    lost = lambda x: F.col("record_hash").startswith(x)
    n = c.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(is_("accepted")).alias("accepted"), F.count_if(is_("rejected")).alias("rejected"),
              F.count_if(is_("duplicate_candidate")).alias("duplicates"), F.count_if(is_("accepted") & lost("0")).alias("_a"),
              F.count_if(is_("accepted") & lost("00")).alias("_b"))
    sound = n.select(F.lit("sound").alias("run"), "source_rows", "accepted", "rejected", "duplicates", F.lit(0).alias("incomplete_files"),
                     F.col("source_rows").alias("raw_rows"), *[F.col("accepted").alias(x) for x in ("staged_rows", "core_rows", "signal_rows", "mart_rows")],
                     F.lit(0).alias("unbalanced_files"), F.lit(0).alias("amount_differences"), F.lit(0).alias("pending_rows"), F.lit(True).alias("caught_up"))
    faulty = n.select(F.lit("faulty").alias("run"), "source_rows", "accepted", "rejected", "duplicates", F.lit(1).alias("incomplete_files"),
                      F.col("source_rows").alias("raw_rows"), (F.col("accepted") - F.col("_a")).alias("staged_rows"),
                      (F.col("accepted") - F.col("_a")).alias("core_rows"), (F.col("accepted") - F.col("_a") - F.col("_b")).alias("signal_rows"),
                      (F.col("accepted") - F.col("_a")).alias("mart_rows"), F.lit(0).alias("unbalanced_files"), F.col("_b").alias("amount_differences"),
                      F.lit(None).cast("int").alias("pending_rows"), F.lit(False).alias("caught_up"))
    return hl.verification(sound.unionByName(faulty), min_source_rows=100, by=["run"])
