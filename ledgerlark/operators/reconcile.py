"""Reconciliation, publication gates, published views and data tests.

Each side is pre-aggregated by file (or file x currency) before it is joined, so
the joins run on small per-file tables instead of the row-level left joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


def row_reconciliation(manifest: DataFrame, raw: DataFrame, staged: DataFrame, fact: DataFrame,
                       files: DataFrame) -> DataFrame:
    """C14: per affected file: manifest vs raw vs staging vs core counts; a file with no
    raw rows still appears; is_balanced is the AND of the six equalities."""
    s = F.col("validation_status")
    wanted = files.select("file_id").distinct()
    of_files = lambda df, c: df.join(wanted.withColumnRenamed("file_id", c), c, "left_semi")
    raw, staged, fact = of_files(raw, "file_id"), of_files(staged, "source_file_id"), of_files(fact, "source_file_id")
    raw_c = raw.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("raw_total"), F.count_if(s == C.ACCEPTED).alias("raw_accepted"),
        F.count_if(s == C.REJECTED).alias("raw_rejected"),
        F.count_if(s == C.DUPLICATE).alias("raw_duplicate_candidates"))
    stg_c = staged.groupBy(F.col("source_file_id").alias("file_id")).agg(F.count(F.lit(1)).alias("staged_count"))
    core_c = fact.groupBy(F.col("source_file_id").alias("file_id")).agg(F.count(F.lit(1)).alias("core_count"))
    m = manifest.join(files.select("file_id").distinct(), "file_id").select(
        "file_id", F.col("total_rows").alias("manifest_total"), F.col("accepted_rows").alias("manifest_accepted"),
        F.col("rejected_rows").alias("manifest_rejected"),
        F.col("duplicate_candidates").alias("manifest_duplicate_candidates"))
    j = m.join(raw_c, "file_id", "left").join(stg_c, "file_id", "left").join(core_c, "file_id", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    j = j.select("file_id", "manifest_total", "manifest_accepted", "manifest_rejected",
                 "manifest_duplicate_candidates", z("raw_total"), z("raw_accepted"), z("raw_rejected"),
                 z("raw_duplicate_candidates"), z("staged_count"), z("core_count"))
    # null-safe: a file without manifest counts (it never completed) is not balanced
    bal = F.lit(True)
    for a, b in (("manifest_total", "raw_total"), ("manifest_accepted", "raw_accepted"), ("manifest_rejected", "raw_rejected"),
                 ("manifest_duplicate_candidates", "raw_duplicate_candidates"), ("raw_accepted", "staged_count"),
                 ("staged_count", "core_count")):
        bal = bal & F.col(a).eqNullSafe(F.col(b))
    return j.withColumn("is_balanced", bal)


def expected_current(staged: DataFrame, latest: DataFrame) -> DataFrame:
    """Each staged row with its latest correction's currency and amount, else its own."""
    lc = latest.select(F.col("target_raw_record_id").alias("raw_record_id"),
                       F.col("payment_currency").alias("_c_cur"), F.col("amount_paid").alias("_c_amt"))
    return staged.join(lc, "raw_record_id", "left").select(
        "source_file_id", F.coalesce("_c_cur", "payment_currency").alias("payment_currency"),
        F.coalesce("_c_amt", "amount_paid").alias("amount_paid"))


def amount_reconciliation(raw_accepted: DataFrame, staged: DataFrame, latest: DataFrame, fact: DataFrame,
                          files: DataFrame) -> DataFrame:
    """Per file x currency: raw original, staged original, expected current (latest
    correction else staged, by corrected currency), core; two deltas. Amounts never cross
    currencies: every portion is keyed by its own currency."""
    dec = "decimal(38,6)"
    fs = files.select("file_id").distinct()
    zero = F.lit(0).cast(dec)

    def portion(df: DataFrame, file_col: str, cur_col: str, amt, slot: int) -> DataFrame:
        vals = [zero] * 4
        vals[slot] = F.sum(amt).cast(dec)
        names = ["raw_original_paid", "staged_original_paid", "expected_current_paid", "core_paid"]
        return (df.join(fs, df[file_col] == fs["file_id"], "left_semi")
                .groupBy(F.col(file_col).alias("file_id"), F.col(cur_col).alias("payment_currency"))
                .agg(*[v.alias(n) for v, n in zip(vals, names)]))

    parts = [
        portion(raw_accepted, "file_id", "payment_currency", F.col("amount_paid").cast(dec), 0),
        portion(staged, "source_file_id", "payment_currency", F.col("amount_paid"), 1),
        portion(expected_current(staged, latest), "source_file_id", "payment_currency", F.col("amount_paid"), 2),
        portion(fact, "source_file_id", "payment_currency", F.col("amount_paid"), 3),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    t = u.groupBy("file_id", "payment_currency").agg(
        *[F.sum(c).cast(dec).alias(c) for c in ("raw_original_paid", "staged_original_paid",
                                                "expected_current_paid", "core_paid")])
    return t.select("*", (F.col("raw_original_paid") - F.col("staged_original_paid")).cast(dec).alias("raw_staging_delta"),
                    (F.col("expected_current_paid") - F.col("core_paid")).cast(dec).alias("effective_core_delta"))


def quality_gate(manifest: DataFrame, files: DataFrame, max_rejected_fraction: float = 0.05) -> DataFrame:
    """C17 (policy part): rejected/total per affected file and whether it passes (strictly greater fails)."""
    m = manifest.join(files.select("file_id").distinct(), "file_id")
    frac = F.when(F.col("total_rows") > 0, F.col("rejected_rows").cast("decimal(38,10)") / F.col("total_rows"))
    return m.select("file_id", "total_rows", "rejected_rows", frac.cast("decimal(20,10)").alias("rejected_fraction"),
                    (~F.coalesce(frac > F.lit(max_rejected_fraction), F.lit(False))).alias("passes_quality_policy"))


def gate_failures(row_recon: DataFrame, amount_recon: DataFrame, quality: DataFrame) -> DataFrame:
    """C17: named failing gates (empty frame = publish may proceed)."""
    a = row_recon.filter(~F.coalesce("is_balanced", F.lit(False))).select(F.lit("row reconciliation failed").alias("gate"), "file_id")
    b = amount_recon.filter((F.col("raw_staging_delta") != 0) | (F.col("effective_core_delta") != 0)) \
        .select(F.lit("amount reconciliation failed").alias("gate"), "file_id")
    c = quality.filter(~F.col("passes_quality_policy")) \
        .select(F.lit("rejected-row fraction exceeds quality policy").alias("gate"), "file_id")
    return a.unionByName(b).unionByName(c)


def currency_diff(fact: DataFrame, mart: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """C20: core vs mart amount per currency, FULL JOIN with 0 for a missing side."""
    f = fact.withColumn("event_date", F.to_date("event_time"))
    if days is not None:
        f = f.join(days, "event_date", "left_semi")
    core = f.groupBy("payment_currency").agg(F.sum("amount_paid").cast("decimal(38,6)").alias("core_paid"),
                                             F.count(F.lit(1)).alias("core_rows"))
    mt = mart.groupBy("payment_currency").agg(F.sum("paid_amount").cast("decimal(38,6)").alias("mart_paid"),
                                              F.sum("transaction_count").alias("mart_rows"))
    j = core.join(mt, "payment_currency", "full")
    z = F.lit(0).cast("decimal(38,6)")
    return j.select("payment_currency", F.coalesce("core_paid", z).alias("core_paid"),
                    F.coalesce("mart_paid", z).alias("mart_paid"),
                    F.coalesce("core_rows", F.lit(0)).alias("core_rows"),
                    F.coalesce("mart_rows", F.lit(0)).cast("long").alias("mart_rows"),
                    (F.coalesce("core_paid", z) - F.coalesce("mart_paid", z)).cast("decimal(38,6)").alias("amount_delta"))


# --- views ---------------------------------------------------------------------------

def daily_metrics(mart: DataFrame, banks: DataFrame) -> DataFrame:
    """Mart with the sender bank code."""
    return mart.join(banks, mart["from_bank_key"] == banks["bank_key"]).drop("bank_key")


def risk_alerts(signal: DataFrame, alert_score: int = 2) -> DataFrame:
    """Published transactions at or above the alert score."""
    return signal.filter(F.col("risk_score") >= alert_score)


def risk_evaluation(signal: DataFrame, alert_score: int = 2) -> DataFrame:
    """Per date x currency: transactions, labels, alerts, labelled/unlabelled alerts, missed labels."""
    lab = F.col("is_laundering").cast("int") == 1
    alert = F.col("risk_score") >= alert_score
    return signal.groupBy("event_date", "payment_currency").agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if(lab).alias("labelled_transactions"),
        F.count_if(alert).alias("risk_alerts"), F.count_if(alert & lab).alias("labelled_alerts"),
        F.count_if(alert & ~lab).alias("unlabelled_alerts"), F.count_if(~alert & lab).alias("missed_labels"))


# --- data tests ------------------------------------------------------------------------

def check_unique(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Number of key values that occur more than once."""
    d = df.groupBy(*cols).count().filter(F.col("count") > 1)
    return d.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def check_not_null(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col).isNull()).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def check_accepted(df: DataFrame, col: str, values: Sequence, name: str) -> DataFrame:
    """Rows whose non-null value is not among ``values``."""
    return df.agg(F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(values))).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def check_holds(df: DataFrame, condition, name: str) -> DataFrame:
    """Rows for which ``condition`` is false or null."""
    return df.agg(F.count_if(~F.coalesce(condition, F.lit(False))).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def check_fk(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, name: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    c = child.filter(F.col(child_col).isNotNull()).select(F.col(child_col).alias("_k"))
    orphans = c.join(parent.select(F.col(parent_col).alias("_k")), "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def check_counts_equal(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """One failure when two scalar counts differ."""
    differ = F.when(~F.col("_a").eqNullSafe(F.col("_b")), 1).otherwise(0).cast("long")
    return a.toDF("_a").crossJoin(b.toDF("_b")).select(F.lit(name).alias("check_name"), differ.alias("failures"))


def evaluation_diff(evaluation: DataFrame, signal: DataFrame, alert_score: int = 2) -> DataFrame:
    """The evaluation view against counts recomputed from the signal (FULL JOIN, 5 inequalities)."""
    re = risk_evaluation(signal, alert_score).select(
        "event_date", "payment_currency", *[F.col(c).alias(f"r_{c}") for c in
                                             ("transactions", "labelled_transactions", "risk_alerts",
                                              "labelled_alerts", "unlabelled_alerts")])
    j = evaluation.join(re, ["event_date", "payment_currency"], "full")
    neg = F.lit(-1)
    bad = ((F.coalesce("transactions", neg) != F.coalesce("r_transactions", neg))
           | (F.coalesce("labelled_transactions", neg) != F.coalesce("r_labelled_transactions", neg))
           | (F.coalesce("risk_alerts", neg) != F.coalesce("r_risk_alerts", neg))
           | (F.coalesce("labelled_alerts", neg) != F.coalesce("r_labelled_alerts", neg))
           | (F.coalesce("risk_alerts", neg) != F.coalesce("labelled_alerts", neg) + F.coalesce("unlabelled_alerts", neg)))
    return j.filter(bad)
