"""Promotion set operators: raw -> staging -> bank/account dims -> fact, corrections.

Everything is a set operation on DataFrames. Windows over IDs count candidates per ID bin
and order only the bin at the cut; latest-correction is a partial
``max_by`` aggregate per target (no sort, skew-safe); dimension keys are dense
numbers after the current maximum, assigned with the distributed ID helper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import contract
from ..session import ensure_checkpoint_dir
from .scale import assign_ids, running_max_before

FACT_VALUE_COLS = ("event_time", "from_account_key", "to_account_key", "amount_received", "receiving_currency",
                   "amount_paid", "payment_currency", "payment_format", "is_laundering")


ID_BIN = 1 << 20


def last_of_first(ids: DataFrame, col: str, limit: int | None, bin_size: int = ID_BIN) -> DataFrame:
    """One row ``last``: the largest of the ``limit`` smallest IDs (unique), null if there are none.

    IDs are counted per bin, so that only the bin at the cut, of at most ``bin_size`` IDs, is put in order.
    """
    if limit is None:
        return ids.agg(F.max(col).alias("last"))
    binned = ids.select(F.col(col).alias("_id"), F.floor(F.col(col) / F.lit(bin_size)).alias("_bin"))
    upto = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per bin
    bins = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    cut = bins.filter(F.col("_upto") - F.col("_n") < limit).agg(
        F.max_by(F.struct("_bin", (F.lit(limit) - F.col("_upto") + F.col("_n")).alias("_rest")), "_bin").alias("_c")).select("_c.*")
    inside = binned.join(F.broadcast(cut), "_bin").withColumn("_k", F.row_number().over(Window.orderBy("_id")))
    return inside.filter(F.col("_k") <= F.col("_rest")).agg(F.max("_id").alias("last"))


def raw_window(raw: DataFrame, after: int, limit: int | None) -> DataFrame:
    """B1: (raw_after, raw_through): the next ``limit`` accepted IDs above the cursor."""
    cand = raw.filter((F.col("validation_status") == C.ACCEPTED) & (F.col("raw_record_id") > after))
    return last_of_first(cand, "raw_record_id", limit).select(
        F.lit(after).cast("long").alias("raw_after"), F.coalesce("last", F.lit(after)).cast("long").alias("raw_through"))


def correction_window(corrections: DataFrame, fact: DataFrame, after: int, raw_through: Column | int,
                      limit: int | None) -> DataFrame:
    """B2: corrections above the cursor, stopping before the first one whose target is
    beyond the raw window and not yet in the fact."""
    rt = raw_through if isinstance(raw_through, Column) else F.lit(raw_through)
    pending = corrections.filter(F.col("correction_id") > after)
    blocked = (pending.filter(F.col("target_raw_record_id") > rt)
               .join(fact.select(F.col("source_raw_record_id").alias("target_raw_record_id")),
                     "target_raw_record_id", "left_anti")
               .agg(F.min("correction_id").alias("first_blocked")))
    cand = pending.crossJoin(F.broadcast(blocked)).filter(
        F.col("first_blocked").isNull() | (F.col("correction_id") < F.col("first_blocked")))
    return last_of_first(cand, "correction_id", limit).select(
        F.lit(after).cast("long").alias("correction_after"), F.coalesce("last", F.lit(after)).cast("long").alias("correction_through"))


def in_range(col: str, lo: int, hi: int) -> Column:
    """Half-open ID range (lo, hi]."""
    return (F.col(col) > lo) & (F.col(col) <= hi)


def check_backfill(after: int, through: int, available_max: int) -> None:
    """Negative, inverted or beyond-max ranges raise."""
    if after < 0 or through < after:
        raise ValueError("invalid backfill range")
    if through > available_max:
        raise ValueError("backfill range exceeds available source IDs")


def stage(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Typed staging rows from accepted raw payloads; idempotent by raw ID."""
    acc = raw.filter(F.col("validation_status") == C.ACCEPTED)
    typed = acc.select("raw_record_id", F.col("file_id").alias("source_file_id"),
                       *contract.typed_columns(F.col("payload")), "record_hash")
    if existing is not None:
        typed = typed.join(existing.select("raw_record_id"), "raw_record_id", "left_anti")
    return typed


def stage_corrections(corr_raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Typed correction rows; idempotent by correction ID."""
    typed = corr_raw.select("correction_id", "target_raw_record_id", *contract.typed_columns(F.col("payload")))
    if existing is not None:
        typed = typed.join(existing.select("correction_id"), "correction_id", "left_anti")
    return typed


def upsert_banks(dim: DataFrame | None, staged: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """New bank codes from both sides of both inputs; existing keys never change.
    Returns only the new rows (bank_key, bank_code)."""
    codes = staged.select(F.col("from_bank_code").alias("bank_code")).unionByName(
        staged.select(F.col("to_bank_code").alias("bank_code")))
    if corrections is not None:
        codes = codes.unionByName(corrections.select(F.col("from_bank_code").alias("bank_code"))) \
            .unionByName(corrections.select(F.col("to_bank_code").alias("bank_code")))
    new = codes.distinct()
    start = 0
    if dim is not None:
        new = new.join(dim.select("bank_code"), "bank_code", "left_anti")
        start = dim.agg(F.coalesce(F.max("bank_key"), F.lit(0))).collect()[0][0]
    return assign_ids(new, ["bank_code"], "bank_key", start).select("bank_key", "bank_code")


def upsert_accounts(dim: DataFrame | None, banks: DataFrame, staged: DataFrame,
                    corrections: DataFrame | None = None) -> DataFrame:
    """New (bank_key, account_code) pairs; returns the new rows."""
    def sides(df: DataFrame) -> DataFrame:
        return df.select(F.col("from_bank_code").alias("bank_code"), F.col("from_account_code").alias("account_code")) \
            .unionByName(df.select(F.col("to_bank_code").alias("bank_code"), F.col("to_account_code").alias("account_code")))
    pairs = sides(staged)
    if corrections is not None:
        pairs = pairs.unionByName(sides(corrections))
    keyed = pairs.distinct().join(banks, "bank_code").select("bank_key", "bank_code", "account_code")
    start = 0
    if dim is not None:
        keyed = keyed.join(dim.select("bank_key", "account_code"), ["bank_key", "account_code"], "left_anti")
        start = dim.agg(F.coalesce(F.max("account_key"), F.lit(0))).collect()[0][0]
    return assign_ids(keyed, ["bank_code", "account_code"], "account_key", start) \
        .select("account_key", "bank_key", "account_code")


def account_lookup(banks: DataFrame, accounts: DataFrame) -> DataFrame:
    """(bank_code, account_code) -> account_key; pinned once, as every side of fact and corrections reads it."""
    ensure_checkpoint_dir(accounts.sparkSession)
    return accounts.join(banks, "bank_key").select("bank_code", "account_code", "account_key").checkpoint(eager=True)


def with_account_keys(df: DataFrame, banks: DataFrame, accounts: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Map both sides' (bank, account) codes to account keys (4 equi joins collapse to 2)."""
    lk = account_lookup(banks, accounts) if lookup is None else lookup
    f = lk.select(F.col("bank_code").alias("from_bank_code"), F.col("account_code").alias("from_account_code"),
                  F.col("account_key").alias("from_account_key"))
    t = lk.select(F.col("bank_code").alias("to_bank_code"), F.col("account_code").alias("to_account_code"),
                  F.col("account_key").alias("to_account_key"))
    return df.join(f, ["from_bank_code", "from_account_code"]).join(t, ["to_bank_code", "to_account_code"])


def insert_fact(staged: DataFrame, banks: DataFrame, accounts: DataFrame,
                existing: DataFrame | None = None) -> DataFrame:
    """Fact rows for staged records not yet in the fact (current_correction_id null)."""
    k = with_account_keys(staged, banks, accounts)
    rows = k.select(F.col("raw_record_id").alias("source_raw_record_id"), "source_file_id", "event_time",
                    "from_account_key", "to_account_key", "amount_received", "receiving_currency",
                    "amount_paid", "payment_currency", "payment_format", "is_laundering",
                    F.lit(None).cast("long").alias("current_correction_id"))
    if existing is not None:
        rows = rows.join(existing.select("source_raw_record_id"), "source_raw_record_id", "left_anti")
    return rows


def orphan_corrections(corrections: DataFrame, fact: DataFrame) -> DataFrame:
    """Corrections whose target has no fact row."""
    return corrections.join(fact.select(F.col("source_raw_record_id").alias("target_raw_record_id")),
                            "target_raw_record_id", "left_anti")


def latest_correction(corrections: DataFrame) -> DataFrame:
    """The highest correction ID per target (partial max_by aggregate, no sort)."""
    cols = [c for c in corrections.columns if c != "target_raw_record_id"]
    return (corrections.groupBy("target_raw_record_id")
            .agg(F.max_by(F.struct(*cols), F.col("correction_id")).alias("_l"))
            .select("target_raw_record_id", "_l.*"))


def apply_corrections(fact: DataFrame, latest_keyed: DataFrame) -> DataFrame:
    """Replace the 9 value columns where current is null or older than the correction.

    ``latest_keyed`` has target_raw_record_id, correction_id and the 9 values (account keys).
    A replay of an older correction is a no-op. Returns the whole fact (touched rows rewritten).
    """
    lk = latest_keyed.select(F.col("target_raw_record_id").alias("source_raw_record_id"),
                             F.col("correction_id").alias("_cid"),
                             *[F.col(c).alias(f"_n_{c}") for c in FACT_VALUE_COLS])
    j = fact.join(lk, "source_raw_record_id", "left")
    newer = F.col("_cid").isNotNull() & (F.col("current_correction_id").isNull()
                                         | (F.col("current_correction_id") < F.col("_cid")))
    out = [F.when(newer, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in FACT_VALUE_COLS else F.col(c)
           for c in fact.columns if c != "current_correction_id"]
    out.append(F.when(newer, F.col("_cid")).otherwise(F.col("current_correction_id")).alias("current_correction_id"))
    return j.select(*out)


def late_rows_by_batch(staged: DataFrame, batch_size: int) -> DataFrame:
    """B15 for a sequence of ID-ordered batches: late rows per batch against the running
    max event time of all earlier batches (a running maximum over range slices)."""
    b = staged.withColumn("batch", F.floor((F.col("raw_record_id") - 1) / batch_size).cast("long"))
    per = b.groupBy("batch").agg(F.max("event_time").alias("_bmax"))
    wm = running_max_before(per, "batch", "_bmax", "watermark").select("batch", "watermark")
    return (b.join(wm, "batch").groupBy("batch")
            .agg(F.count(F.lit(1)).alias("staged_rows"),
                 F.count_if(F.col("event_time") < F.col("watermark")).alias("late_arriving_rows")))


def advance_state(staged: DataFrame, corrections: DataFrame, prior_max_event: Column | None = None) -> DataFrame:
    """New cursors and the NULL-ignoring greatest event time including corrections."""
    ev = staged.select("event_time").unionByName(corrections.select("event_time"))
    new_max = ev.agg(F.max("event_time").alias("_m"))
    cur = staged.agg(F.max("raw_record_id").alias("last_raw_record_id")) \
        .crossJoin(corrections.agg(F.max("correction_id").alias("last_correction_id")))
    pm = prior_max_event if prior_max_event is not None else F.lit(None).cast("timestamp_ntz")
    return cur.crossJoin(new_max).select("last_raw_record_id", "last_correction_id",
                                         F.greatest(pm, F.col("_m")).alias("max_event_time"))
