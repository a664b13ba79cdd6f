"""Published-data exports and reporting measures.

Inputs are the published frames: the daily mart (with sender bank code), the risk
signal, and the row/amount reconciliations. Every measure is an aggregate over
those frames; "selections" of a report are plain filters before the aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- Fixed values: rule labels, identifier words --------------------------------------
RULE_LABELS = (("high_amount_for_currency_day", "High amount"),
               ("high_hourly_velocity", "High hourly velocity"),
               ("repeated_counterparty", "Repeated counterparty"))
IDENTIFIER_WORDS = ("account", "bank", "password", "token", "secret")
# ----------------------------------------------------------------------------------------


def totals(mart: DataFrame) -> DataFrame:
    """H1: published transactions and alerts, 0 when empty."""
    return mart.agg(F.coalesce(F.sum("transaction_count"), F.lit(0)).cast("long").alias("transactions"),
                    F.coalesce(F.sum("risk_alert_count"), F.lit(0)).cast("long").alias("risk_alerts"))


def daily_export(mart: DataFrame, n: int = 5000) -> DataFrame:
    """H2: newest n daily rows (order made total with the format)."""
    return mart.orderBy(F.desc("event_date"), "from_bank", "payment_currency", "payment_format").limit(n)


def alert_export(signal: DataFrame, n: int = 200, alert_score: int = 2) -> DataFrame:
    """H3: top n alerts by score desc, time desc, key (tie-break added)."""
    return (signal.filter(F.col("risk_score") >= alert_score)
            .select("transaction_key", "event_time", "from_bank", "from_account", "to_bank", "to_account",
                    "amount_paid", "payment_currency", "payment_format", "risk_score",
                    "high_amount_for_currency_day", "high_hourly_velocity", "repeated_counterparty")
            .orderBy(F.desc("risk_score"), F.desc("event_time"), "transaction_key").limit(n))


def quality_rollup(row_recon: DataFrame, amount_recon: DataFrame) -> DataFrame:
    """H4: summed manifest counts, unbalanced files and currency groups with a delta."""
    r = row_recon.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a) for c, a in (
        ("manifest_total", "source_rows"), ("manifest_accepted", "accepted_rows"),
        ("manifest_rejected", "rejected_rows"), ("manifest_duplicate_candidates", "duplicate_candidates"))],
        F.count_if(~F.col("is_balanced")).alias("imbalanced_files"))
    a = amount_recon.agg(F.count_if((F.col("raw_staging_delta") != 0) | (F.col("effective_core_delta") != 0))
                         .alias("imbalanced_currency_groups"))
    return r.crossJoin(a)


def snapshot_document(mart: DataFrame, signal: DataFrame, row_recon: DataFrame, amount_recon: DataFrame, publication_id: int | None,
                      daily_rows: int = 5000, alerts: int = 200) -> tuple[DataFrame, dict[str, DataFrame]]:
    """H5: (header, parts) of the snapshot of a publication, for ``documents.write_document``.

    The header is one row: publication, totals, limits and quality counts. Dates are ISO text, amounts exact text.
    """
    if publication_id is None:
        raise ValueError("nothing is published")
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.col(c).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "").alias(c)
    daily = daily_export(mart, daily_rows).select(
        F.col("event_date").cast("string").alias("event_date"), "from_bank", "payment_currency", "payment_format", "transaction_count",
        plain("paid_amount"), "labelled_laundering_count", "risk_alert_count")
    top = alert_export(signal, alerts)
    top = top.select(*[plain(c) if c == "amount_paid" else F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if c == "event_time" else F.col(c)
                       for c in top.columns])
    header = totals(mart).crossJoin(quality_rollup(row_recon, amount_recon)).select(
        F.lit("pipeline_export").alias("kind"), F.lit(publication_id).cast("long").alias("publication_id"), "*",
        F.lit(daily_rows).alias("daily_rows_limit"), F.lit(alerts).alias("risk_alerts_limit"))
    return header, {"daily": daily, "alerts": top}


def daily_with_hits(signal: DataFrame, alert_score: int = 2) -> DataFrame:
    """H6 + H7 from one pass over the signal: counts, alerts, labels and rule hits per date x currency x format."""
    return signal.groupBy("event_date", "payment_currency", "payment_format").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("risk_score") >= alert_score).alias("risk_alert_count"),
        F.count_if(F.col("is_laundering").cast("int") == 1).alias("labelled_laundering_count"),
        F.count_if("high_amount_for_currency_day").alias("amount_hits"),
        F.count_if("high_hourly_velocity").alias("velocity_hits"),
        F.count_if("repeated_counterparty").alias("counterparty_hits"))


def pseudonym(key: Column) -> Column:
    """H9: 'TX-' + the first 12 hex digits of md5(key)."""
    return F.concat(F.lit("TX-"), F.substring(F.md5(key.cast("string")), 1, 12))


def triggered_rules(prefix: str = "") -> Column:
    """Triggered rule names joined by '; ' (nulls skipped)."""
    return F.concat_ws("; ", *[F.when(F.col(prefix + c), F.lit(label)) for c, label in RULE_LABELS])


def alert_sample(signal: DataFrame, n: int = 3, alert_score: int = 2) -> DataFrame:
    """Top n alerts per date x currency by score desc, time, key; pseudonymous detail.

    ``row_number() <= n`` is planned with a partial per-partition group limit, so a
    hot date x currency group is cut to n rows per partition before the shuffle.
    """
    a = signal.filter(F.col("risk_score") >= alert_score)
    w = Window.partitionBy("event_date", "payment_currency").orderBy(
        F.desc("risk_score"), F.asc("event_time"), F.asc("transaction_key"))
    top = a.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= n)
    return top.select(pseudonym(F.col("transaction_key")).alias("reference"), "event_date",
                      F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time_text"),
                      "payment_currency", "payment_format", F.col("amount_paid").cast("string").alias("amount_text"),
                      "risk_score", triggered_rules().alias("triggered_rules"))


def recon_export(amount_recon: DataFrame) -> DataFrame:
    """Exact text amounts, failure count before aggregation, PASS/CHECK."""
    bad = (F.col("raw_staging_delta") != 0) | (F.col("effective_core_delta") != 0)
    return amount_recon.select(
        "file_id", "payment_currency", *[F.col(c).cast("string").alias(c) for c in (
            "raw_original_paid", "staged_original_paid", "expected_current_paid", "core_paid",
            "raw_staging_delta", "effective_core_delta")],
        F.when(bad, 1).otherwise(0).alias("failure_count"),
        F.when(bad, F.lit("CHECK")).otherwise(F.lit("PASS")).alias("status"))


def controls(mart: DataFrame) -> DataFrame:
    """Sums, row count, distinct dates/currencies/formats, date range."""
    return mart.agg(F.sum("transaction_count").cast("long").alias("published_transactions"),
                    F.sum("risk_alert_count").cast("long").alias("alerts"),
                    F.sum("labelled_laundering_count").cast("long").alias("synthetic_labels"),
                    F.count(F.lit(1)).alias("source_daily_rows"),
                    F.count_distinct("event_date").alias("date_count"),
                    F.count_distinct("payment_currency").alias("currencies"),
                    F.count_distinct("payment_format").alias("formats"),
                    F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))


def check_export(daily: DataFrame, ctrl: DataFrame) -> DataFrame:
    """Named export assertions (passed = true)."""
    dup = daily.groupBy("event_date", "payment_currency", "payment_format").count().filter("count > 1") \
        .agg(F.count(F.lit(1)).alias("_dups"))
    tot = daily.agg(F.sum("transaction_count").alias("_t"), F.sum("risk_alert_count").alias("_a"))
    j = dup.crossJoin(tot).crossJoin(ctrl)
    return j.select(F.explode(F.array(
        F.struct(F.lit("unique_grain").alias("check_name"), (F.col("_dups") == 0).alias("passed")),
        F.struct(F.lit("transactions_equal_controls").alias("check_name"),
                 (F.col("_t") == F.col("published_transactions")).alias("passed")),
        F.struct(F.lit("alerts_equal_controls").alias("check_name"), (F.col("_a") == F.col("alerts")).alias("passed"))
    )).alias("c")).select("c.*")


def check_files(row_recon: DataFrame, ctrl: DataFrame) -> DataFrame:
    """The published rows of all files add up to the published transactions."""
    total = row_recon.agg(F.coalesce(F.sum("core_count"), F.lit(0)).alias("_files"))
    return total.crossJoin(ctrl).select(F.lit("files_equal_transactions").alias("check_name"), F.col("_files").eqNullSafe(F.col("published_transactions")).alias("passed"))


def check_sample(sample: DataFrame, mart: DataFrame) -> DataFrame:
    """The sample has no more rows than there are alerts, and no row twice."""
    n = sample.agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("reference").alias("_d"))
    a = mart.agg(F.coalesce(F.sum("risk_alert_count"), F.lit(0)).alias("_a"))
    return n.crossJoin(a).select(F.lit("sample_within_alerts").alias("check_name"), ((F.col("_n") <= F.col("_a")) & (F.col("_n") == F.col("_d"))).alias("passed"))


def check_identifiers(df: DataFrame) -> DataFrame:
    """No column of an export is named after an identifier."""
    return df.limit(1).agg(F.lit(not identifier_columns(df)).alias("passed")).select(F.lit("no_identifier_columns").alias("check_name"), "passed")


def file_measures(row_recon: DataFrame) -> DataFrame:
    """Files, and their source, accepted, rejected, duplicate and published rows."""
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return row_recon.agg(F.count(F.lit(1)).alias("files"), total("manifest_total", "source_rows"), total("manifest_accepted", "accepted_rows"),
                         total("manifest_rejected", "rejected_rows"), total("manifest_duplicate_candidates", "duplicate_candidates"),
                         total("core_count", "published_rows"))


def calendar(daily: DataFrame) -> DataFrame:
    """Continuous calendar from the first to the last date."""
    r = daily.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return r.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("calendar_date")) \
        .select("calendar_date", F.year("calendar_date").alias("year"), F.month("calendar_date").alias("month"),
                F.dayofmonth("calendar_date").alias("day"),
                F.date_format("calendar_date", "EEEE").alias("weekday_name"))


def measures(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Additive measures and the safe alert rate."""
    g = df.groupBy(*by) if by else df.groupBy()
    m = g.agg(F.sum("transaction_count").cast("long").alias("transactions"),
              F.sum("risk_alert_count").cast("long").alias("alerts"),
              F.sum("labelled_laundering_count").cast("long").alias("labels"),
              F.sum("amount_hits").cast("long").alias("amount_hits"),
              F.sum("velocity_hits").cast("long").alias("velocity_hits"),
              F.sum("counterparty_hits").cast("long").alias("counterparty_hits"))
    return m.withColumn("alert_rate", F.try_divide(F.col("alerts").cast("double"), F.nullif(F.col("transactions"), F.lit(0))))


def daily_change(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Previous calendar day value, change and % change (self join on date + 1, so a
    missing day gives null instead of the previous row)."""
    by = list(by)
    cur = daily.groupBy("event_date", *by).agg(F.sum("transaction_count").cast("long").alias("transactions"))
    prev = cur.select((F.date_add("event_date", 1)).alias("event_date"), *by,
                      F.col("transactions").alias("previous_day_transactions"))
    j = cur.join(prev, ["event_date", *by], "left")
    return j.select("event_date", *by, "transactions", "previous_day_transactions",
                    (F.col("transactions") - F.col("previous_day_transactions")).alias("change"),
                    F.try_divide((F.col("transactions") - F.col("previous_day_transactions")).cast("double"),
                                 F.nullif(F.col("previous_day_transactions"), F.lit(0))).alias("pct_change"))


def format_share(daily: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Each format's share of transactions within the selected formats."""
    d = daily if formats is None else daily.filter(F.col("payment_format").isin(*formats))
    per = d.groupBy("payment_format").agg(F.sum("transaction_count").cast("long").alias("transactions"))
    tot = d.agg(F.sum("transaction_count").alias("_total"))
    return per.crossJoin(F.broadcast(tot)).select(
        "payment_format", "transactions", F.try_divide(F.col("transactions").cast("double"), F.col("_total")).alias("share"))


def rule_hits_by_selector(daily_hits: DataFrame) -> DataFrame:
    """Hits per rule in long form (overlapping; never summed across rules)."""
    return daily_hits.select(F.expr(
        "stack(3, 'High amount', amount_hits, 'High hourly velocity', velocity_hits, "
        "'Repeated counterparty', counterparty_hits) AS (rule, hits)")).groupBy("rule").agg(
        F.sum("hits").cast("long").alias("hits"))


def row_balance(row_recon: DataFrame) -> DataFrame:
    """Row balance variance (source - published) and reconciliation failures."""
    return row_recon.agg((F.sum("manifest_accepted") - F.sum("core_count")).cast("long").alias("row_balance_variance"),
                         F.count_if(~F.col("is_balanced")).alias("reconciliation_failures"))


def quality_status(row_recon: DataFrame, amount_recon: DataFrame) -> DataFrame:
    """NO DATA / PASS / CHECK (currency selection ignored)."""
    r = row_recon.agg(F.count(F.lit(1)).alias("_files"), F.count_if(~F.col("is_balanced")).alias("_bad_rows"))
    a = amount_recon.agg(F.count_if((F.col("raw_staging_delta") != 0) | (F.col("effective_core_delta") != 0))
                         .alias("_bad_amounts"))
    j = r.crossJoin(a)
    return j.select(F.when(F.col("_files") == 0, F.lit("NO DATA"))
                    .when((F.col("_bad_rows") + F.col("_bad_amounts")) == 0, F.lit("PASS"))
                    .otherwise(F.lit("CHECK")).alias("quality_status"))


def alert_quality(evaluation: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Alert precision (labelled alerts / alerts) and label recall (labelled alerts / labels)."""
    g = evaluation.groupBy(*by) if by else evaluation.groupBy()
    s = g.agg(F.sum("risk_alerts").alias("alerts"), F.sum("labelled_alerts").alias("labelled_alerts"),
              F.sum("labelled_transactions").alias("labels"))
    return s.select(*by, "alerts", "labelled_alerts", "labels",
                    F.try_divide(F.col("labelled_alerts").cast("double"), F.nullif("alerts", F.lit(0))).alias("alert_precision"),
                    F.try_divide(F.col("labelled_alerts").cast("double"), F.nullif("labels", F.lit(0))).alias("label_recall"))


def captions(daily: DataFrame, sample_rows: int, publication_id: int | None, published_at: str | None = None) -> DataFrame:
    """The sample size beside the full alert workload, the publication with its time (UTC), the selected period."""
    r = daily.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"),
                  F.coalesce(F.sum("risk_alert_count"), F.lit(0)).cast("long").alias("alerts"))
    pub = F.lit(None if publication_id is None else f"Publication {publication_id} | {published_at or ''} | static verified snapshot")
    day = lambda c: F.date_format(c, "dd MMM yyyy")
    return r.select(F.concat(F.lit("Illustrative sample: "), F.format_number(F.lit(sample_rows), 0),
                             F.lit(" rows in the current context. Full alert workload is "), F.format_number("alerts", 0), F.lit("."))
                    .alias("sample_note"), F.coalesce(pub.cast("string"), F.lit("Not published")).alias("publication_text"),
                    F.when(F.col("lo").isNull(), F.lit("No dates selected")).otherwise(F.concat(day("lo"), F.lit(" to "), day("hi")))
                    .alias("period_text"))


def selection(daily_hits: DataFrame, date: str | None = None, currency: str | None = None,
              fmt: str | None = None) -> DataFrame:
    """Totals and rate under a (date, currency, format) selection; empty -> null rate."""
    d = daily_hits
    if date:
        d = d.filter(F.col("event_date") == F.lit(date).cast("date"))
    if currency:
        d = d.filter(F.col("payment_currency") == currency)
    if fmt:
        d = d.filter(F.col("payment_format") == fmt)
    return measures(d)


def currency_leaders(daily: DataFrame) -> DataFrame:
    """The currency with the most alerts and the one with the highest alert rate (ties: the first name)."""
    per = daily.groupBy("payment_currency").agg(F.sum("transaction_count").alias("t"), F.sum("risk_alert_count").alias("a"))
    per = per.withColumn("rate", F.try_divide(F.col("a").cast("double"), F.nullif("t", F.lit(0))))
    best = lambda c: F.min_by("payment_currency", F.struct((-F.col(c)).alias("v"), "payment_currency"))
    return per.filter("rate is not null").agg(best("a").alias("most_alerts"), best("rate").alias("highest_alert_rate"))


def rule_bounds_violations(daily_hits: DataFrame) -> DataFrame:
    """Rows where alerts fall outside [max, sum] of the two 2-point rule hit counts, or where alerts or
    any rule's hits fall outside [0, transactions]."""
    hi = F.col("amount_hits") + F.col("velocity_hits")
    lo = F.greatest("amount_hits", "velocity_hits")
    n = F.col("transaction_count")
    most = F.greatest("risk_alert_count", "amount_hits", "velocity_hits", "counterparty_hits")
    least = F.least("risk_alert_count", "amount_hits", "velocity_hits", "counterparty_hits")
    return daily_hits.filter((F.col("risk_alert_count") < lo) | (F.col("risk_alert_count") > hi) | (most > n) | (least < 0))


def identifier_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains an identifier word (an identifier-free export has none)."""
    pat = re.compile("|".join(IDENTIFIER_WORDS), re.IGNORECASE)
    return [c for c in df.columns if pat.search(c)]


def recent_days(daily: DataFrame, n: int = 20, currency: str | None = None) -> DataFrame:
    """The last n days of counts (optionally one currency), oldest first."""
    d = daily if currency is None else daily.filter(F.col("payment_currency") == currency)
    per = d.groupBy("event_date").agg(F.sum("transaction_count").cast("long").alias("transactions"),
                                      F.sum("risk_alert_count").cast("long").alias("alerts"))
    return per.orderBy(F.desc("event_date")).limit(n).orderBy("event_date")
