"""Transparent risk rules (C7-C12) and the daily mart.

Input is a fact frame with: transaction_key, event_time, from_bank, from_account,
to_bank, to_account, amount_paid, payment_currency, payment_format, is_laundering.
Account identity is always the (bank, account) pair.

Plan shape: the three per-row counts are partial aggregates joined back on their
keys (map-side combine, and AQE can split a hot account on the join) instead of
windows, which would put a whole hot group into one task. The amount percent
rank is computed from one row per distinct amount with a distributed running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RiskConfig
from .scale import grouped_cumsum


def event_date(col: str = "event_time") -> Column:
    return F.to_date(F.col(col))


def event_hour(col: str = "event_time") -> Column:
    return F.date_trunc("hour", F.col(col)).cast("timestamp_ntz")


def with_event_date(fact: DataFrame) -> DataFrame:
    return fact.withColumn("event_date", event_date())


def hourly_velocity(fact: DataFrame) -> DataFrame:
    """Payments per (date, sender, hour, currency)."""
    keys = ["event_date", "from_bank", "from_account", "activity_hour", "payment_currency"]
    return (fact.withColumn("activity_hour", event_hour())
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("hourly_outgoing_count")))


def counterparty_count(fact: DataFrame) -> DataFrame:
    """Payments per (date, sender, receiver, currency)."""
    keys = ["event_date", "from_bank", "from_account", "to_bank", "to_account", "payment_currency"]
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("daily_counterparty_count"))


def currency_day_count(fact: DataFrame) -> DataFrame:
    """Payments per (date, currency); a small table (dates x currencies)."""
    return fact.groupBy("event_date", "payment_currency").agg(
        F.count(F.lit(1)).alias("currency_day_count"))


def amount_percent_rank(fact: DataFrame) -> DataFrame:
    """percent_rank of amount_paid within (date, currency), one row per distinct amount.

    percent_rank = rows with a smaller amount / (n - 1); ties share the low rank.
    """
    per_amount = fact.groupBy("event_date", "payment_currency", "amount_paid").agg(
        F.count(F.lit(1)).alias("_rows"))
    below = grouped_cumsum(per_amount, ["event_date", "payment_currency"], ["amount_paid"],
                           "_rows", "_below", inclusive=False)
    n = currency_day_count(fact)
    pr = F.when(F.col("currency_day_count") > 1,
                F.col("_below").cast("double") / (F.col("currency_day_count") - 1).cast("double")
                ).otherwise(F.lit(0.0))
    return (below.join(n, ["event_date", "payment_currency"])
            .select("event_date", "payment_currency", "amount_paid", "currency_day_count",
                    pr.alias("amount_percent_rank")))


def high_amount_cutoff(fact: DataFrame, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """C10/C11 as one number per date x currency: percent_rank grows with the amount, so the high-amount
    rule holds exactly from the smallest amount that reaches it. Groups that are too small have no row."""
    ranks = amount_percent_rank(fact).filter(
        (F.col("currency_day_count") >= cfg.high_amount_min_rows)
        & (F.col("amount_percent_rank") >= cfg.high_amount_percent_rank))
    return ranks.groupBy("event_date", "payment_currency").agg(F.min("amount_paid").alias("_cutoff"))


def risk_signal(fact: DataFrame, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """Rule flags and 0..5 score per transaction. The label is carried, never used."""
    base = with_event_date(fact)
    f = base.withColumn("activity_hour", event_hour())
    hourly = hourly_velocity(base)
    pair = counterparty_count(base)
    cutoff = high_amount_cutoff(base, cfg)
    joined = (f.join(hourly, ["event_date", "from_bank", "from_account", "activity_hour", "payment_currency"])
               .join(pair, ["event_date", "from_bank", "from_account", "to_bank", "to_account", "payment_currency"])
               .join(cutoff, ["event_date", "payment_currency"], "left"))
    high_amount = F.coalesce(F.col("amount_paid") >= F.col("_cutoff"), F.lit(False))
    velocity = F.col("hourly_outgoing_count") >= cfg.velocity_min
    repeat = F.col("daily_counterparty_count") >= cfg.counterparty_min
    score = (F.when(high_amount, cfg.high_amount_points).otherwise(0)
             + F.when(velocity, cfg.velocity_points).otherwise(0)
             + F.when(repeat, cfg.counterparty_points).otherwise(0)).cast("short")
    keep = [c for c in fact.columns if c not in ("event_time",)]
    return joined.select(
        *keep, "event_time", "event_date", "activity_hour",
        high_amount.alias("high_amount_for_currency_day"),
        velocity.alias("high_hourly_velocity"),
        repeat.alias("repeated_counterparty"),
        score.alias("risk_score"),
    )


def daily_mart(signal: DataFrame, cfg: RiskConfig = RiskConfig(),
               bank_col: str = "from_bank") -> DataFrame:
    """Date x sender bank x currency x format: count, amount, labels, alerts."""
    label = F.col("is_laundering").cast("int") == 1
    return (signal.groupBy("event_date", bank_col, "payment_currency", "payment_format")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 F.sum("amount_paid").cast("decimal(38,6)").alias("paid_amount"),
                 F.count_if(label).alias("labelled_laundering_count"),
                 F.count_if(F.col("risk_score") >= cfg.alert_score).alias("risk_alert_count")))
