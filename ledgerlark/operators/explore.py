"""Descriptive investigation (E1-E8) and dataset profiling.

Input is the modelling ``transactions`` frame (transaction_id, transaction_time,
from_bank, from_account, to_bank, to_account, amount_received, receiving_currency,
amount_paid, payment_currency, payment_format, is_laundering). Amounts are never
added across currencies.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

USD = "US Dollar"


def _blank(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit("")).isNull()


def _share(count: Column, total: Column, digits: int) -> Column:
    """100 * count / total, exact decimal, rounded half-up."""
    return F.round(count.cast("decimal(20,0)") * F.lit(100) / total, digits).cast(f"decimal(20,{digits})")


def period(t: DataFrame) -> DataFrame:
    """Size and observation period."""
    return t.agg(F.count(F.lit(1)).alias("transactions"),
                 F.min("transaction_time").alias("first_seen"),
                 F.max("transaction_time").alias("last_seen"))


def label_balance(t: DataFrame) -> DataFrame:
    """Label counts and share of all rows (total from a 1-row aggregate)."""
    counts = t.groupBy("is_laundering").agg(F.count(F.lit(1)).alias("transactions"))
    total = t.agg(F.count(F.lit(1)).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select("is_laundering", "transactions",
                    _share(F.col("transactions"), F.col("_total"), 4).alias("percentage")))


def missingness(t: DataFrame) -> DataFrame:
    """Missing and invalid values, blank text counts as missing."""
    return t.agg(
        F.count_if(F.col("transaction_time").isNull()).alias("missing_time"),
        F.count_if(_blank("from_bank") | _blank("from_account")).alias("missing_sender"),
        F.count_if(_blank("to_bank") | _blank("to_account")).alias("missing_receiver"),
        F.count_if(F.col("amount_paid").isNull()).alias("missing_paid"),
        F.count_if(F.col("amount_received").isNull()).alias("missing_received"),
        F.count_if(_blank("payment_currency")).alias("missing_paid_currency"),
        F.count_if(_blank("receiving_currency")).alias("missing_received_currency"),
        F.count_if(_blank("payment_format")).alias("missing_format"),
        F.count_if(F.col("is_laundering").isNull() | ~F.col("is_laundering").isin(0, 1)).alias("invalid_label"),
        F.count_if((F.col("amount_paid") < 0) | (F.col("amount_received") < 0)).alias("negative_amounts"),
    )


def currency_totals(t: DataFrame) -> DataFrame:
    """Per payment currency; order by count desc, currency (ties made total)."""
    return (t.groupBy("payment_currency")
            .agg(F.count(F.lit(1)).alias("transactions"),
                 F.min("amount_paid").alias("minimum_paid"),
                 F.round(F.avg("amount_paid"), 2).cast("decimal(38,2)").alias("average_paid"),
                 F.max("amount_paid").alias("maximum_paid"),
                 F.sum("amount_paid").cast("decimal(38,12)").alias("total_paid"))
            .orderBy(F.desc("transactions"), "payment_currency"))


def format_label_rate(t: DataFrame) -> DataFrame:
    """E5: label frequency per payment format."""
    positive = F.count_if(F.col("is_laundering") == 1)
    return (t.groupBy("payment_format")
            .agg(F.count(F.lit(1)).alias("transactions"), positive.alias("labelled_laundering"))
            .withColumn("labelled_pct", _share(F.col("labelled_laundering"), F.col("transactions"), 4))
            .orderBy(F.desc("transactions"), "payment_format"))


def top_usd_senders(t: DataFrame, n: int = 10, currency: str = USD) -> DataFrame:
    """Top senders by paid total with distinct counterparties (the pair is one value)."""
    return (t.filter(F.col("payment_currency") == currency)
            .groupBy("from_bank", "from_account")
            .agg(F.count(F.lit(1)).alias("payments"),
                 F.count_distinct(F.struct("to_bank", "to_account")).alias("distinct_counterparties"),
                 F.sum("amount_paid").cast("decimal(38,12)").alias("total_usd_paid"),
                 F.round(F.avg("amount_paid"), 2).cast("decimal(38,2)").alias("average_usd_paid"))
            .orderBy(F.desc("total_usd_paid"), "from_bank", "from_account")
            .limit(n))


def busiest_hours(t: DataFrame, n: int = 10) -> DataFrame:
    """Busiest sender hours (top-K over a partial aggregate)."""
    hour = F.date_trunc("hour", "transaction_time").cast("timestamp_ntz")
    return (t.groupBy("from_bank", "from_account", hour.alias("activity_hour"))
            .agg(F.count(F.lit(1)).alias("payments"))
            .orderBy(F.desc("payments"), "from_bank", "from_account", "activity_hour")
            .limit(n))


def sender_day_history(t: DataFrame, keys: Sequence[str] = ("from_bank", "from_account"),
                       currency: str | None = USD) -> DataFrame:
    """Daily pre-aggregate, then totals over strictly earlier active days (ROWS frame).

    The window runs on one row per sender-day, so a group is bounded by the calendar.
    """
    keys = list(keys)
    src = t if currency is None else t.filter(F.col("payment_currency") == currency)
    daily = (src.groupBy(*keys, F.to_date("transaction_time").alias("activity_day"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_paid").alias("total")))
    prior = Window.partitionBy(*keys).orderBy("activity_day").rowsBetween(Window.unboundedPreceding, -1)
    return (daily.withColumn("prior_total", F.sum("total").over(prior))
            .withColumn("prior_payments", F.sum("n").over(prior)))


def usd_spikes(t: DataFrame, n: int = 10, min_prior: int = 10, currency: str = USD) -> DataFrame:
    """Payments against the strictly earlier sender-day average; top-K by multiple."""
    h = sender_day_history(t, currency=currency)
    avg = F.try_divide(F.col("prior_total"), F.nullif(F.col("prior_payments"), F.lit(0)))
    h = h.withColumn("prior_day_average", avg).filter(
        (F.col("prior_payments") >= min_prior) & (F.col("prior_day_average") > 0))
    tx = (t.filter(F.col("payment_currency") == currency)
          .withColumn("activity_day", F.to_date("transaction_time")))
    j = tx.join(h.select("from_bank", "from_account", "activity_day", "prior_day_average", "prior_payments"),
                ["from_bank", "from_account", "activity_day"])
    multiple = F.round(F.col("amount_paid") / F.col("prior_day_average"), 2).cast("decimal(38,2)")
    return (j.select("transaction_id", "from_bank", "from_account", "transaction_time", "amount_paid",
                     F.round("prior_day_average", 2).cast("decimal(38,2)").alias("prior_usd_average"),
                     multiple.alias("amount_multiple"), "prior_payments")
            .orderBy(F.desc("amount_multiple"), "transaction_id")
            .limit(n))


# --- Profiling -------------------------------------------------------------------

def column_overview(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: missing, missing %, distinct non-null values.

    Exact distinct counts come from one pre-aggregate of (column, value) pairs, combined map-side; ``exact=False``
    uses HyperLogLog sketches (relative error 5 %) in one pass without a shuffle of values.
    """
    n = df.agg(F.count(F.lit(1)).alias("_rows"))
    if exact:
        pairs = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                                    for i, c in enumerate(df.columns)]))
        values = df.select(pairs.alias("p")).select("p.*").groupBy("position", "column_name", "v").agg(F.count(F.lit(1)).alias("_n"))
        long = values.groupBy("position", "column_name").agg(
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("_n"))), F.lit(0)).alias("missing_values"), F.count("v").alias("unique_values"))
        spine = df.sparkSession.createDataFrame([(i + 1, c) for i, c in enumerate(df.columns)], "position int, column_name string")
        long = spine.join(long, ["position", "column_name"], "left").select(
            "position", "column_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("missing_values", "unique_values")])
    else:
        aggs = [x for i, c in enumerate(df.columns) for x in (F.count_if(F.col(c).isNull()).alias(f"m{i}"), F.approx_count_distinct(c).alias(f"d{i}"))]
        rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing_values"),
                         F.col(f"d{i}").alias("unique_values")) for i, c in enumerate(df.columns)]
        long = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    pct = F.round(F.try_divide(F.col("missing_values").cast("decimal(38,6)") * 100, F.col("_rows")), 2).cast("decimal(10,2)")
    return long.crossJoin(n).select("position", "column_name", "missing_values", pct.alias("missing_pct"), "unique_values")


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of every column (schema only)."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of smallest key (a partial top-n per task)."""
    return df.orderBy(key).limit(n)


_NORMALISE = re.compile(r"[^a-z0-9]+")


def find_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First column whose normalised name matches a candidate (schema-level)."""
    normal = {_NORMALISE.sub("_", c.lower()).strip("_"): c for c in columns}
    for cand in candidates:
        key = _NORMALISE.sub("_", cand.lower()).strip("_")
        if key in normal:
            return normal[key]
    return None


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Value counts with NULL kept, percent of all rows (4 dp)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        label, "count", _share(F.col("count"), F.col("_total"), 4).alias("percent"))


def exact_percentiles(values: DataFrame, col: str, percentiles: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated percentiles without gathering values in one task.

    One row per distinct value with its count, a distributed running count, then the
    values at positions floor/ceil(p * (n - 1)) are picked by a join against a
    len(percentiles)-row table. Returns one row, columns p<percent>.
    """
    from .scale import grouped_cumsum
    spark = values.sparkSession
    counts = values.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_k"))
    cum = grouped_cumsum(counts, [], [col], "_k", "_upto", inclusive=True)
    n = values.agg(F.count(col).alias("_n"))
    wanted = spark.createDataFrame([(i, float(p)) for i, p in enumerate(percentiles)], "i int, p double")
    pos = (wanted.crossJoin(n).withColumn("_pos", F.col("p") * (F.col("_n") - 1))
           .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos"))
           .withColumn("_frac", F.col("_pos") - F.col("_lo")))
    ends = pos.select("i", "_frac", F.explode(F.array(
        F.struct(F.lit("lo").alias("end"), F.col("_lo").alias("at")),
        F.struct(F.lit("hi").alias("end"), F.col("_hi").alias("at")))).alias("e")).select("i", "_frac", "e.*")
    hit = cum.join(F.broadcast(ends), (F.col("at") >= F.col("_upto") - F.col("_k")) & (F.col("at") < F.col("_upto")))
    picked = hit.groupBy("i", "_frac").agg(
        F.max(F.when(F.col("end") == "lo", F.col(col))).alias("_vlo"),
        F.max(F.when(F.col("end") == "hi", F.col(col))).alias("_vhi"))
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    res = picked.select("i", value.alias("v"))
    aggs = [F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"p{int(round(p * 100))}")
            for i, p in enumerate(percentiles)]
    return res.agg(*aggs)


def amount_stats(df: DataFrame, amount: str, percentiles: Sequence[float] = (0.01, 0.5, 0.95, 0.99)) -> DataFrame:
    """I4: count, mean, sample std, min, exact linear percentiles, max; text that is not a number is null."""
    v = df.select(F.col(amount).cast("string").try_cast("double").alias("_x"))
    moments = v.agg(F.count("_x").cast("double").alias("count"), F.avg("_x").alias("mean"),
                    F.stddev_samp("_x").alias("std"), F.min("_x").alias("min"),
                    F.max("_x").alias("max"))
    pct = exact_percentiles(v, "_x", percentiles)
    cols = ["count", "mean", "std", "min", *pct.columns, "max"]
    return moments.crossJoin(pct).select(*cols)
