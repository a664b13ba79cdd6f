"""Point-in-time features, numeric transforms, split, standardisation, vocabularies.

Features use strictly earlier calendar days of the same sender and currency: the
history window runs on one row per sender-currency-day (bounded by the calendar),
then joins back to the transactions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .scale import grouped_cumsum

SENDER = ("from_bank", "from_account", "payment_currency")


def daily_activity(t: DataFrame) -> DataFrame:
    """payments and paid total per sender, currency and day."""
    return (t.groupBy(*SENDER, F.to_date("transaction_time").alias("activity_day"))
            .agg(F.count(F.lit(1)).alias("daily_transactions"),
                 F.sum("amount_paid").alias("daily_amount")))


def prior_history(daily: DataFrame) -> DataFrame:
    """totals over earlier *active* days (ROWS frame, current day excluded)."""
    w = Window.partitionBy(*SENDER).orderBy("activity_day").rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(*SENDER, "activity_day",
                        F.sum("daily_transactions").over(w).alias("prior_transaction_count"),
                        F.sum("daily_amount").over(w).alias("prior_amount_total"))


def features(t: DataFrame) -> DataFrame:
    """one row per transaction with point-in-time history (0 when none)."""
    h = prior_history(daily_activity(t))
    tx = t.withColumn("activity_day", F.to_date("transaction_time"))
    j = tx.join(h, [*SENDER, "activity_day"], "left")
    n = F.col("prior_transaction_count")
    avg = (F.col("prior_amount_total") / n.cast("decimal(20,0)")).cast("double")
    return j.select(
        "transaction_id", "transaction_time",
        F.col("amount_paid").cast("double").alias("amount_paid"),
        "payment_currency", "receiving_currency", "payment_format",
        (F.col("from_bank") == F.col("to_bank")).cast("int").alias("same_bank"),
        ((F.col("from_bank") == F.col("to_bank")) & (F.col("from_account") == F.col("to_account")))
        .cast("int").alias("self_transfer"),
        F.hour("transaction_time").alias("transaction_hour"),
        F.extract(F.lit("DAYOFWEEK_ISO"), F.col("transaction_time")).cast("int").alias("transaction_weekday"),
        F.coalesce(n, F.lit(0)).cast("double").alias("prior_transaction_count"),
        F.when(n > 0, avg).otherwise(F.lit(0.0)).alias("prior_average_amount"),
        F.when(n > 0, 1).otherwise(0).alias("has_prior_history"),
        "is_laundering",
    )


def numeric_columns(f: DataFrame | None = None) -> dict[str, Column]:
    """the 11 numeric model inputs as expressions over a feature frame."""
    amount = F.greatest(F.col("amount_paid"), F.lit(0.0))
    count = F.greatest(F.col("prior_transaction_count"), F.lit(0.0))
    average = F.greatest(F.col("prior_average_amount"), F.lit(0.0))
    ratio = F.when(average > 0, amount / average).otherwise(F.lit(0.0))
    hour = F.col("transaction_hour").cast("double")
    weekday = F.col("transaction_weekday").cast("double")
    two_pi = 2 * math.pi
    return {
        "log_amount_paid": F.log1p(amount),
        "log_prior_transaction_count": F.log1p(count),
        "log_prior_average_amount": F.log1p(average),
        "log_amount_to_prior_average": F.log1p(F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1e9))),
        "same_bank": F.col("same_bank").cast("double"),
        "self_transfer": F.col("self_transfer").cast("double"),
        "has_prior_history": F.col("has_prior_history").cast("double"),
        "hour_sin": F.sin(F.lit(two_pi) * hour / 24),
        "hour_cos": F.cos(F.lit(two_pi) * hour / 24),
        "weekday_sin": F.sin(F.lit(two_pi) * (weekday - 1) / 7),
        "weekday_cos": F.cos(F.lit(two_pi) * (weekday - 1) / 7),
    }


def numeric_features(f: DataFrame) -> DataFrame:
    """F4 as a frame: transaction_id plus the 11 transformed inputs."""
    cols = numeric_columns()
    return f.select("transaction_id", *[cols[n].alias(n) for n in C.NUMERIC_FEATURES])


def split_column(train_end: str, validation_end: str, time_col: str = "transaction_time") -> Column:
    """chronological split by two cut dates."""
    t = F.col(time_col)
    return (F.when(t < F.lit(train_end).cast("timestamp_ntz"), F.lit("train"))
            .when(t < F.lit(validation_end).cast("timestamp_ntz"), F.lit("validation"))
            .otherwise(F.lit("test")))


def with_split(f: DataFrame, train_end: str, validation_end: str) -> DataFrame:
    return f.withColumn("data_split", split_column(train_end, validation_end))


def standardizer(train: DataFrame) -> DataFrame:
    """one-row mean / population scale of every numeric input (one pass)."""
    cols = numeric_columns()
    aggs = []
    for n in C.NUMERIC_FEATURES:
        aggs += [F.avg(cols[n]).alias(f"{n}__mean"), F.avg(cols[n] * cols[n]).alias(f"{n}__sq")]
    stats = train.agg(*aggs)
    out = []
    for n in C.NUMERIC_FEATURES:
        mean, sq = F.col(f"{n}__mean"), F.col(f"{n}__sq")
        out += [mean.alias(f"{n}__mean"),
                F.sqrt(F.greatest(sq - mean * mean, F.lit(1e-12))).alias(f"{n}__scale")]
    return stats.select(*out)


def standardizer_long(train: DataFrame) -> DataFrame:
    wide = standardizer(train)
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(n).alias("feature"),
                     F.col(f"{n}__mean").alias("mean"), F.col(f"{n}__scale").alias("scale"))
            for i, n in enumerate(C.NUMERIC_FEATURES)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def category(column: str) -> Column:
    """A categorical input as text; null is the text UNKNOWN, which training may see like any other."""
    return F.coalesce(F.col(column).cast("string"), F.lit(C.UNKNOWN_CATEGORY))


def vocabulary(train: DataFrame, columns: Sequence[str] = C.CATEGORICAL_FEATURES) -> DataFrame:
    """sorted distinct train values per column (NULL -> UNKNOWN), index from 0.

    One pass gathers (column, value) pairs; the index is a distributed running count, so no task holds a column.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), category(c).alias("value")) for c in columns]))
    d = train.select(pairs.alias("p")).select("p.*").distinct().withColumn("_one", F.lit(1).cast("long"))
    ranked = grouped_cumsum(d, ["column_name"], ["value"], "_one", "_rank")
    return ranked.select("column_name", "value", (F.col("_rank") - 1).cast("int").alias("category_index"))


def class_weights(train: DataFrame, label: str = "is_laundering") -> DataFrame:
    """balanced weights n / (2 * n_class) for labels 0 and 1; null for a class without rows."""
    return train.agg(F.count(F.lit(1)).alias("n"),
                     F.count_if(F.col(label) == 1).alias("positives")).select(
        "n", "positives",
        F.try_divide(F.col("n"), 2 * (F.col("n") - F.col("positives"))).alias("negative_weight"),
        F.try_divide(F.col("n"), 2 * F.col("positives")).alias("positive_weight"))


def category_sizes(vocab: DataFrame, columns: Sequence[str] = C.CATEGORICAL_FEATURES) -> dict[str, int]:
    """Number of trained values per column (one number each on the driver)."""
    got = {r["column_name"]: r["n"] for r in vocab.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: got.get(c, 0) for c in columns}


def category_offsets(sizes: dict[str, int]) -> dict[str, int]:
    """First slot of each column: blocks follow the numeric inputs, and the last slot of a block is for unseen values."""
    out, at = {}, len(C.NUMERIC_FEATURES)
    for c, n in sizes.items():
        out[c], at = at, at + n + 1
    return out


def join_categories(f: DataFrame, table: DataFrame, columns: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """``f`` with ``_ll_<extra>_<column>`` of the row of ``table`` (column_name, value, extra...) that a categorical
    value has; null for an unseen value. The vocabulary is a joined table of any size, never literals."""
    out = f
    for c in columns:
        own = table.filter(F.col("column_name") == c).select(
            F.col("value").alias(f"_ll_value_{c}"), *[F.col(x).alias(f"_ll_{x}_{c}") for x in extra])
        out = out.join(own, category(c) == F.col(f"_ll_value_{c}"), "left").drop(f"_ll_value_{c}")
    return out


def standardized(stats: DataFrame | None = None, means: Sequence[float] = (), scales: Sequence[float] = ()) -> list[Column]:
    """F8: the z-scored numeric inputs, from a joined one-row ``stats`` frame or from numbers."""
    cols = numeric_columns()
    if stats is not None:
        return [(cols[n] - F.col(f"{n}__mean")) / F.col(f"{n}__scale") for n in C.NUMERIC_FEATURES]
    return [(cols[n] - F.lit(m)) / F.lit(s) for n, m, s in zip(C.NUMERIC_FEATURES, means, scales)]


def design(f: DataFrame, stats: DataFrame, vocab: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """F8: the design matrix in sparse form: ``f`` plus ``z`` (z-scored numerics, slots 0..10) and ``slots`` (the
    active one-hot slot of each categorical column; an unseen value takes the last slot of its block)."""
    sizes = category_sizes(vocab) if sizes is None else sizes
    offsets = category_offsets(sizes)
    j = join_categories(f, vocab, list(sizes), ["category_index"]).crossJoin(F.broadcast(stats))  # one row
    slots = [F.coalesce(F.col(f"_ll_category_index_{c}"), F.lit(n)) + F.lit(offsets[c]) for c, n in sizes.items()]
    return j.select(*f.columns, F.array(*standardized(stats)).alias("z"), F.array(*slots).alias("slots"))
