"""Adapter from the driver tables to transaction-shaped inputs.

The driver data has no payments; ``events`` is the stand-in: unique increasing
``event_id``, a naive timestamp, a 2-dp ``value`` and a JSON ``props`` with ``k``.
Every derived frame is a pure projection of ``events`` so its work grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a driver table; split sizes are the session's."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _currency(event_type: Column) -> Column:
    return F.when(event_type.isin("purchase", "signup"), F.lit("Euro")).otherwise(F.lit("US Dollar"))


def _format(event_type: Column) -> Column:
    return (F.when(event_type == "click", "ACH").when(event_type == "view", "Wire")
            .when(event_type == "purchase", "Cheque").when(event_type == "signup", "Cash")
            .otherwise("Credit Card"))


def transactions(events: DataFrame) -> DataFrame:
    """One accepted payment per event (raw ID = event_id XOR 63, file = 8-day block)."""
    e = events.select("event_id", "ts", "user_id", "event_type", "value", _k().alias("k"))
    amount = F.col("value").cast("decimal(24,6)")
    cur = _currency(F.col("event_type"))
    return e.select(
        F.expr("event_id ^ 63").alias("raw_record_id"),
        (F.floor((F.dayofmonth("ts") - 1) / F.lit(8.0)).cast("int") + 1).alias("file_id"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("B"), (F.col("user_id") % 3).cast("string")).alias("from_bank"),
        F.concat(F.lit("A"), (F.col("user_id") % 7).cast("string")).alias("from_account"),
        F.concat(F.lit("B"), (F.col("k") % 4).cast("string")).alias("to_bank"),
        F.concat(F.lit("C"), (F.col("k") % 20).cast("string")).alias("to_account"),
        amount.alias("amount_received"), cur.alias("receiving_currency"),
        amount.alias("amount_paid"), cur.alias("payment_currency"),
        _format(F.col("event_type")).alias("payment_format"),
        F.when(F.col("k") % 50 == 0, 1).otherwise(0).alias("is_laundering"),
        "event_id",
    )


def model_transactions(events: DataFrame) -> DataFrame:
    """The modelling ``transactions`` table: source-order ID, typed columns, smallint label."""
    t = transactions(events)
    return t.select(
        F.col("event_id").alias("transaction_id"),
        F.col("event_time").alias("transaction_time"),
        "from_bank", "from_account", "to_bank", "to_account",
        F.col("amount_received").cast("decimal(38,12)").alias("amount_received"),
        "receiving_currency",
        F.col("amount_paid").cast("decimal(38,12)").alias("amount_paid"),
        "payment_currency", "payment_format",
        F.col("is_laundering").cast("short").alias("is_laundering"),
    )


def corrections(events: DataFrame) -> DataFrame:
    """Correction events: every 23rd event replaces an earlier accepted record.

    ``correction_id`` = event_id, target raw ID = (event_id - event_id % 100) XOR 63,
    amounts x1.1 rounded to cents, the other currency when event_id % 46 = 0.
    """
    t = transactions(events).filter(F.col("event_id") % 23 == 0)
    swap = F.col("event_id") % 46 == 0
    other = F.when(F.col("payment_currency") == "Euro", "US Dollar").otherwise("Euro")
    new_amount = F.round(F.col("amount_paid") * F.lit(1.1).cast("decimal(3,1)"), 2).cast("decimal(24,6)")
    return t.select(
        F.col("event_id").alias("correction_id"),
        F.expr("(event_id - event_id % 100) ^ 63").alias("target_raw_record_id"),
        "event_time", "from_bank", "from_account", "to_bank", "to_account",
        new_amount.alias("amount_received"),
        F.when(swap, other).otherwise(F.col("receiving_currency")).alias("receiving_currency"),
        new_amount.alias("amount_paid"),
        F.when(swap, other).otherwise(F.col("payment_currency")).alias("payment_currency"),
        "payment_format", "is_laundering",
    )


def csv_lines(events: DataFrame) -> DataFrame:
    """Transaction CSV data lines derived from events, with planted faults.

    Columns: file_id, source_row_number, raw_text. Faults by event_id % 17:
    1 bad date, 2 blank sender account, 3 three-decimal dollar amount, 4 NaN amount,
    5 label 2, 6 ten columns, 7 unclosed quote. Every 13th event is repeated later
    in its file (an exact duplicate line).
    """
    t = transactions(events)
    r = F.col("event_id") % 17
    ts_text = F.date_format("event_time", "yyyy/MM/dd HH:mm")
    amount_text = F.format_string("%.2f", F.col("amount_paid").cast("double"))
    fields = [
        F.when(r == 1, F.lit("2024/13/45 25:61")).otherwise(ts_text),
        F.col("from_bank"),
        F.when(r == 2, F.lit(" ")).otherwise(F.col("from_account")),
        F.col("to_bank"), F.col("to_account"),
        F.when(r == 4, F.lit("NaN")).otherwise(amount_text),
        F.col("receiving_currency"),
        F.when(r == 3, F.concat(amount_text, F.lit("5"))).otherwise(amount_text),
        F.col("payment_currency"), F.col("payment_format"),
        F.when(r == 5, F.lit("2")).otherwise(F.col("is_laundering").cast("string")),
    ]
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:10])
    text = (F.when(r == 6, short)
            .when(r == 7, F.concat(F.lit('"'), full))
            .otherwise(full))
    base = t.select("file_id", (F.col("event_id") * 2 + 2).alias("source_row_number"),
                    text.alias("raw_text"), "event_id")
    copies = (base.filter(F.col("event_id") % 13 == 0)
              .withColumn("source_row_number", F.col("source_row_number") + 1))
    return base.unionByName(copies).drop("event_id")


def header_line() -> str:
    return ",".join(C.HEADERS)
