"""Equality of two sets of tables (D4): order-free digests per bucket, and rows only where they differ.

A table's digest is one row per bucket of its key: the row count and two sums of 64-bit row hashes, so neither
order nor partitioning matters and a doubled row shows. Two snapshots are compared by their digests; only the rows of
buckets that differ are compared one by one, with their multiplicities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def row_hash(columns: Sequence[str], salt: int) -> Column:
    """Over all columns by name; nulls count at their place."""
    return F.xxhash64(F.lit(salt), *[x for c in sorted(columns) for x in (F.col(c).isNull(), F.col(c))]).cast("decimal(38,0)")


def digest(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, sum_1, sum_2): at most ``buckets`` rows."""
    return (df.groupBy(_bucket(keys, buckets).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(row_hash(df.columns, 1)).alias("sum_1"), F.sum(row_hash(df.columns, 2)).alias("sum_2")))


def changed_buckets(first: DataFrame, second: DataFrame) -> DataFrame:
    """Buckets whose digests differ, or that one side lacks; (bucket)."""
    marks = lambda d, side: d.select("bucket", F.struct("rows", "sum_1", "sum_2").alias(side))
    both = marks(first, "_a").join(marks(second, "_b"), "bucket", "full")
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("bucket")


def differences(first: DataFrame, second: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows that occur more often on one side: the columns, ``side`` (first or second) and ``times``."""
    bad = changed_buckets(digest(first, keys, buckets), digest(second, keys, buckets))
    own = lambda df, sign: (df.select(*sorted(first.columns)).withColumn("_bucket", _bucket(keys, buckets))
                            .join(F.broadcast(bad.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi")  # at most ``buckets`` rows
                            .drop("_bucket").withColumn("_sign", F.lit(sign)))
    net = own(first, 1).unionByName(own(second, -1)).groupBy(*sorted(first.columns)).agg(F.sum("_sign").alias("_net"))
    return (net.filter(F.col("_net") != 0)
            .select(*first.columns, F.when(F.col("_net") > 0, "first").otherwise("second").alias("side"), F.abs("_net").alias("times")))


def compare(first: dict[str, DataFrame], second: dict[str, DataFrame], keys: dict[str, Sequence[str]],
            buckets: int = BUCKETS) -> DataFrame:
    """Per table: rows on each side, rows found on one side only, and whether the tables are equal.

    A table that one side lacks counts as empty there; columns are compared by name, and a table with other columns
    on one side differs in all its rows.
    """
    out = None
    for name in sorted({*first, *second}):
        a, b = first.get(name), second.get(name)
        a = b.limit(0) if a is None else a
        b = a.limit(0) if b is None else b
        n = a.agg(F.count(F.lit(1)).alias("rows_first")).crossJoin(b.agg(F.count(F.lit(1)).alias("rows_second")))
        if sorted(a.columns) == sorted(b.columns):
            d = differences(a, b, keys[name], buckets).agg(
                F.coalesce(F.sum(F.when(F.col("side") == "first", F.col("times"))), F.lit(0)).alias("only_first"),
                F.coalesce(F.sum(F.when(F.col("side") == "second", F.col("times"))), F.lit(0)).alias("only_second"))
            row = n.crossJoin(d)
            equal = (F.col("only_first") == 0) & (F.col("only_second") == 0)
        else:
            row = n.withColumn("only_first", F.col("rows_first")).withColumn("only_second", F.col("rows_second"))
            equal = F.lit(False)
        row = row.select(F.lit(name).alias("table_name"), "rows_first", "rows_second", "only_first", "only_second", equal.alias("is_equal"))
        out = row if out is None else out.unionByName(row)
    return out
