"""Reporting star: five dimensions built once from the published frames, and a generic integrity check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .report import RULE_LABELS, calendar


def dimensions(daily: DataFrame, files: DataFrame, dataset: str) -> dict[str, DataFrame]:
    """Date (continuous), currency, format, file and rule dimensions; the rule one is a selector without a relation."""
    spark = daily.sparkSession
    one = lambda df, c, name: df.select(F.col(c).alias(name)).filter(F.col(name).isNotNull()).distinct()
    return {
        "date": calendar(daily).withColumnRenamed("calendar_date", "event_date"),
        "currency": one(daily, "payment_currency", "payment_currency"),
        "format": one(daily, "payment_format", "payment_format"),
        "file": one(files, "file_id", "file_id").withColumn("dataset", F.lit(dataset)),
        "rule": spark.createDataFrame([(label,) for _, label in RULE_LABELS], "rule string"),
    }


@dataclass
class Relation:
    """Rows of ``fact`` point by ``column`` at one row of ``dimension`` each."""
    name: str
    fact: DataFrame
    column: str
    dimension: DataFrame
    key: str


def check_star(relations: list[Relation]) -> DataFrame:
    """Per relation: dimension rows, keys that occur twice or more or are null, fact rows without a dimension row (a null
    key has none), and whether all is sound."""
    out = None
    for r in relations:
        keys = r.dimension.groupBy(F.col(r.key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        dim = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("dimension_rows"),
                       F.count_if((F.col("_n") > 1) | F.col("_k").isNull()).alias("repeated_keys"))
        used = r.fact.groupBy(F.col(r.column).alias("_k")).agg(F.count(F.lit(1)).alias("_rows"))  # one row per key
        lost = used.join(keys.select("_k"), "_k", "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))
        row = dim.crossJoin(lost).select(F.lit(r.name).alias("relation"), "dimension_rows", "repeated_keys", "orphan_rows",
                                         ((F.col("repeated_keys") == 0) & (F.col("orphan_rows") == 0)).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out


def separated(relations: list[Relation], apart: tuple[tuple[str, str], ...] = (("quality", "date"), ("reconciliation", "date"))) -> bool:
    """No relation named "<fact>.<dimension>" joins a pair that must stay apart, and none uses the rule selector."""
    named = {tuple(r.name.split(".", 1)) for r in relations}
    return not named & set(apart) and all(d != "rule" for _, d in named)
