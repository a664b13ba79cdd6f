"""ID intervals of promotion runs, joined to rows as a binned range join.

Runs cover half-open ID ranges (low, high]. Overlapping ranges are merged, cut at bin borders and joined on the bin
number, then checked by their ends: an equality join of any size in place of a nested loop, and nothing but
the two outer ends, which let the scan skip files by their statistics, comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BIN = 1 << 20


def merged(runs: DataFrame, low: str, high: str) -> DataFrame:
    """Disjoint (low, high] ranges of ``runs``, one control row per run; empty and null ranges are left out."""
    r = runs.select(F.col(low).alias("low"), F.col(high).alias("high")).filter("high > low").distinct()
    before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = (F.coalesce(F.max("high").over(before), F.col("low") - 1) < F.col("low")).cast("int")
    return (r.withColumn("_opened", opened).withColumn("_range", F.sum("_opened").over(upto))
            .groupBy("_range").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_range"))


def covered(rows: DataFrame, id_col: str, ranges: DataFrame, bin_size: int = BIN) -> DataFrame:
    """The rows whose ID lies in one of the disjoint ``ranges`` (low, high]."""
    ends = ranges.agg(F.min("low"), F.max("high")).first()
    if ends[0] is None:
        return rows.limit(0)
    size = F.lit(bin_size)
    first, last = F.floor((F.col("low") + 1) / size), F.floor(F.col("high") / size)
    pieces = ranges.select("low", "high", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("_bin")) \
        .withColumnRenamed("low", "_low").withColumnRenamed("high", "_high")
    inside = rows.filter((F.col(id_col) > ends[0]) & (F.col(id_col) <= ends[1])).withColumn("_bin", F.floor(F.col(id_col) / size).cast("long"))
    hit = (inside["_bin"] == pieces["_bin"]) & (F.col(id_col) > F.col("_low")) & (F.col(id_col) <= F.col("_high"))
    return inside.join(pieces, hit, "left_semi").drop("_bin")


def affected_days(new_staged: DataFrame, new_corrections: DataFrame, fact_before: DataFrame, all_corrections: DataFrame) -> DataFrame:
    """C4: (event_date) of new staged rows, of new corrections, of the rows they correct, and of all
    corrections of those rows."""
    day = F.to_date("event_time").alias("event_date")
    targets = new_corrections.select("target_raw_record_id").distinct()
    originals = fact_before.join(targets, F.col("source_raw_record_id") == F.col("target_raw_record_id"), "left_semi")
    history = all_corrections.join(targets, "target_raw_record_id", "left_semi")  # the new ones among them
    return new_staged.select(day).unionByName(originals.select(day)).unionByName(history.select(day)).distinct()


def affected_files(new_files: DataFrame, new_staged: DataFrame, new_corrections: DataFrame, fact_before: DataFrame) -> DataFrame:
    """(file_id) of newly completed files, of new staged rows and of the rows that new corrections change."""
    targets = new_corrections.select("target_raw_record_id").distinct()
    changed = fact_before.join(targets, F.col("source_raw_record_id") == F.col("target_raw_record_id"), "left_semi")
    of = lambda df: df.select(F.col("source_file_id").cast("long").alias("file_id"))
    return new_files.select(F.col("file_id").cast("long")).unionByName(of(new_staged)).unionByName(of(changed)).distinct()
