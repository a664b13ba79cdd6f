"""Exact order-dependent aggregates that stay distributed.

An un-partitioned window (or one keyed on a hot group) pulls every row of the
group into one task. The helpers here range-partition the input, compute the
running total inside each (partition, group) slice, and add the totals of all
earlier slices of the same group. Every task sees at most one range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID, _LOCAL, _TOTAL, _OFFSET = "_ll_pid", "_ll_local", "_ll_total", "_ll_offset"


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def ranged_snapshot(df: DataFrame, order: Sequence[str | Column],
                    num_partitions: int | None = None) -> DataFrame:
    """Range-partition ``df`` on ``order`` and pin the assignment with a reliable checkpoint.

    The partition id becomes a column, so later passes see the same split.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn(_PID, F.spark_partition_id())
    return ranged.checkpoint(eager=True)


def grouped_cumsum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                   value_col: str | Sequence[str], out_col: str | Sequence[str], inclusive: bool = True,
                   num_partitions: int | None = None) -> DataFrame:
    """Running sums of value column(s) per group in ``order_cols`` order (ROWS frame).

    ``order_cols`` should be unique within a group (e.g. one row per distinct key),
    otherwise ties are broken arbitrarily, as in any ROWS frame.
    """
    values = [value_col] if isinstance(value_col, str) else list(value_col)
    outs = [out_col] if isinstance(out_col, str) else list(out_col)
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    ranged = ranged_snapshot(df, [*group_cols, *order_cols], num_partitions)
    local_w = (Window.partitionBy(_PID, *group_cols).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(v).over(local_w).alias(f"{_LOCAL}{i}") for i, v in enumerate(values)])
    totals = ranged.groupBy(_PID, *group_cols).agg(
        *[F.sum(v).alias(f"{_TOTAL}{i}") for i, v in enumerate(values)])
    before = (Window.partitionBy(*group_cols).orderBy(_PID)
              .rowsBetween(Window.unboundedPreceding, -1)) if group_cols else \
        Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, *group_cols, *[
        F.coalesce(F.sum(f"{_TOTAL}{i}").over(before), F.lit(0)).alias(f"{_OFFSET}{i}")
        for i in range(len(values))])
    keys = [_PID, *group_cols]
    lo, o = local.alias("l"), offsets.alias("o")
    joined = lo.join(o, _null_safe_on(lo, o, keys), "inner")
    outs_cols = []
    for i, (v, name) in enumerate(zip(values, outs)):
        running = F.col(f"l.{_LOCAL}{i}") + F.col(f"o.{_OFFSET}{i}")
        if not inclusive:
            running = running - F.col(f"l.{v}")
        outs_cols.append(running.alias(name))
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], *outs_cols)


def assign_ids(df: DataFrame, order_cols: Sequence[str], out_col: str, start_after: int = 0,
               num_partitions: int | None = None) -> DataFrame:
    """Dense consecutive IDs ``start_after + 1 ..`` in ``order_cols`` order (keys unique).

    The numbered rows are pinned too: dimensions are read many times downstream, and each
    use is then one scan instead of the offset join again.
    """
    one = df.withColumn("_ll_one", F.lit(1).cast("long"))
    numbered = grouped_cumsum(one, [], order_cols, "_ll_one", out_col, True, num_partitions)
    return numbered.withColumn(out_col, F.col(out_col) + F.lit(start_after)).drop("_ll_one").checkpoint(eager=True)


def running_max_before(df: DataFrame, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """Adds the largest value of all rows before this one in ``order_col`` order (unique keys; null for the first).

    As in ``grouped_cumsum`` every range slice runs on its own, and takes the maximum of earlier slices.
    """
    ranged = ranged_snapshot(df, [order_col])
    local = Window.partitionBy(_PID).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    slices = ranged.groupBy(_PID).agg(F.max(value_col).alias(_TOTAL))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    offsets = slices.select(_PID, F.max(_TOTAL).over(before).alias(_OFFSET))
    joined = ranged.withColumn(_LOCAL, F.max(value_col).over(local)).join(offsets, _PID)
    return joined.withColumn(out_col, F.greatest(_LOCAL, _OFFSET)).drop(_PID, _LOCAL, _OFFSET)
