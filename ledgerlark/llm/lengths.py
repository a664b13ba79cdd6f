"""Token counts: an exact histogram of encoded lengths.

Documents are aggregated by length (map-side first, so a common length is one row per task). Running
sums over the lengths, from range partitions, turn into suffix sums that answer for any context limit
how many documents are longer, how many tokens stay when each is cut at the limit, and the quantiles.

Edge cases. Null and empty texts have length 0 and count. Null lengths are left out. An empty table
gives an empty histogram. Repeated rows count each. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import grouped_cumsum


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row per length: n_tokens, n_docs, docs_below, docs_from (this length and more), tokens_below,
    tokens_from, truncated_total (tokens left when every document is cut at this length), total_docs, total_tokens.
    """
    bins = lengths.select(F.col(column).alias("n_tokens")).dropna().groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    bins = bins.withColumn("__tokens", F.col("n_tokens") * F.col("n_docs"))
    run = grouped_cumsum(bins, [], ["n_tokens"], ["n_docs", "__tokens"], ["__docs_to", "__tokens_to"])
    total = run.agg(F.sum("n_docs").alias("total_docs"), F.sum("__tokens").alias("total_tokens"))
    out = run.crossJoin(F.broadcast(total))  # one row
    docs_from = F.col("total_docs") - F.col("__docs_to") + F.col("n_docs")
    below = F.col("__tokens_to") - F.col("__tokens")
    return out.select("n_tokens", "n_docs", (F.col("__docs_to") - F.col("n_docs")).alias("docs_below"), docs_from.alias("docs_from"),
                      below.alias("tokens_below"), (F.col("total_tokens") - below).alias("tokens_from"),
                      (below + F.col("n_tokens") * docs_from).alias("truncated_total"), "total_docs", "total_tokens")


def truncated(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Per limit: docs_longer, truncated_total. The smallest length from the limit on has both sums."""
    asked = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    first = (hist.join(F.broadcast(asked), F.col("n_tokens") >= F.col("context_limit"), "inner")  # the caller's few limits
             .groupBy("context_limit").agg(F.min_by(F.struct("n_tokens", "docs_from", "tokens_below", "n_docs"), "n_tokens").alias("h")))
    total = hist.agg(F.max("total_tokens").alias("total_tokens"))
    got = asked.join(first, "context_limit", "left").crossJoin(F.broadcast(total))
    longer = F.col("h.docs_from") - F.when(F.col("h.n_tokens") == F.col("context_limit"), F.col("h.n_docs")).otherwise(0)
    return got.select("context_limit", F.coalesce(longer, F.lit(0)).alias("docs_longer"),
                      F.coalesce(F.col("h.tokens_below") + F.col("context_limit") * F.col("h.docs_from"),
                                 F.col("total_tokens")).alias("truncated_total"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """Per share q: the smallest length that at least q of the documents do not exceed."""
    asked = hist.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    reached = (F.col("docs_below") + F.col("n_docs")) >= F.col("share") * F.col("total_docs")
    return hist.join(F.broadcast(asked), reached).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
