"""Ranking metrics and evaluation bundles.

AP and ROC-AUC are computed from one row per distinct score: all members of a
tie enter together, so source order cannot change them. The cumulative counts in
score order come from the range-partitioned running sum (no single-task window
over the whole test set). Top-K counts use ``row_number() <= K`` per group, which
Spark plans with a partial per-partition group limit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .scale import grouped_cumsum
from .snapshot import row_hash


def check_metric_input(df: DataFrame, score: str = "review_score", label: str = "is_laundering") -> None:
    """Gate: non-empty, binary labels, finite scores (raises ValueError)."""
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull()).alias("bad_label"),
               F.count_if(F.col(score).isNull() | F.isnan(score)
                          | (F.abs(F.col(score)) == float("inf"))).alias("bad_score")).collect()[0]
    if r["n"] == 0:
        raise ValueError("Expected a nonempty score set")
    if r["bad_label"] or r["bad_score"]:
        raise ValueError("Expected binary labels and finite scores")


def score_curve(df: DataFrame, by: Sequence[str] = (), score: str = "review_score",
                label: str = "is_laundering") -> DataFrame:
    """Per group and distinct score: n, tp and cumulative cn, ctp in score-descending order."""
    by = list(by)
    g = (df.groupBy(*by, F.col(score).alias("_score"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("tp"))
         .withColumn("_neg", -F.col("_score")))
    return grouped_cumsum(g, by, ["_neg"], ["n", "tp"], ["cn", "ctp"], inclusive=True)


def rank_metrics(df: DataFrame, by: Sequence[str] = (), score: str = "review_score",
                 label: str = "is_laundering") -> DataFrame:
    """tie-aware non-interpolated AP (0 without positives) and mid-rank ROC-AUC."""
    by = list(by)
    c = score_curve(df, by, score, label)
    tot = c.groupBy(*by).agg(F.sum("n").alias("_rows"), F.sum("tp").alias("_pos"))
    j = c.join(tot, by) if by else c.crossJoin(tot)
    ap_term = F.try_divide(F.col("tp"), F.col("_pos")) * (F.col("ctp") / F.col("cn"))
    auc_term = (F.col("n") - F.col("tp")) * ((F.col("ctp") - F.col("tp")) + F.col("tp") / 2.0)
    agg = j.groupBy(*by).agg(F.first("_rows").alias("rows"), F.first("_pos").alias("positives"),
                             F.sum(ap_term).alias("_ap"), F.sum(auc_term).alias("_auc"))
    neg = F.col("rows") - F.col("positives")
    return agg.select(*by, "rows", "positives",
                      F.when(F.col("positives") > 0, F.col("_ap")).otherwise(F.lit(0.0)).alias("average_precision"),
                      F.when((F.col("positives") > 0) & (neg > 0),
                             F.try_divide(F.col("_auc"), F.col("positives") * neg)).alias("roc_auc"))


def ranking_at_k(df: DataFrame, by: Sequence[str] = (), ks: Sequence[int] = C.RANKING_KS,
                 score: str = "review_score", label: str = "is_laundering",
                 key: str = "transaction_id") -> DataFrame:
    """F16: positives found in the top min(k, n) by score desc, key asc, per group."""
    by = list(by)
    top = max(ks)
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(key)) if by else \
        Window.orderBy(F.desc(score), F.asc(key))
    if by:
        ranked = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= top)
    else:
        ranked = (df.orderBy(F.desc(score), F.asc(key)).limit(top)
                  .withColumn("_rank", F.row_number().over(w)))
    aggs = []
    for k in ks:
        aggs.append(F.count_if((F.col("_rank") <= k) & (F.col(label) == 1)).alias(f"found_at_{k}"))
    return ranked.groupBy(*by).agg(*aggs) if by else ranked.agg(*aggs)


def confusion(df: DataFrame, by: Sequence[str] = (), cut: float = 0.5, score: str = "review_score",
              label: str = "is_laundering") -> DataFrame:
    """confusion counts at a cut, zero-safe precision and recall."""
    by = list(by)
    pred = F.col(score) >= cut
    pos = F.col(label) == 1
    g = df.groupBy(*by) if by else df.groupBy()
    c = g.agg(F.count_if(~pred & ~pos).alias("tn"), F.count_if(pred & ~pos).alias("fp"),
              F.count_if(~pred & pos).alias("fn"), F.count_if(pred & pos).alias("tp"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    return c.select(*by, "tn", "fp", "fn", "tp", prec.alias("precision_at_cut"), rec.alias("recall_at_cut"))


def evaluate(df: DataFrame, by: Sequence[str] = (), ks: Sequence[int] = C.RANKING_KS, cut: float = 0.5,
             score: str = "review_score", label: str = "is_laundering",
             key: str = "transaction_id") -> DataFrame:
    """rows, positives, prevalence, AP, ROC-AUC, confusion at cut, found/precision/recall@K."""
    by = list(by)
    rm = rank_metrics(df, by, score, label)
    cf = confusion(df, by, cut, score, label)
    rk = ranking_at_k(df, by, ks, score, label, key)
    if by:
        j = rm.join(cf, by).join(rk, by, "left")
    else:
        j = rm.crossJoin(cf).crossJoin(rk)
    extra = []
    for k in ks:
        kk = F.least(F.lit(k), F.col("rows"))
        found = F.coalesce(F.col(f"found_at_{k}"), F.lit(0))
        extra += [(found / kk).alias(f"precision_at_{k}"),
                  F.when(F.col("positives") > 0, found / F.col("positives")).otherwise(0.0).alias(f"recall_at_{k}")]
    return j.select(*by, "rows", "positives", (F.col("positives") / F.col("rows")).alias("prevalence"),
                    "average_precision", "roc_auc", "tn", "fp", "fn", "tp", "precision_at_cut", "recall_at_cut",
                    *[F.coalesce(F.col(f"found_at_{k}"), F.lit(0)).alias(f"found_at_{k}") for k in ks], *extra)


def score_integrity(transactions: DataFrame, scores: DataFrame, key: str = "transaction_id") -> DataFrame:
    """row-count difference and score IDs without a transaction (both should be 0)."""
    n_t = transactions.agg(F.count(F.lit(1)).alias("transaction_rows"))
    n_s = scores.agg(F.count(F.lit(1)).alias("score_rows"))
    unmatched = scores.join(transactions.select(key), key, "left_anti").agg(
        F.count(F.lit(1)).alias("unmatched_scores"))
    return n_t.crossJoin(n_s).crossJoin(unmatched).select(
        (F.col("transaction_rows") - F.col("score_rows")).alias("row_count_difference"), "unmatched_scores")


def rule_scores(f: DataFrame) -> DataFrame:
    """rule baselines as scores: amount / prior average (0 without history), prior frequency."""
    ratio = F.when(F.col("prior_average_amount") > 0,
                   F.col("amount_paid") / F.col("prior_average_amount")).otherwise(F.lit(0.0))
    return f.select("*", ratio.alias("amount_to_history_score"),
                    F.col("prior_transaction_count").cast("double").alias("prior_frequency_score"))


def compare_methods(scored: DataFrame, methods: dict[str, str], ks: Sequence[int] = C.RANKING_KS) -> DataFrame:
    """stack method scores to long form, evaluate per method at equal capacity."""
    parts = [scored.select("transaction_id", "is_laundering", F.lit(m).alias("method"),
                           F.col(c).cast("double").alias("method_score")) for m, c in methods.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return evaluate(long, ["method"], ks, score="method_score")


def slices(scored: DataFrame, fields: dict[str, Column], ks: Sequence[int] = C.RANKING_KS) -> DataFrame:
    """the same metrics per value of each slice field (unpivoted to field, value)."""
    parts = [scored.select("transaction_id", "is_laundering", "review_score",
                           F.lit(name).alias("slice_field"), expr.cast("string").alias("slice_value"))
             for name, expr in fields.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return evaluate(long, ["slice_field", "slice_value"], ks)


def shortlist_mix(scored: DataFrame, k: int = 1000) -> DataFrame:
    """composition of the top-k queue by date, format and currency, with positives."""
    top = scored.orderBy(F.desc("review_score"), F.asc("transaction_id")).limit(k)
    fields = {"date": F.to_date("transaction_time").cast("string"), "payment_format": F.col("payment_format"),
              "payment_currency": F.col("payment_currency")}
    parts = [top.select(F.lit(n).alias("field"), e.alias("value"), "is_laundering") for n, e in fields.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("cases"),
                                              F.count_if(F.col("is_laundering") == 1).alias("positives"))


def period_diagnostic(scored: DataFrame, bands: dict[str, tuple[str, str]], k: int = 1000) -> DataFrame:
    """AP and found@k per date band [start, end); an empty band gives nulls."""
    d = F.to_date("transaction_time")
    band = F.lit(None).cast("string")
    for name, (lo, hi) in reversed(list(bands.items())):
        band = F.when((d >= F.lit(lo).cast("date")) & (d < F.lit(hi).cast("date")), F.lit(name)).otherwise(band)
    b = scored.withColumn("band", band).filter(F.col("band").isNotNull())
    ev = evaluate(b, ["band"], (k,)).select("band", "rows", "positives", "average_precision", f"found_at_{k}")
    names = scored.sparkSession.createDataFrame([(n,) for n in bands], "band string")
    return names.join(ev, "band", "left")


def precision_loss(t: DataFrame) -> DataFrame:
    """rows whose amount differs from its 2-dp rounding, by side and currency."""
    parts = []
    for side, amount, currency in (("paid", "amount_paid", "payment_currency"),
                                   ("received", "amount_received", "receiving_currency")):
        parts.append(t.select(F.lit(side).alias("side"), F.col(currency).alias("currency"),
                              (F.col(amount) != F.round(amount, 2)).alias("_changed")))
    long = parts[0].unionByName(parts[1])
    return long.groupBy("side", "currency").agg(F.count(F.lit(1)).alias("rows"),
                                                F.count_if("_changed").alias("rows_losing_precision"))


def rounded_control(t: DataFrame) -> DataFrame:
    """amounts cast to decimal(18,2) (half-up) and back to the wide type; rest unchanged."""
    return (t.withColumn("amount_received", F.col("amount_received").cast("decimal(18,2)").cast("decimal(38,12)"))
             .withColumn("amount_paid", F.col("amount_paid").cast("decimal(18,2)").cast("decimal(38,12)")))


def compare_runs(a: DataFrame, b: DataFrame, key: str, value_cols: Sequence[str],
                 by: str | None = None) -> DataFrame:
    """paired comparison on the key: changed rows and largest absolute delta per column."""
    j = a.alias("a").join(b.alias("b"), key)
    aggs = []
    for c in value_cols:
        aggs += [F.count_if(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(f"{c}_changed"),
                 F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(f"{c}_max_delta")]
    if by:
        return j.groupBy(F.col(f"a.{by}").alias(by)).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    return j.agg(F.count(F.lit(1)).alias("rows"), *aggs)


def unequal_columns(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """per column that may not differ between paired rows, how many do; rows that one side lacks count everywhere."""
    pairs = a.select(key, *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(1).alias("_in_a")).join(
        b.select(key, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(1).alias("_in_b")), key, "full")
    alone = F.col("_in_a").isNull() | F.col("_in_b").isNull()
    one = pairs.agg(*[F.count_if(alone | ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("unequal_rows")) for c in cols])).alias("r")).select("r.*")


def score_delta(a: DataFrame, b: DataFrame, score: str = "review_score", key: str = "transaction_id") -> DataFrame:
    """paired score differences of two runs: rows, changed rows, largest and mean absolute difference."""
    d = a.select(key, F.col(score).alias("_a")).join(b.select(key, F.col(score).alias("_b")), key).select(F.abs(F.col("_a") - F.col("_b")).alias("_d"))
    return d.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_d") > 1e-9).alias("changed"), F.max("_d").alias("largest"), F.avg("_d").alias("mean"))


def score_export(scores: DataFrame, evaluation_only: bool = False) -> DataFrame:
    """the columns of the score table, of all rows or of the evaluation splits only."""
    some = scores.filter(F.col("data_split") != "train") if evaluation_only else scores
    return some.select("transaction_id", "review_score", "data_split", "model_version")


def queue_overlap(a: DataFrame, b: DataFrame, ks: Sequence[int] = C.RANKING_KS, score: str = "review_score",
                  key: str = "transaction_id") -> DataFrame:
    """shared IDs and Jaccard c / (2k - c) of the two top-k queues for each k."""
    top = max(ks)
    spark = a.sparkSession

    def ranked(df: DataFrame) -> DataFrame:
        t = df.orderBy(F.desc(score), F.asc(key)).limit(top)
        return t.select(key, F.row_number().over(Window.orderBy(F.desc(score), F.asc(key))).alias("_r"))

    ra, rb = ranked(a).alias("ra"), ranked(b).alias("rb")
    both = ra.join(rb, key)
    kdf = spark.createDataFrame([(k,) for k in ks], "k int")
    shared = kdf.join(both, (F.col("ra._r") <= F.col("k")) & (F.col("rb._r") <= F.col("k")), "left") \
        .groupBy("k").agg(F.count(F.col(key)).alias("shared"))
    return shared.select("k", "shared", (F.col("shared") / (2 * F.col("k") - F.col("shared"))).alias("jaccard"))


def binding_checks(features: DataFrame, scores: DataFrame, train_end: str, validation_end: str,
                   key: str = "transaction_id", time_col: str = "transaction_time") -> DataFrame:
    """score IDs unique, every evaluation-period feature row scored, and each score's
    split agrees with its feature timestamp (all three counts should be 0)."""
    dup = (scores.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
           .agg(F.count(F.lit(1)).alias("duplicate_score_ids")))
    ev = features.filter(F.col(time_col) >= F.lit(train_end).cast("timestamp_ntz")).select(key, time_col)
    missing = ev.join(scores.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("missing_scores"))
    expected = F.when(F.col(time_col) < F.lit(validation_end).cast("timestamp_ntz"), F.lit("validation")) \
        .otherwise(F.lit("test"))
    mismatch = (ev.join(scores.select(key, "data_split"), key)
                .agg(F.count_if(F.col("data_split") != expected).alias("split_mismatches")))
    return dup.crossJoin(missing).crossJoin(mismatch)


def artifact_digest(df: DataFrame) -> DataFrame:
    """order-free content digest of a table: its row count and two sums of 64-bit row hashes (nulls count)."""
    h = lambda salt: F.coalesce(F.sum(row_hash(df.columns, salt)), F.lit(0)).cast("decimal(38,0)").cast("string")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.concat(h(1), F.lit(":"), h(2)).alias("digest"))


def bound_evaluation(scores: DataFrame, features: DataFrame, by: Sequence[str] = (), ks: Sequence[int] = C.RANKING_KS) -> DataFrame:
    """the metric rows with the digests of the score and feature tables that they were computed from."""
    of = lambda df, name: artifact_digest(df).select(F.col("rows").alias(f"{name}_rows"), F.col("digest").alias(f"{name}_digest"))
    return evaluate(scores, by, ks).crossJoin(of(scores, "scores")).crossJoin(of(features, "features"))  # one row each


def lineage(metrics: DataFrame, scores: DataFrame, features: DataFrame) -> DataFrame:
    """(artifact, rows, matches) of the tables at hand against what the metric rows are bound to."""
    out = None
    for name, df in (("scores", scores), ("features", features)):
        bound = metrics.select(F.col(f"{name}_rows").alias("_rows"), F.col(f"{name}_digest").alias("_digest")).distinct()
        one = artifact_digest(df).crossJoin(bound.agg(F.count(F.lit(1)).alias("_n"), F.first("_rows").alias("_rows"), F.first("_digest").alias("_digest")))
        row = one.select(F.lit(name).alias("artifact"), "rows", ((F.col("_n") == 1) & F.col("rows").eqNullSafe(F.col("_rows"))
                                                                 & F.col("digest").eqNullSafe(F.col("_digest"))).alias("matches"))
        out = row if out is None else out.unionByName(row)
    return out


def check_lineage(metrics: DataFrame, scores: DataFrame, features: DataFrame) -> None:
    """raise when a table is not the one that the metric rows are bound to."""
    bad = [r["artifact"] for r in lineage(metrics, scores, features).filter("not matches").collect()]
    if bad:
        raise ValueError(f"{' and '.join(bad)} differ from what the metrics are bound to")
