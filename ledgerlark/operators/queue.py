"""Ranked review queue, per-case explanations and case browsing.

The queue is cut to its size before any join (TakeOrdered on the scores), so the
joins to transactions and features broadcast a bounded side (the queue) and the
big tables are only scanned. Explanations are array expressions over the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .model import LogisticModel

# --- Fixed values: grouped feature names and reason texts ------------------------------
TIME_GROUPS = {"hour_sin": "Time of day", "hour_cos": "Time of day",
               "weekday_sin": "Day of week", "weekday_cos": "Day of week"}
# -----------------------------------------------------------------------------------------
EFFECT = "decimal(18,9)"  # scale of an effect, so that engines agree on order and ties


def review_queue(scores: DataFrame, n: int = 10_000, split: str = "test") -> DataFrame:
    """G1: top n scores of a split by score desc, ID asc, with review_rank 1..n."""
    top = (scores.filter(F.col("data_split") == split)
           .select("transaction_id", "review_score", "data_split", "model_version")
           .orderBy(F.desc("review_score"), F.asc("transaction_id")).limit(n))
    w = Window.orderBy(F.desc("review_score"), F.asc("transaction_id"))
    return top.withColumn("review_rank", F.row_number().over(w))


def queue_cases(queue: DataFrame, transactions: DataFrame, features: DataFrame) -> DataFrame:
    """G1 (joins): the bounded queue joined to transactions and features."""
    q = F.broadcast(queue)
    t = transactions.select("transaction_id", "transaction_time", "from_bank", "from_account", "to_bank",
                            "to_account", "amount_paid", "payment_currency", "amount_received",
                            "receiving_currency", "payment_format", "is_laundering")
    f = features.select("transaction_id", "same_bank", "self_transfer", "transaction_hour", "transaction_weekday",
                        "prior_transaction_count", "prior_average_amount", "has_prior_history",
                        F.col("amount_paid").alias("feature_amount_paid"))
    return q.join(t, "transaction_id").join(F.broadcast(q.select("transaction_id")).join(f, "transaction_id"),
                                            "transaction_id")


def with_spikes(cases: DataFrame) -> DataFrame:
    """Cases with amount_to_earlier_average and the spike rule: ten times the average of five earlier payments or more."""
    ratio = F.when(F.col("prior_average_amount") > 0, F.col("feature_amount_paid") / F.col("prior_average_amount"))
    spike = F.coalesce((F.col("prior_transaction_count") >= 5) & (ratio >= 10), F.lit(False))
    return cases.withColumn("amount_to_earlier_average", ratio).withColumn("amount_spike_rule", spike)


def display_amount(x: Column) -> Column:
    """Thousands separators, trailing zeros stripped, no rounding: the digits come from the exact decimal."""
    text = x.cast("decimal(38,18)").cast("string")
    whole = F.regexp_replace(F.substring_index(text, ".", 1), r"(?<=\d)(?=(?:\d{3})+$)", ",")
    part = F.regexp_replace(F.substring_index(text, ".", -1), "0+$", "")
    return F.when(part == "", whole).otherwise(F.concat(whole, F.lit("."), part))


def _yes_no(c: str) -> Column:
    return F.when(F.col(c) == 1, F.lit("yes")).otherwise(F.lit("no"))


def reason_text(name: Column) -> Column:
    """Readable text for a grouped feature name, evaluated on the case row."""
    weekday = F.element_at(F.array(*[F.lit(d) for d in C.WEEKDAY_NAMES]), F.col("transaction_weekday"))
    ratio_text = F.when(F.col("prior_average_amount") > 0, F.concat(
        F.lit("Amount versus earlier average: "),
        F.format_number(F.col("feature_amount_paid") / F.col("prior_average_amount"), 1), F.lit("x"))
    ).otherwise(F.lit("No earlier average payment available"))
    cat_col = F.substring_index(name, "=", 1)
    cat_label = F.concat(F.upper(F.substring(cat_col, 1, 1)),
                         F.lower(F.replace(F.substring(cat_col, 2, 1000), F.lit("_"), F.lit(" "))))
    return (F.when(name == "log_amount_paid", F.concat(F.lit("Payment amount: "),
                                                       display_amount(F.col("feature_amount_paid")),
                                                       F.lit(" "), F.col("payment_currency")))
            .when(name == "log_prior_transaction_count", F.concat(
                F.lit("Earlier sender payments: "), F.col("prior_transaction_count").cast("long").cast("string")))
            .when(name == "log_prior_average_amount", F.concat(
                F.lit("Earlier average payment: "), display_amount(F.col("prior_average_amount")),
                F.lit(" "), F.col("payment_currency")))
            .when(name == "log_amount_to_prior_average", ratio_text)
            .when(name == "same_bank", F.concat(F.lit("Same bank: "), _yes_no("same_bank")))
            .when(name == "self_transfer", F.concat(F.lit("Same sender and receiver: "), _yes_no("self_transfer")))
            .when(name == "has_prior_history", F.concat(F.lit("Earlier sender history: "), _yes_no("has_prior_history")))
            .when(name == "Time of day", F.format_string("Time of day: %02d:00 hour", F.col("transaction_hour")))
            .when(name == "Day of week", F.concat(F.lit("Day of week: "), weekday))
            .when(F.instr(name, "=") > 0, F.concat(cat_label, F.lit(": "), F.regexp_replace(name, "^[^=]*=", "")))
            .otherwise(F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))))


def explain(cases: DataFrame, model: LogisticModel, k: int = 3) -> DataFrame:
    """Contributions, reconstruction gap, grouped top-k positive reasons, spike rule."""
    # model terms read feature columns by their feature-frame names
    base = cases.withColumn("amount_paid_case", F.col("amount_paid")).withColumn("amount_paid", F.col("feature_amount_paid"))
    contrib = model.with_terms(base).withColumn("_contrib", model.contributions())
    grouped_names = F.transform(F.col("_contrib"), lambda s: F.struct(
        F.coalesce(F.element_at(F.create_map(*[x for kv in TIME_GROUPS.items() for x in map(F.lit, kv)]),
                                s["name"]), s["name"]).alias("name"), s["value"].alias("value")))
    g = contrib.withColumn("_g", F.filter(grouped_names, lambda s: ~(F.instr(s["name"], "=") > 0) | (s["value"] != 0)))
    total = F.aggregate(F.col("_contrib"), F.lit(0.0), lambda acc, s: acc + s["value"])
    recon = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(total + F.lit(model.bias), F.lit(-30.0)), F.lit(30.0))))
    # sum the two members of each time group
    names = F.array_distinct(F.transform(F.col("_g"), lambda s: s["name"]))
    summed = F.transform(names, lambda nm: F.struct(nm.alias("name"), F.aggregate(
        F.filter(F.col("_g"), lambda s: s["name"] == nm), F.lit(0.0), lambda acc, s: acc + s["value"]).cast(EFFECT).alias("value")))
    positive = F.filter(summed, lambda s: s["value"] > 0)
    # ties by design order: the sort is stable, and effects are compared at a fixed scale
    ordered = F.array_sort(positive, lambda a, b: F.when(a["value"] > b["value"], -1)
                           .when(a["value"] < b["value"], 1).otherwise(0))
    top = F.slice(ordered, 1, k)
    out = g.withColumn("_top", top).withColumn("score_reconstruction_gap", F.abs(recon - F.col("review_score")))
    cols = []
    for i in range(1, k + 1):
        item = F.get(F.col("_top"), i - 1)
        cols += [F.when(item.isNotNull(), reason_text(item["name"])).otherwise(F.lit("")).alias(f"model_reason_{i}"),
                 F.coalesce(item["value"], F.lit(0).cast(EFFECT)).cast("double").alias(f"reason_{i}_effect")]
    return (with_spikes(out.select(*[c for c in cases.columns if c != "amount_paid"],
                                   F.col("amount_paid_case").alias("amount_paid"), "score_reconstruction_gap", *cols))
            .withColumn("rule_reason", F.when(F.col("amount_spike_rule"), F.lit(C.SPIKE_REASON)).otherwise(F.lit(""))))


def check_model_shape(model: LogisticModel) -> None:
    """One mean, scale and weight per numeric input; the categorical columns in design order, each with its slot
    for unseen values; the trained values of a column numbered 0..n-1 in order, each once."""
    if any(len(x) != len(C.NUMERIC_FEATURES) for x in (model.means, model.scales, model.numeric)):
        raise ValueError("weight count does not match the numeric features")
    if tuple(model.unknown) != C.CATEGORICAL_FEATURES:
        raise ValueError("categorical columns do not match the model")
    strange = model.categories.filter(~F.col("column_name").isin(list(model.unknown)) | F.col("value").isNull()
                                      | F.col("weight").isNull())
    order = Window.partitionBy("column_name").orderBy("value")
    uneven = model.categories.withColumn("_k", F.row_number().over(order) - 1).filter("category_index <> _k")
    if not strange.isEmpty() or not uneven.isEmpty():
        raise ValueError("category slots do not match the sorted values of their column")


def check_cases(explained: DataFrame, tolerance: float = 1e-5) -> None:
    """Raise unless effects and bias give back the saved scores, and ranks are 1 to n, each once."""
    r = explained.agg(F.max("score_reconstruction_gap").alias("gap"), F.min("review_rank").alias("lo"), F.max("review_rank").alias("hi"),
                      F.count_distinct("review_rank").alias("d"), F.count(F.lit(1)).alias("n")).first()
    if r["n"] and r["gap"] is not None and r["gap"] > tolerance:
        raise ValueError(f"effects and bias give other scores than the saved ones, by up to {r['gap']:.6g}")
    if r["n"] and (r["lo"] != 1 or r["hi"] != r["n"] or r["d"] != r["n"]):
        raise ValueError(f"ranks are not 1 to {r['n']}, each once")


def case_export(explained: DataFrame) -> DataFrame:
    """The typed case document rows; reasons without blanks."""
    reasons = F.filter(F.array("model_reason_1", "model_reason_2", "model_reason_3"), lambda x: x != "")
    return explained.select(
        "review_rank", "transaction_id", "review_score", F.col("transaction_time").cast("string").alias("transaction_time"),
        "from_bank", "from_account", "to_bank", "to_account", F.col("amount_paid").cast("double").alias("amount_paid"),
        "payment_currency", "payment_format", F.col("prior_transaction_count").cast("long").alias("prior_transaction_count"),
        "prior_average_amount", "amount_spike_rule", "amount_to_earlier_average",
        reasons.alias("model_reasons"), "rule_reason")


def filter_cases(cases: DataFrame, rank_max: int | None = None, date: str | None = None,
                 currency: str | None = None, fmt: str | None = None, spike: bool = False,
                 search: str | None = None) -> DataFrame:
    """Composed filters; search is a case-insensitive substring over 5 ID fields."""
    out = cases
    if rank_max is not None:
        out = out.filter(F.col("review_rank") <= rank_max)
    if date:
        out = out.filter(F.to_date("transaction_time") == F.lit(date).cast("date"))
    if currency:
        out = out.filter(F.col("payment_currency") == currency)
    if fmt:
        out = out.filter(F.col("payment_format") == fmt)
    if spike:
        out = out.filter(F.col("amount_spike_rule"))
    if search:
        s = search.strip().lower()
        hit = F.lit(False)
        for c in ("transaction_id", "from_bank", "from_account", "to_bank", "to_account"):
            hit = hit | F.lower(F.col(c).cast("string")).contains(s)
        out = out.filter(hit)
    return out


def case_cards(cases: DataFrame, high_score: float = 0.90) -> DataFrame:
    """Cases, high-score cases, spike cases, distinct currencies."""
    return cases.agg(F.count(F.lit(1)).alias("cases"),
                     F.count_if(F.col("review_score") >= high_score).alias("high_score_cases"),
                     F.count_if(F.col("amount_spike_rule")).alias("spike_cases"),
                     F.count_distinct("payment_currency").alias("currencies"))


def top_categories(cases: DataFrame, field: str, n: int = 5) -> DataFrame:
    """Top-n values by count desc, label asc."""
    return (cases.groupBy(F.col(field).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("cases"))
            .orderBy(F.desc("cases"), F.asc("label")).limit(n))


def timeline(all_cases: DataFrame, filtered: DataFrame) -> DataFrame:
    """Every date of the unfiltered set with the filtered count (0 when none)."""
    dates = all_cases.select(F.to_date("transaction_time").alias("case_date")).distinct()
    counts = filtered.groupBy(F.to_date("transaction_time").alias("case_date")).agg(F.count(F.lit(1)).alias("cases"))
    return dates.join(counts, "case_date", "left").select("case_date", F.coalesce("cases", F.lit(0)).alias("cases"))


def page(cases: DataFrame, number: int, size: int = 15) -> DataFrame:
    """One page of the rank-ordered cases (0-based page number)."""
    return cases.orderBy("review_rank").offset(number * size).limit(size)
