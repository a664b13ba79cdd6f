"""Registered queries over planted faults, and of explanations, lineage, the reporting star and snapshot documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import queries as Q
from .operators import explore
from .operators import features as feat
from .operators import metrics as met
from .operators import promotion as pro
from .operators import queue as qu
from .operators import reconcile as rec
from .operators import report as rp
from .operators import risk, star
from .operators.model import LogisticModel
from .queries import r9, register
from .session import scratch_path, written
from .sources import documents


def union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- G2-G10: explanations --------------------------------------------------------------------


def spiky(spark, sf_dir) -> DataFrame:
    """The modelling table with some payments fifty times larger, so that the spike rule fires."""
    more = F.when(F.col("transaction_id") % 211 == 0, 50).otherwise(1)
    return Q.mtx(spark, sf_dir).withColumn("amount_paid", (F.col("amount_paid") * more).cast("decimal(38,12)"))


def explained(spark, sf_dir) -> DataFrame:
    t = spiky(spark, sf_dir)
    f = written(feat.with_split(feat.features(t), Q.TRAIN_END, Q.VALIDATION_END), "features")
    model = LogisticModel.fixed(f.filter(F.col("data_split") == "train"))
    cases = qu.queue_cases(qu.review_queue(model.score(f), 1_500), t, f)
    e = written(qu.explain(cases, model), "explained")
    qu.check_cases(e)
    # An average's text shows its last binary digit, on which engines differ: the amount is left out of the comparison.
    return e.select("*", *[F.regexp_replace(f"model_reason_{i}", "^(Earlier average payment: ).* ", "$1").alias(f"reason_{i}") for i in (1, 2, 3)])


@register("case_explanations")
def q_case_explanations(spark, sf_dir):
    e = explained(spark, sf_dir)
    return r9(e.select("review_rank", "transaction_id", "reason_1", "reason_1_effect", "reason_2", "reason_2_effect", "reason_3", "reason_3_effect",
                       "amount_spike_rule", "rule_reason", (F.col("score_reconstruction_gap") < 1e-9).alias("reconstructed")))


@register("case_export")
def q_case_export(spark, sf_dir):
    e = explained(spark, sf_dir)
    x = qu.case_export(e.select(*[c for c in e.columns if not c.startswith("model_reason")], *[F.col(f"reason_{i}").alias(f"model_reason_{i}") for i in (1, 2, 3)]))
    return r9(x.select("review_rank", "transaction_id", "review_score", "transaction_time", "amount_paid", "prior_transaction_count", "amount_spike_rule",
                       "amount_to_earlier_average", F.array_join("model_reasons", " / ").alias("model_reasons"), "rule_reason"))


# --- F31: lineage; F13, F22, F27: integrity with faults ------------------------------------------


@register("evaluate_lineage")
def q_lineage(spark, sf_dir):
    """The tables that were evaluated, in another order; with a changed, a lost and a doubled score; with a changed feature."""
    f = written(Q.feature_frame(spark, sf_dir).filter("data_split = 'test'"), "features")
    model = LogisticModel.fixed(f)
    scores = written(model.score(f).select("transaction_id", "review_score", "is_laundering", "data_split"), "scores")
    metrics = written(met.bound_evaluation(scores, f), "metrics")
    one = F.col("transaction_id") == scores.agg(F.min("transaction_id")).first()[0]
    cases = {"same": (scores.repartition(5), f), "changed": (scores.withColumn("review_score", F.col("review_score") + F.when(one, 1e-12).otherwise(0.0)), f),
             "lost": (scores.filter(~one), f), "doubled": (scores.unionByName(scores.filter(one)), f),
             "feature": (scores, f.withColumn("same_bank", F.when(one, 1 - F.col("same_bank")).otherwise(F.col("same_bank"))))}
    return union(met.lineage(metrics, *v).withColumn("world", F.lit(k)) for k, v in cases.items())


def faulty_scores(spark, sf_dir) -> DataFrame:
    """Scores of which some are lost, some doubled, some of no transaction, some in the wrong split."""
    s = Q.fixed_scores(spark, sf_dir).filter("data_split <> 'train'").select("transaction_id", "review_score", "data_split")
    n = F.col("transaction_id") % 1000
    wrong = s.withColumn("data_split", F.when(n == 3, F.lit("validation")).otherwise(F.col("data_split")))
    strange = s.filter(n == 9).withColumn("transaction_id", -F.col("transaction_id") - 1)
    return union([wrong.filter(n != 5), s.filter(n == 7), strange])


@register("model_binding_faults")
def q_binding_faults(spark, sf_dir):
    return met.binding_checks(Q.feature_frame(spark, sf_dir), faulty_scores(spark, sf_dir), Q.TRAIN_END, Q.VALIDATION_END)


@register("model_score_faults")
def q_score_faults(spark, sf_dir):
    return met.score_integrity(Q.mtx(spark, sf_dir), faulty_scores(spark, sf_dir).select("transaction_id"))


@register("precision_loss_fine")
def q_precision_loss_fine(spark, sf_dir):
    return met.precision_loss(Q.fine_amounts(spark, sf_dir))


# --- E3: missing values ----------------------------------------------------------------------------


@register("investigate_missingness_holes")
def q_missingness_holes(spark, sf_dir):
    """The modelling table with blanks, nulls, negative amounts and strange labels."""
    t, n = Q.mtx(spark, sf_dir), F.col("transaction_id")
    holes = {"from_bank": F.when(n % 101 == 1, F.lit(" ")), "to_account": F.when(n % 103 == 1, F.lit("")), "payment_format": F.when(n % 107 == 1, F.lit("  "))}
    for c, hole in holes.items():
        t = t.withColumn(c, F.coalesce(hole, F.col(c)))
    for c, m in (("transaction_time", 109), ("to_bank", 113), ("amount_paid", 127), ("payment_currency", 131), ("is_laundering", 137)):
        t = t.withColumn(c, F.when(n % m != 1, F.col(c)))
    return explore.missingness(t)


# --- B12, C20, D6-D8, D11, D12: checks with faults ---------------------------------------------------


@register("promote_orphan_faults")
def q_orphan_faults(spark, sf_dir):
    """Corrections of rows that the fact lacks."""
    s, c, banks, accounts = Q.dims_world(spark, sf_dir)
    fact = pro.insert_fact(s, banks, accounts).filter("source_raw_record_id % 7 <> 0")
    return pro.orphan_corrections(c, fact).select("correction_id", "target_raw_record_id")


def world(spark, sf_dir):
    s, c, banks, accounts, fact = Q.fact_current_world(spark, sf_dir)
    sig = written(risk.risk_signal(Q.fact_with_codes(fact, banks, accounts)), "signal")
    return banks, accounts, fact, sig


@register("publish_currency_faults")
def q_currency_faults(spark, sf_dir):
    """A mart that lacks a currency, and holds another twice for one day."""
    _, _, fact, sig = world(spark, sf_dir)
    mart = risk.daily_mart(sig).filter("payment_currency <> 'Euro'")
    first = mart.agg(F.min("event_date").alias("event_date"))
    return rec.currency_diff(fact, mart.unionByName(mart.join(first, "event_date", "left_semi")))


@register("data_check_faults")
def q_data_check_faults(spark, sf_dir):
    """Every kind of data test over tables with faults: doubled and lost rows, null and unknown keys, values outside their set."""
    banks, accounts, fact, sig = world(spark, sf_dir)
    r = F.col("source_raw_record_id") % 2000
    bad_fact = fact.withColumn("from_account_key", F.when(r != 3, F.col("from_account_key"))).withColumn(
        "to_account_key", F.when(r == 5, F.lit(-1)).otherwise(F.col("to_account_key"))).unionByName(fact.filter(r == 7)).unionByName(fact.filter(r == 7))
    bad_banks = banks.filter("bank_key <> 2").unionByName(banks.filter("bank_key = 1"))
    bad_sig = sig.filter(F.col("transaction_key") % 2000 != 11).withColumn(
        "risk_score", F.when(F.col("transaction_key") % 2000 == 13, 9).otherwise(F.col("risk_score")))
    mart = risk.daily_mart(sig)
    bad_mart = mart.withColumn("transaction_count", F.when(F.col("payment_format") == "Cash", -F.col("transaction_count")).otherwise(F.col("transaction_count")))
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    ev = rec.risk_evaluation(sig)
    last = ev.agg(F.max("event_date").alias("event_date"))
    changed = ev.join(last, "event_date", "left_anti").withColumn("risk_alerts", F.col("risk_alerts") + (F.dayofmonth("event_date") == 2).cast("int"))
    return union([
        rec.check_unique(bad_fact, ["source_raw_record_id"], "fact_unique_source"), rec.check_unique(bad_banks, ["bank_code"], "bank_code_unique"),
        rec.check_unique(bad_mart, ["event_date", "from_bank", "payment_currency", "payment_format"], "mart_unique_grain"),
        rec.check_not_null(bad_fact, "from_account_key", "fact_from_account_not_null"), rec.check_not_null(bad_sig, "event_date", "signal_date_not_null"),
        rec.check_accepted(bad_sig, "risk_score", [0, 1, 2, 3, 4, 5], "signal_score_accepted"),
        rec.check_holds(bad_mart, F.col("transaction_count") > 0, "mart_count_positive"),
        rec.check_fk(bad_fact, "from_account_key", accounts, "account_key", "fact_from_account_fk"),
        rec.check_fk(bad_fact, "to_account_key", accounts, "account_key", "fact_to_account_fk"),
        rec.check_fk(accounts, "bank_key", bad_banks, "bank_key", "account_bank_fk"),
        rec.check_fk(sig, "transaction_key", fact.filter(r != 17), "source_raw_record_id", "signal_transaction_fk"),
        rec.check_counts_equal(bad_mart.agg(F.sum("transaction_count").alias("a")), count(fact), "daily_count_matches_core"),
        rec.check_counts_equal(count(bad_sig), count(fact), "risk_covers_core"),
        count(rec.evaluation_diff(changed, sig)).select(F.lit("risk_evaluation_reconciles").alias("check_name"), F.col("n").alias("failures"))])


# --- H5, H14, H15: snapshot document and star --------------------------------------------------------


def snapshot_folder(spark, sf_dir) -> tuple[str, DataFrame, dict[str, DataFrame]]:
    sig, mart = Q.published(spark, sf_dir)
    header, parts = rp.snapshot_document(mart, sig, Q.q_reconcile_rows(spark, sf_dir), Q.q_reconcile_amounts(spark, sf_dir), 1, 300, 50)
    path = scratch_path(spark, "snapshot")
    documents.write_document(path, header, parts)
    return path, header, parts


@register("report_snapshot_header")
def q_snapshot_header(spark, sf_dir):
    path, header, _ = snapshot_folder(spark, sf_dir)
    return documents.read_document(spark, path, "header", header.schema)


@register("report_snapshot_daily")
def q_snapshot_daily(spark, sf_dir):
    path, _, parts = snapshot_folder(spark, sf_dir)
    return documents.read_document(spark, path, "daily", parts["daily"].schema)


@register("report_snapshot_alerts")
def q_snapshot_alerts(spark, sf_dir):
    path, _, parts = snapshot_folder(spark, sf_dir)
    return documents.read_document(spark, path, "alerts", parts["alerts"].schema).drop("amount_paid").withColumn("event_time", F.replace("event_time", F.lit("T"), F.lit(" ")))


@register("report_star_dimensions")
def q_star_dimensions(spark, sf_dir):
    sig, mart = Q.published(spark, sf_dir)
    dims = star.dimensions(mart, Q.txn(spark, sf_dir), "events")
    keys = {"date": "event_date", "currency": "payment_currency", "format": "payment_format", "file": "file_id", "rule": "rule"}
    return union(d.select(F.lit(k).alias("dimension"), F.col(keys[k]).cast("string").alias("key")) for k, d in dims.items())


@register("report_star_checks")
def q_star_checks(spark, sf_dir):
    """Sound relations, and ones with a lost date, a doubled currency and a null format."""
    sig, mart = Q.published(spark, sf_dir)
    daily, files = rp.daily_with_hits(sig), Q.txn(spark, sf_dir).select("file_id").distinct()
    d = star.dimensions(daily, files, "events")
    first = d["date"].agg(F.min("event_date").alias("event_date"))
    some = daily.withColumn("payment_format", F.when(F.dayofmonth("event_date") != 3, F.col("payment_format")))
    R = star.Relation
    return star.check_star([
        R("daily.date", daily, "event_date", d["date"], "event_date"), R("daily.currency", daily, "payment_currency", d["currency"], "payment_currency"),
        R("daily.format", daily, "payment_format", d["format"], "payment_format"), R("quality.file", files, "file_id", d["file"], "file_id"),
        R("faulty.date", daily, "event_date", d["date"].join(first, "event_date", "left_anti"), "event_date"),
        R("faulty.currency", daily, "payment_currency", d["currency"].unionByName(d["currency"].filter("payment_currency = 'Euro'")), "payment_currency"),
        R("faulty.format", some, "payment_format", d["format"], "payment_format")])
