"""Registered queries of loading, staging, the modelling load, filters and profiling that the other modules leave open."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import queries as Q
from .operators import classify as cls
from .operators import explore
from .operators import features as feat
from .operators import metrics as met
from .operators import promotion as pro
from .operators import queue as qu
from .operators import report as rp
from .operators.model import LogisticModel
from .queries import r9, register
from .queries_checks import spiky, union
from .session import scratch_path, written
from .sources import lines as src

# --- A: loads ------------------------------------------------------------------------------------


@register("ingest_plan")
def q_plan(spark, sf_dir):
    """A5: files found (one per 97 events, some with the same content) against a manifest of some of them."""
    e = Q.events(spark, sf_dir).filter("event_id % 97 = 0").select("event_id")
    n = F.col("event_id")
    found = e.select(F.concat(F.lit("f"), n.cast("string")).alias("path"), F.md5((n - F.when(n % 5 == 0, 97).otherwise(0)).cast("string")).alias("sha256"))
    logged = e.filter(n % 3 != 1).select(n.alias("file_id"), F.md5(n.cast("string")).alias("sha256"),
                                         F.when(n % 4 == 0, "failed").when(n % 4 == 1, "started").otherwise("completed").alias("status"))
    return src.plan_loads(found, logged)


@register("correction_targets")
def q_targets(spark, sf_dir):
    """Corrections whose target is not an accepted row."""
    raw = cls.with_raw_ids(Q.classified_lines(spark, sf_dir))
    return cls.missing_targets(Q.corrections_world(spark, sf_dir), raw).select("correction_id", "target_raw_record_id")


@register("load_generated")
def q_generated(spark, sf_dir):
    """As many synthetic rows as there are events."""
    return src.generate(spark, Q.events(spark, sf_dir).count(), per_day=500)


@register("model_load")
def q_model_load(spark, sf_dir):
    """The modelling table written as CSV and loaded again; amounts that do not fit are told, not rounded."""
    t = Q.mtx(spark, sf_dir)
    n = F.col("transaction_id")
    wide = F.when(n % 501 == 0, F.lit("1.1234567890123")).when(n % 502 == 0, F.lit("100000000000000000000000000")).when(n % 503 == 0, F.lit("-1"))
    rows = t.select("transaction_id", F.date_format("transaction_time", "yyyy/MM/dd HH:mm").alias("Timestamp"), "from_bank", "from_account", "to_bank",
                    "to_account", F.col("amount_received").cast("string").alias("amount_received"), "receiving_currency",
                    F.coalesce(wide, F.col("amount_paid").cast("string")).alias("amount_paid"), "payment_currency", "payment_format", "is_laundering")
    path = scratch_path(spark, "model-csv")
    rows.repartitionByRange("transaction_id").sortWithinPartitions("transaction_id").drop("transaction_id").write.option("header", True).csv(path)
    loaded, refused = src.load_transactions(spark, path)
    return union([loaded.select("transaction_id", "transaction_time", "from_account", "to_account", F.col("amount_paid").cast("string").alias("amount_paid"),
                                "payment_format", "is_laundering", F.lit("loaded").alias("outcome")),
                  refused.select("transaction_id", "transaction_time", "from_account", "to_account", F.col("amount_paid_text").alias("amount_paid"),
                                 "payment_format", "is_laundering", F.lit("amount does not fit").alias("outcome"))])


@register("contract_amounts")
def q_amounts(spark, sf_dir):
    """Amounts written with other scales, exponents, signs, digits and currencies: whether the contract takes them."""
    e = Q.events(spark, sf_dir)
    n, base = F.col("event_id"), F.col("value").cast("decimal(18,2)").cast("string")
    forms = [base, F.concat(base, F.lit("5")), F.concat(base, F.lit("0000")), F.concat(base, F.lit("12345")), F.concat(F.lit("+"), base), F.concat(F.lit("-"), base),
             F.concat((n % 90 + 10).cast("string"), F.lit("e-2")), F.concat((n % 90 + 1).cast("string"), F.lit("E3")), F.lit("1_000.5"), F.lit("Infinity"),
             F.translate(base, "0123456789", "٠١٢٣٤٥٦٧٨٩"), F.concat(F.lit(" "), base, F.lit("\t")), F.lit("999999999999999999"), F.lit("1000000000000000000")]
    text = F.element_at(F.array(*forms), (n % len(forms) + 1).cast("int"))
    currency = F.when(n % 3 == 0, "Bitcoin").otherwise("Euro")
    row = F.concat_ws(",", F.lit("2024/01/02 03:04,B1,A1,B2,A2,1"), F.lit("Euro"), text, currency, F.lit("ACH,0"))
    return cls.parse_lines(e.select("event_id", row.alias("raw_text"))).select("event_id", F.array_join("reason_codes", ",").alias("reason_codes"))


# --- B5, B6: typed rows ----------------------------------------------------------------------------


@register("promote_staged")
def q_staged(spark, sf_dir):
    return pro.stage(cls.with_raw_ids(Q.classified_lines(spark, sf_dir))).withColumn("is_laundering", F.col("is_laundering").cast("int"))


@register("promote_staged_corrections")
def q_staged_corrections(spark, sf_dir):
    parsed = written(cls.parse_corrections(Q.correction_lines(spark, sf_dir)), "corrections").filter("error is null")  # one parse
    return pro.stage_corrections(parsed).withColumn("is_laundering", F.col("is_laundering").cast("int"))


# --- F12, F29, F30 -----------------------------------------------------------------------------------


@register("model_score_export")
def q_score_export(spark, sf_dir):
    """the scores of the evaluation splits only."""
    return r9(met.score_export(Q.fixed_scores(spark, sf_dir), evaluation_only=True))


@register("rounded_control_check")
def q_rounded_check(spark, sf_dir):
    """columns in which two runs may not differ, with a planted change in one of them; F30: score differences."""
    t = Q.fine_amounts(spark, sf_dir)
    a = feat.with_split(feat.features(t), Q.TRAIN_END, Q.VALIDATION_END)
    b = feat.with_split(feat.features(met.rounded_control(t)), Q.TRAIN_END, Q.VALIDATION_END)
    b = b.withColumn("payment_format", F.when(F.col("transaction_id") % 977 == 1, F.lit("other")).otherwise(F.col("payment_format")))
    return met.unequal_columns(a, b, "transaction_id", ["payment_currency", "payment_format", "transaction_hour", "has_prior_history", "is_laundering", "data_split"])


@register("queue_score_delta")
def q_score_delta(spark, sf_dir):
    t = Q.fine_amounts(spark, sf_dir)
    full = feat.with_split(feat.features(t), Q.TRAIN_END, Q.VALIDATION_END)
    rounded = feat.with_split(feat.features(met.rounded_control(t)), Q.TRAIN_END, Q.VALIDATION_END)
    model = LogisticModel.fixed(full.filter(F.col("data_split") == "train"))
    d = met.score_delta(model.score(full).filter("data_split = 'test'"), model.score(rounded).filter("data_split = 'test'"))
    return d.select("rows", "changed", F.round("largest", 7).alias("largest"), F.round("mean", 9).alias("mean"))


# --- G11: filters ---------------------------------------------------------------------------------------


@register("case_filters")
def q_case_filters(spark, sf_dir):
    """Each part of the filter on its own and some together, over cases with spikes."""
    t = spiky(spark, sf_dir)
    f = written(feat.with_split(feat.features(t), Q.TRAIN_END, Q.VALIDATION_END), "features")
    model = LogisticModel.fixed(f.filter(F.col("data_split") == "train"))
    c = written(qu.with_spikes(qu.queue_cases(qu.review_queue(model.score(f), 1_500), t, f)), "cases")
    picks = {"date": dict(date="2024-01-25"), "format": dict(fmt="Wire"), "spike": dict(spike=True), "search": dict(search="C1"),
             "all": dict(rank_max=900, date="2024-01-26", currency="Euro", fmt="Cheque")}
    return union(qu.filter_cases(c, **p).select(F.lit(k).alias("filter"), "review_rank", "transaction_id") for k, p in picks.items())


# --- H13, H16, H25, H27: report parts ------------------------------------------------------------------


@register("report_file_checks")
def q_file_checks(spark, sf_dir):
    """Files against published transactions; H25: the sample against the alerts; H27: an export without identifiers."""
    sig, mart = Q.published(spark, sf_dir)
    rows = Q.q_reconcile_rows(spark, sf_dir)
    ctrl = rp.controls(mart)
    even = rows.agg(F.lit(1).cast("long").alias("file_id"), F.lit(0).alias("x")).crossJoin(ctrl.select(F.col("published_transactions").alias("core_count")))
    sample = rp.alert_sample(sig)
    return union([rp.check_files(rows, ctrl).withColumn("export", F.lit("faulty")), rp.check_files(even, ctrl).withColumn("export", F.lit("sound")),
                  rp.check_sample(sample, mart).withColumn("export", F.lit("sound")),
                  rp.check_sample(sample.unionByName(sample), mart.filter("payment_currency = 'none'")).withColumn("export", F.lit("faulty")),
                  rp.check_identifiers(sample).withColumn("export", F.lit("sound")), rp.check_identifiers(mart).withColumn("export", F.lit("faulty"))])


@register("report_file_measures")
def q_file_measures(spark, sf_dir):
    return rp.file_measures(Q.q_reconcile_rows(spark, sf_dir))


# --- I1, I2: profiling --------------------------------------------------------------------------------------


@register("profile_schema")
def q_schema(spark, sf_dir):
    """Types, and the column that a name finds: spelled otherwise, among candidates, or none."""
    t = Q.mtx(spark, sf_dir)
    wanted = {"amount": ["Amount Paid", "paid"], "label": ["Is-Laundering"], "bank": ["bank", "FROM BANK"], "none": ["no such column"]}
    found = [(k, explore.find_column(t.columns, v)) for k, v in wanted.items()]
    types = explore.column_types(t)
    return types.unionByName(spark.createDataFrame([(None, k, v) for k, v in found], "position int, column_name string, data_type string"))


@register("profile_first_rows")
def q_first_rows(spark, sf_dir):
    return explore.first_rows(Q.mtx(spark, sf_dir), "transaction_id", 25).select("transaction_id", "amount_paid", "payment_format")


# --- the stateful pipeline from files to publication ------------------------------------------------------------


@register("pipeline_state")
def q_pipeline_state(spark, sf_dir):
    """The rendered files loaded one after another (the first one twice), promoted in windows and published: control rows,
    cursors, late rows, gates, the published mart by day and the status, as text."""
    from . import config as C
    from .plans.pipeline import Pipeline
    p = Pipeline(spark, scratch_path(spark, "store"), policy=C.QualityPolicy(max_rejected_fraction=1.0))
    paths = Q.rendered_files(spark, sf_dir, short_header=None)
    outcomes = [p.ingest_file(path) for path in [*paths, paths[0]]]
    loaded = p.raw().filter("validation_status = 'accepted'").count()
    runs = p.catch_up(raw_limit=max(1, -(-loaded // 2)))
    published = p.publish()
    again = p.publish()
    rows = [("load", str(i), f"{o['file_id']} {o['status']}") for i, o in enumerate(outcomes)]
    rows += [("run", str(i), r["status"] if r["status"] == "skipped" else f"{r['run_id']} {r['staged_rows']} {r['fact_rows']} {r['last_raw_record_id']}")
             for i, r in enumerate(runs)]
    rows += [("publication", str(published["publication_id"]), " ".join(str(published[k]) for k in ("affected_days", "affected_files", "signal_rows", "mart_rows"))),
             ("publication", "again", again["status"])]
    text = lambda *cols: F.concat_ws(" ", *[F.col(c).cast("string") for c in cols]).alias("value")
    counts = p.manifest().select(F.lit("manifest").alias("section"), F.col("file_id").cast("string").alias("key"),
                                 text("total_rows", "accepted_rows", "rejected_rows", "duplicate_candidates"))
    days = p.read_published("mart").groupBy("event_date").agg(F.sum("transaction_count").alias("n"), F.sum("paid_amount").cast("decimal(38,6)").alias("paid"),
                                                              F.sum("risk_alert_count").alias("alerts"))
    days = days.select(F.lit("mart").alias("section"), F.col("event_date").cast("string").alias("key"), text("n", "paid", "alerts"))
    health = p.health().select(F.lit("health").alias("section"), F.col("status").alias("key"),
                               text("files", "total_rows", "accepted_rows", "published_rows", "imbalanced_files", "pending_source_rows", "publication_id"))
    checks = p.verify_run().select(F.lit("verify").alias("section"), F.col("check_name").alias("key"), F.col("passed").cast("string").alias("value"))
    return union([spark.createDataFrame(rows, "section string, key string, value string"), counts, days, health, checks])
