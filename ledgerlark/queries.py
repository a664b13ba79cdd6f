"""Catalog of registered queries: (spark, sf_dir) -> DataFrame over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .operators import risk
from .session import ensure_checkpoint_dir, scratch_path, written
from .sources import adapter

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.read_table(spark, sf_dir, "events")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.transactions(events(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = txn(spark, sf_dir)
    return t.select(F.col("raw_record_id").alias("transaction_key"), "event_time",
                    "from_bank", "from_account", "to_bank", "to_account", "amount_paid",
                    "payment_currency", "payment_format", "is_laundering")


@register("risk_signal")
def risk_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = risk.risk_signal(fact(spark, sf_dir))
    return s.select("transaction_key", "event_time", "event_date", "from_bank", "from_account",
                    "to_bank", "to_account", "amount_paid", "payment_currency", "payment_format",
                    "is_laundering", "high_amount_for_currency_day", "high_hourly_velocity",
                    "repeated_counterparty", "risk_score")


@register("daily_mart")
def daily_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.daily_mart(risk.risk_signal(fact(spark, sf_dir)))


# --- E: descriptive investigation, I: profiling ------------------------------------
from .operators import explore  # noqa: E402


def mtx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.model_transactions(events(spark, sf_dir))


@register("investigate_period")
def q_period(spark, sf_dir):
    return explore.period(mtx(spark, sf_dir))


@register("investigate_label_balance")
def q_label_balance(spark, sf_dir):
    return explore.label_balance(mtx(spark, sf_dir))


@register("investigate_missingness")
def q_missingness(spark, sf_dir):
    return explore.missingness(mtx(spark, sf_dir))


@register("investigate_currency_totals")
def q_currency_totals(spark, sf_dir):
    return explore.currency_totals(mtx(spark, sf_dir))


@register("investigate_format_label_rate")
def q_format_rate(spark, sf_dir):
    return explore.format_label_rate(mtx(spark, sf_dir))


@register("investigate_top_usd_senders")
def q_top_usd(spark, sf_dir):
    return explore.top_usd_senders(mtx(spark, sf_dir))


@register("investigate_busiest_hours")
def q_busiest(spark, sf_dir):
    return explore.busiest_hours(mtx(spark, sf_dir))


@register("investigate_usd_spikes")
def q_spikes(spark, sf_dir):
    return explore.usd_spikes(mtx(spark, sf_dir))


@register("profile_columns")
def q_profile_columns(spark, sf_dir):
    return explore.column_overview(mtx(spark, sf_dir))


@register("profile_label_distribution")
def q_profile_labels(spark, sf_dir):
    return explore.label_distribution(mtx(spark, sf_dir), "is_laundering")


@register("profile_amount_stats")
def q_profile_amounts(spark, sf_dir):
    s = explore.amount_stats(mtx(spark, sf_dir), "amount_paid")
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


# --- A: contract, classification, quarantine, manifest counts, raw IDs -------------
from .operators import classify as cls  # noqa: E402
from .operators import hashindex  # noqa: E402
from .sources import lines as src  # noqa: E402


def classified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.csv_lines(events(spark, sf_dir))
    return cls.classify(cls.parse_lines(lines))


@register("ingest_records")
def q_ingest_records(spark, sf_dir):
    c = classified_lines(spark, sf_dir)
    return c.select("file_id", "source_row_number", "validation_status",
                    F.array_join("reason_codes", ",").alias("reason_codes"), "record_hash")


@register("ingest_quarantine")
def q_quarantine(spark, sf_dir):
    q = cls.quarantine(classified_lines(spark, sf_dir))
    return q.withColumn("reason_codes", F.array_join("reason_codes", ","))


@register("ingest_manifest_counts")
def q_manifest_counts(spark, sf_dir):
    return cls.manifest_counts(classified_lines(spark, sf_dir))


@register("ingest_raw_ids")
def q_raw_ids(spark, sf_dir):
    lines = adapter.csv_lines(events(spark, sf_dir)).select("file_id", "source_row_number")
    return cls.with_raw_ids(lines)


def rendered_files(spark, sf_dir, short_header: int | None = 2) -> list[str]:
    """The CSV lines as files, one per file_id, each with its header (one of them a column short); their paths."""
    lines = adapter.csv_lines(events(spark, sf_dir))
    short = F.lit(",".join(C.HEADERS[:-1]))
    head = lines.select("file_id").distinct().select("file_id", F.lit(0).cast("long").alias("source_row_number"), F.when(
        F.col("file_id") == F.lit(short_header), short).otherwise(F.lit(adapter.header_line())).alias("raw_text"))
    path = scratch_path(spark, "rendered")
    (lines.unionByName(head).repartition("file_id").sortWithinPartitions("file_id", "source_row_number")
     .select("file_id", "raw_text").write.partitionBy("file_id").text(path))
    return src.discover(spark, f"{path}/*", "part-*")


def _file_of(path: str = "path"):
    return F.regexp_extract(path, "file_id=([0-9]+)", 1).cast("long").alias("file_id")


@register("ingest_fingerprints")
def q_fingerprints(spark, sf_dir):
    """A3/A4: every file digested as a stream, as a file above the cell limit is."""
    return src.fingerprint(spark, rendered_files(spark, sf_dir), cell_limit=0).select(_file_of(), "sha256", "byte_size")


@register("ingest_lines")
def q_lines(spark, sf_dir):
    return src.scan_lines(spark, rendered_files(spark, sf_dir)).select(_file_of(), "line_number", "raw_text")


@register("ingest_headers")
def q_headers(spark, sf_dir):
    lines = src.scan_lines(spark, rendered_files(spark, sf_dir)).filter("line_number = 1")
    return src.header_status(lines).select(_file_of(), "error")


@register("ingest_second_load")
def q_second_load(spark, sf_dir):
    """A10 across files: file 1 is loaded, then the others with every tenth line of file 1 again."""
    parsed = written(cls.parse_lines(adapter.csv_lines(events(spark, sf_dir))), "parsed")
    index = hashindex.index_rows(cls.classify_parsed(parsed.filter("file_id = 1")))
    path = scratch_path(spark, "accepted_index")
    index.write.partitionBy("prefix").parquet(path)
    again = parsed.filter("file_id = 1 and source_row_number % 10 = 0").withColumn("file_id", F.lit(2)) \
        .withColumn("source_row_number", F.col("source_row_number") + 1_000_000_000)
    second = parsed.filter("file_id <> 1").unionByName(again)
    seen = hashindex.seen(spark.read.schema(hashindex.SCHEMA).parquet(path),
                          second.filter(F.size("reason_codes") == 0))
    return cls.classify_parsed(second, seen).select(
        "file_id", "source_row_number", "validation_status", F.array_join("reason_codes", ",").alias("reason_codes"))


# --- F: features, scoring, metrics ---------------------------------------------------
from pyspark.sql.types import DoubleType  # noqa: E402

from .operators import features as feat  # noqa: E402
from .operators import metrics as met  # noqa: E402
from .operators.model import LogisticModel, extreme_coefficients  # noqa: E402

# Split days for the driver data (30 days): train before day 21, validation day 21, test after.
TRAIN_END, VALIDATION_END = "2024-01-21", "2024-01-22"
BANDS = {"early_test": ("2024-01-22", "2024-01-26"), "late_test": ("2024-01-26", "2024-01-31")}


def r9(df: DataFrame) -> DataFrame:
    """Presentation for cross-engine comparison: doubles rounded to 9 decimals, -0.0 as 0.0."""
    return df.select(*[(F.round(F.col(f.name), 9) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def feature_frame(spark, sf_dir) -> DataFrame:
    return feat.with_split(feat.features(mtx(spark, sf_dir)), TRAIN_END, VALIDATION_END)


def fixed_scores(spark, sf_dir) -> DataFrame:
    f = feature_frame(spark, sf_dir)
    model = LogisticModel.fixed(f.filter(F.col("data_split") == "train"))
    return model.score(f)


@register("model_features")
def q_model_features(spark, sf_dir):
    return r9(feat.features(mtx(spark, sf_dir)))


@register("model_numeric_features")
def q_numeric(spark, sf_dir):
    return r9(feat.numeric_features(feat.features(mtx(spark, sf_dir))))


@register("model_split_counts")
def q_split_counts(spark, sf_dir):
    return feature_frame(spark, sf_dir).groupBy("data_split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_laundering") == 1).alias("positives"))


@register("model_standardizer")
def q_standardizer(spark, sf_dir):
    f = feature_frame(spark, sf_dir)
    return r9(feat.standardizer_long(f.filter(F.col("data_split") == "train")))


@register("model_vocabulary")
def q_vocab(spark, sf_dir):
    return feat.vocabulary(feature_frame(spark, sf_dir).filter(F.col("data_split") == "train"))


@register("model_class_weights")
def q_class_weights(spark, sf_dir):
    return r9(feat.class_weights(feature_frame(spark, sf_dir).filter(F.col("data_split") == "train")))


@register("model_scores")
def q_model_scores(spark, sf_dir):
    return r9(fixed_scores(spark, sf_dir).select("transaction_id", "review_score", "data_split", "model_version"))


@register("model_score_integrity")
def q_score_integrity(spark, sf_dir):
    return met.score_integrity(mtx(spark, sf_dir), fixed_scores(spark, sf_dir).select("transaction_id"))


@register("model_binding_checks")
def q_binding(spark, sf_dir):
    scores = fixed_scores(spark, sf_dir).filter(F.col("data_split") != "train") \
        .select("transaction_id", "review_score", "data_split")
    return met.binding_checks(feature_frame(spark, sf_dir), scores, TRAIN_END, VALIDATION_END)


@register("evaluate_test")
def q_evaluate_test(spark, sf_dir):
    s = fixed_scores(spark, sf_dir).filter(F.col("data_split") == "test")
    return r9(met.evaluate(s))


@register("evaluate_splits")
def q_evaluate_splits(spark, sf_dir):
    s = fixed_scores(spark, sf_dir).filter(F.col("data_split") != "train")
    return r9(met.evaluate(s, ["data_split"]))


@register("rule_baselines")
def q_rule_baselines(spark, sf_dir):
    s = met.rule_scores(fixed_scores(spark, sf_dir).filter(F.col("data_split") == "test"))
    return r9(met.compare_methods(s, {"model": "review_score", "amount_to_history": "amount_to_history_score",
                                      "prior_frequency": "prior_frequency_score"}))


@register("evaluate_slices")
def q_slices(spark, sf_dir):
    s = fixed_scores(spark, sf_dir).filter(F.col("data_split") == "test")
    return r9(met.slices(s, {"date": F.to_date("transaction_time"), "payment_currency": F.col("payment_currency"),
                             "payment_format": F.col("payment_format")}))


@register("shortlist_mix")
def q_shortlist(spark, sf_dir):
    return met.shortlist_mix(fixed_scores(spark, sf_dir).filter(F.col("data_split") == "test"), 1000)


@register("period_diagnostic")
def q_period_diag(spark, sf_dir):
    return r9(met.period_diagnostic(fixed_scores(spark, sf_dir).filter(F.col("data_split") == "test"), BANDS))


@register("precision_loss")
def q_precision_loss(spark, sf_dir):
    return met.precision_loss(mtx(spark, sf_dir))


def fine_amounts(spark, sf_dir) -> DataFrame:
    """The modelling table with amounts below a cent, so that rounding to two decimals changes something."""
    more = ((F.col("transaction_id") % 7) * F.lit("0.001234").cast("decimal(8,6)")).cast("decimal(38,12)")
    return mtx(spark, sf_dir).withColumn("amount_paid", (F.col("amount_paid") + more).cast("decimal(38,12)"))


@register("rounded_control_compare")
def q_rounded_compare(spark, sf_dir):
    t = fine_amounts(spark, sf_dir)
    a = feat.features(t)
    b = feat.features(met.rounded_control(t))
    return r9(met.compare_runs(a, b, "transaction_id", ["amount_paid", "prior_average_amount"],
                               by="payment_currency"))


@register("queue_overlap")
def q_queue_overlap(spark, sf_dir):
    t = fine_amounts(spark, sf_dir)
    full = feat.with_split(feat.features(t), TRAIN_END, VALIDATION_END)
    rounded = feat.with_split(feat.features(met.rounded_control(t)), TRAIN_END, VALIDATION_END)
    model = LogisticModel.fixed(full.filter(F.col("data_split") == "train"))
    sa = model.score(full).filter(F.col("data_split") == "test")
    sb = model.score(rounded).filter(F.col("data_split") == "test")
    return r9(met.queue_overlap(sa, sb))


def three_chunks(f: DataFrame) -> C.TrainConfig:
    """The trainer's settings with a third of the rows per chunk, so that the order of the steps shows."""
    return replace(C.TrainConfig(), chunk_rows=max(1, -(-f.count() // 3)))


def trained(spark, sf_dir) -> tuple[DataFrame, LogisticModel]:
    ensure_checkpoint_dir(spark)
    f = feature_frame(spark, sf_dir).checkpoint(eager=True)  # read once per pass of the trainer
    return f, LogisticModel.fit(f, F.col("data_split") == "train", three_chunks(f))


@register("model_train_coefficients")
def q_train(spark, sf_dir):
    return r9(extreme_coefficients(trained(spark, sf_dir)[1].coefficients(spark)))


@register("model_trained_scores")
def q_trained_scores(spark, sf_dir):
    f, model = trained(spark, sf_dir)
    return model.score(f).select("transaction_id", F.round("review_score", 6).alias("review_score"), "data_split", "model_version")


def many_categories(spark, sf_dir) -> DataFrame:
    """The features with thousands of payment formats: some null, some that training never sees."""
    n = F.col("transaction_id")
    fmt = F.when(n % 89 != 0, F.concat("payment_format", F.lit(" "), (n % 3001).cast("string")))
    return feature_frame(spark, sf_dir).withColumn("payment_format", fmt)


@register("model_design")
def q_design(spark, sf_dir):
    """F8: the active slots of each row and the sum of its z-scored inputs."""
    f = many_categories(spark, sf_dir)
    train = f.filter(F.col("data_split") == "train")
    d = feat.design(f, feat.standardizer(train), feat.vocabulary(train))
    return d.select("transaction_id", F.array_join(F.transform("slots", lambda x: x.cast("string")), ",").alias("slots"),
                    F.round(F.aggregate("z", F.lit(0.0), lambda s, x: s + x), 6).alias("z_sum"))


# --- B: promotion, C: reconciliation / publication, D: data tests -----------------------
from .operators import promotion as pro  # noqa: E402
from .operators import reconcile as rec  # noqa: E402

BATCH = 1000


def staged_world(spark, sf_dir) -> DataFrame:
    """Typed staging rows: every event is an accepted raw record (raw ID = event_id XOR 63)."""
    t = txn(spark, sf_dir)
    return t.select("raw_record_id", F.col("file_id").alias("source_file_id"), "event_time",
                    F.col("from_bank").alias("from_bank_code"), F.col("from_account").alias("from_account_code"),
                    F.col("to_bank").alias("to_bank_code"), F.col("to_account").alias("to_account_code"),
                    "amount_received", "receiving_currency", "amount_paid", "payment_currency", "payment_format",
                    (F.col("is_laundering") == 1).alias("is_laundering"))


def corrections_world(spark, sf_dir) -> DataFrame:
    c = adapter.corrections(events(spark, sf_dir))
    return c.select("correction_id", "target_raw_record_id", "event_time",
                    F.col("from_bank").alias("from_bank_code"), F.col("from_account").alias("from_account_code"),
                    F.col("to_bank").alias("to_bank_code"), F.col("to_account").alias("to_account_code"),
                    "amount_received", "receiving_currency", "amount_paid", "payment_currency", "payment_format",
                    (F.col("is_laundering") == 1).alias("is_laundering"))


def dims_world(spark, sf_dir):
    s, c = staged_world(spark, sf_dir), corrections_world(spark, sf_dir)
    banks = pro.upsert_banks(None, s, c)
    accounts = pro.upsert_accounts(None, banks, s, c)
    return s, c, banks, accounts


def fact_current_world(spark, sf_dir):
    s, c, banks, accounts = dims_world(spark, sf_dir)
    fact = pro.insert_fact(s, banks, accounts)
    latest = pro.with_account_keys(pro.latest_correction(c), banks, accounts)
    return s, c, banks, accounts, pro.apply_corrections(fact, latest)


def fact_with_codes(fact: DataFrame, banks: DataFrame, accounts: DataFrame) -> DataFrame:
    """Fact rows with sender/receiver codes, the input shape of the risk rules.

    Pinned: the rules read them once per count and once per row, and the joins should run once.
    """
    ensure_checkpoint_dir(fact.sparkSession)
    lk = pro.account_lookup(banks, accounts)
    f = lk.select(F.col("account_key").alias("from_account_key"), F.col("bank_code").alias("from_bank"),
                  F.col("account_code").alias("from_account"))
    t = lk.select(F.col("account_key").alias("to_account_key"), F.col("bank_code").alias("to_bank"),
                  F.col("account_code").alias("to_account"))
    return (fact.join(f, "from_account_key").join(t, "to_account_key")
            .select(F.col("source_raw_record_id").alias("transaction_key"), "source_file_id", "event_time",
                    "from_bank", "from_account", "to_bank", "to_account", "amount_paid", "payment_currency",
                    "payment_format", F.col("is_laundering").cast("int").alias("is_laundering"),
                    "current_correction_id").checkpoint(eager=True))


@register("promote_raw_window")
def q_raw_window(spark, sf_dir):
    s = staged_world(spark, sf_dir).withColumn("validation_status", F.lit("accepted"))
    return pro.raw_window(s, 0, BATCH)


@register("promote_correction_window")
def q_corr_window(spark, sf_dir):
    s = staged_world(spark, sf_dir).withColumn("validation_status", F.lit("accepted"))
    first = pro.raw_window(s, 0, BATCH).collect()[0]["raw_through"]
    second = pro.raw_window(s, first, BATCH).select(F.col("raw_through").alias("_rt"))
    fact_before = s.filter(F.col("raw_record_id") <= first).select(F.col("raw_record_id").alias("source_raw_record_id"))
    pending = corrections_world(spark, sf_dir).crossJoin(second)
    return pro.correction_window(pending, fact_before, 0, F.col("_rt"), BATCH)


@register("promote_bank_dim")
def q_bank_dim(spark, sf_dir):
    return pro.upsert_banks(None, staged_world(spark, sf_dir), corrections_world(spark, sf_dir))


@register("promote_account_dim")
def q_account_dim(spark, sf_dir):
    return dims_world(spark, sf_dir)[3]


@register("promote_fact")
def q_fact(spark, sf_dir):
    s, c, banks, accounts = dims_world(spark, sf_dir)
    return pro.insert_fact(s, banks, accounts).withColumn("is_laundering", F.col("is_laundering").cast("int"))


@register("promote_latest_correction")
def q_latest(spark, sf_dir):
    return pro.latest_correction(corrections_world(spark, sf_dir)).select(
        "target_raw_record_id", "correction_id", "event_time", "amount_paid", "payment_currency")


@register("promote_fact_current")
def q_fact_current(spark, sf_dir):
    return fact_current_world(spark, sf_dir)[4].withColumn("is_laundering", F.col("is_laundering").cast("int"))


@register("promote_orphan_corrections")
def q_orphans(spark, sf_dir):
    s, c, banks, accounts = dims_world(spark, sf_dir)
    fact = pro.insert_fact(s, banks, accounts)
    return pro.orphan_corrections(c, fact).agg(F.count(F.lit(1)).alias("orphan_corrections"))


@register("promote_late_rows")
def q_late_rows(spark, sf_dir):
    return pro.late_rows_by_batch(staged_world(spark, sf_dir), 100)


@register("promote_state")
def q_state(spark, sf_dir):
    return pro.advance_state(staged_world(spark, sf_dir), corrections_world(spark, sf_dir))


def faulty_layers(spark, sf_dir):
    """Manifest, raw, staging and core of the rendered files, with planted faults: file 1 lost core rows, file 2
    counts a row too many, file 3 lost staged rows, file 99 never finished loading."""
    raw = cls.with_raw_ids(classified_lines(spark, sf_dir))
    counts = cls.manifest_counts(raw)
    started = spark.createDataFrame([(99,)], "file_id long").select(
        *[F.col(c) if c == "file_id" else F.lit(None).cast("long").alias(c) for c in counts.columns])
    manifest = written(counts.withColumn("total_rows", F.col("total_rows") + (F.col("file_id") == 2).cast("long")).unionByName(started),
                       "manifest")  # a row per file, joined to every layer
    staged = pro.stage(raw).filter(~((F.col("source_file_id") == 3) & F.col("record_hash").startswith("00")))
    core = staged.filter(~((F.col("source_file_id") == 1) & F.col("record_hash").startswith("ff")))
    return manifest, raw, staged, core


@register("reconcile_rows")
def q_reconcile_rows(spark, sf_dir):
    manifest, raw, staged, core = faulty_layers(spark, sf_dir)
    return rec.row_reconciliation(manifest, raw, staged, core, manifest)


@register("quality_gate")
def q_quality_gate(spark, sf_dir):
    manifest = cls.manifest_counts(classified_lines(spark, sf_dir))
    return rec.quality_gate(manifest, manifest)


@register("reconcile_amounts")
def q_reconcile_amounts(spark, sf_dir):
    """With planted faults: cents added to some raw amounts of file 1, core rows of file 2 lost."""
    s, c, banks, accounts, fact = fact_current_world(spark, sf_dir)
    cent = F.when((F.col("source_file_id") == 1) & (F.col("raw_record_id") % 500 == 0), F.lit("0.01").cast("decimal(24,6)")).otherwise(0)
    raw_acc = s.select(F.col("source_file_id").alias("file_id"), "payment_currency", (F.col("amount_paid") + cent).alias("amount_paid"))
    core = fact.filter(~((F.col("source_file_id") == 2) & (F.col("source_raw_record_id") % 700 == 0)))
    return rec.amount_reconciliation(raw_acc, s, pro.latest_correction(c), core, raw_acc.select("file_id"))


@register("reconcile_data_tests")
def q_recon_tests(spark, sf_dir):
    """Amount groups with a non-zero delta; files missing from the row reconciliation or unbalanced."""
    amounts = q_reconcile_amounts(spark, sf_dir)
    d9 = amounts.filter((F.col("raw_staging_delta") != 0) | (F.col("effective_core_delta") != 0)) \
        .agg(F.count(F.lit(1)).alias("failures")).select(F.lit("amount_delta_nonzero").alias("check_name"), "failures")
    manifest, raw, staged, core = faulty_layers(spark, sf_dir)
    rows = rec.row_reconciliation(manifest, raw, staged, core, manifest.filter("file_id <> 4"))  # file 4 is missing
    missing = manifest.select("file_id").join(rows.select("file_id"), "file_id", "left_anti")
    bad = rows.filter(~F.col("is_balanced")).select("file_id").unionByName(missing)
    d10 = bad.agg(F.count(F.lit(1)).alias("failures")) \
        .select(F.lit("file_missing_or_unbalanced").alias("check_name"), "failures")
    return d9.unionByName(d10)


def published_signal(spark, sf_dir) -> DataFrame:
    s, c, banks, accounts, fact = fact_current_world(spark, sf_dir)
    return risk.risk_signal(fact_with_codes(fact, banks, accounts))


@register("publish_currency_diff")
def q_currency_diff(spark, sf_dir):
    s, c, banks, accounts, fact = fact_current_world(spark, sf_dir)
    sig = risk.risk_signal(fact_with_codes(fact, banks, accounts))
    return rec.currency_diff(fact, risk.daily_mart(sig))


@register("publish_daily_metrics")
def q_daily_metrics(spark, sf_dir):
    s, c, banks, accounts, fact = fact_current_world(spark, sf_dir)
    sig = risk.risk_signal(fact_with_codes(fact, banks, accounts))
    mart = risk.daily_mart(sig).join(banks.withColumnRenamed("bank_code", "from_bank"), "from_bank") \
        .withColumnRenamed("bank_key", "from_bank_key").drop("from_bank")
    return rec.daily_metrics(mart, banks)


@register("risk_alerts")
def q_risk_alerts(spark, sf_dir):
    return rec.risk_alerts(published_signal(spark, sf_dir)).select(
        "transaction_key", "event_date", "payment_currency", "amount_paid", "risk_score",
        "high_amount_for_currency_day", "high_hourly_velocity", "repeated_counterparty", "current_correction_id")


@register("risk_evaluation")
def q_risk_evaluation(spark, sf_dir):
    return rec.risk_evaluation(published_signal(spark, sf_dir))


@register("data_checks")
def q_data_checks(spark, sf_dir):
    s, c, banks, accounts, fact = fact_current_world(spark, sf_dir)
    sig = risk.risk_signal(fact_with_codes(fact, banks, accounts))
    mart = risk.daily_mart(sig)
    ev = rec.risk_evaluation(sig)
    checks = [
        rec.check_unique(fact, ["source_raw_record_id"], "fact_unique_source"),
        rec.check_not_null(fact, "from_account_key", "fact_from_account_not_null"),
        rec.check_unique(banks, ["bank_code"], "bank_code_unique"),
        rec.check_unique(accounts, ["bank_key", "account_code"], "account_unique"),
        rec.check_fk(fact, "from_account_key", accounts, "account_key", "fact_from_account_fk"),
        rec.check_fk(fact, "to_account_key", accounts, "account_key", "fact_to_account_fk"),
        rec.check_fk(accounts, "bank_key", banks, "bank_key", "account_bank_fk"),
        rec.check_fk(sig, "transaction_key", fact, "source_raw_record_id", "signal_transaction_fk"),
        rec.check_counts_equal(mart.agg(F.sum("transaction_count").alias("a")),
                               fact.agg(F.count(F.lit(1)).alias("b")), "daily_count_matches_core"),
        rec.check_counts_equal(sig.agg(F.count(F.lit(1)).alias("a")),
                               fact.agg(F.count(F.lit(1)).alias("b")), "risk_covers_core"),
        rec.evaluation_diff(ev, sig).agg(F.count(F.lit(1)).alias("failures"))
           .select(F.lit("risk_evaluation_reconciles").alias("check_name"), "failures"),
    ]
    out = checks[0]
    for ch in checks[1:]:
        out = out.unionByName(ch)
    return out


# --- G: review queue and case browsing, H: exports and report measures -------------------
from .operators import queue as qu  # noqa: E402
from .operators import report as rp  # noqa: E402


def cases_frame(spark, sf_dir, n: int = 1_500) -> DataFrame:
    """Queue cases with the spike rule (no explanation arrays)."""
    t = mtx(spark, sf_dir)
    f = feature_frame(spark, sf_dir)
    model = LogisticModel.fixed(f.filter(F.col("data_split") == "train"))
    q = qu.review_queue(model.score(f), n)
    c = qu.queue_cases(q, t, f)
    ratio = F.when(F.col("prior_average_amount") > 0, F.col("feature_amount_paid") / F.col("prior_average_amount"))
    return c.withColumn("amount_spike_rule", F.coalesce((F.col("prior_transaction_count") >= 5) & (ratio >= 10),
                                                        F.lit(False)))


@register("review_queue")
def q_review_queue(spark, sf_dir):
    c = cases_frame(spark, sf_dir)
    return r9(c.select("review_rank", "transaction_id", "review_score", "data_split", "model_version",
                       "transaction_time", "from_bank", "from_account", "to_bank", "to_account", "amount_paid",
                       "payment_currency", "payment_format", "prior_transaction_count", "prior_average_amount",
                       "is_laundering", "amount_spike_rule"))


@register("case_filter")
def q_case_filter(spark, sf_dir):
    c = qu.filter_cases(cases_frame(spark, sf_dir), rank_max=1000, currency="Euro", search="a3")
    return r9(c.select("review_rank", "transaction_id", "from_bank", "from_account", "payment_currency"))


@register("case_cards")
def q_case_cards(spark, sf_dir):
    return qu.case_cards(cases_frame(spark, sf_dir))


@register("case_top_categories")
def q_case_top(spark, sf_dir):
    c = cases_frame(spark, sf_dir)
    a = qu.top_categories(c, "payment_format").withColumn("field", F.lit("payment_format"))
    b = qu.top_categories(c, "from_bank").withColumn("field", F.lit("from_bank"))
    return a.unionByName(b)


@register("case_timeline")
def q_case_timeline(spark, sf_dir):
    c = cases_frame(spark, sf_dir)
    return qu.timeline(c, qu.filter_cases(c, fmt="ACH"))


@register("case_page")
def q_case_page(spark, sf_dir):
    return r9(qu.page(cases_frame(spark, sf_dir), 2).select("review_rank", "transaction_id", "review_score"))


def published(spark, sf_dir):
    sig = published_signal(spark, sf_dir)
    return sig, risk.daily_mart(sig)


@register("report_totals")
def q_report_totals(spark, sf_dir):
    return rp.totals(published(spark, sf_dir)[1])


@register("report_daily_export")
def q_report_daily(spark, sf_dir):
    return rp.daily_export(published(spark, sf_dir)[1], 300)


@register("report_alert_export")
def q_report_alerts(spark, sf_dir):
    return rp.alert_export(published(spark, sf_dir)[0], 50)


@register("report_fact_daily")
def q_report_fact_daily(spark, sf_dir):
    sig, mart = published(spark, sf_dir)
    return rp.daily_with_hits(sig)


@register("report_alert_sample")
def q_report_sample(spark, sf_dir):
    return rp.alert_sample(published(spark, sf_dir)[0])


@register("report_controls")
def q_report_controls(spark, sf_dir):
    return rp.controls(published(spark, sf_dir)[1])


@register("report_recon_export")
def q_report_recon(spark, sf_dir):
    return rp.recon_export(q_reconcile_amounts(spark, sf_dir))


@register("report_calendar")
def q_report_calendar(spark, sf_dir):
    return rp.calendar(published(spark, sf_dir)[1])


@register("report_measures_by_currency")
def q_report_measures(spark, sf_dir):
    sig, mart = published(spark, sf_dir)
    return r9(rp.measures(rp.daily_with_hits(sig), ["payment_currency"]))


@register("report_daily_change")
def q_report_change(spark, sf_dir):
    return r9(rp.daily_change(published(spark, sf_dir)[1], ["payment_currency"]))


@register("report_format_share")
def q_report_share(spark, sf_dir):
    return r9(rp.format_share(published(spark, sf_dir)[1]))


@register("report_rule_hits")
def q_report_rule_hits(spark, sf_dir):
    sig, mart = published(spark, sf_dir)
    return rp.rule_hits_by_selector(rp.daily_with_hits(sig))


@register("report_alert_quality")
def q_report_alert_quality(spark, sf_dir):
    return r9(rp.alert_quality(rec.risk_evaluation(published(spark, sf_dir)[0]), ["payment_currency"]))


@register("report_currency_leaders")
def q_report_leaders(spark, sf_dir):
    return rp.currency_leaders(published(spark, sf_dir)[1])


@register("report_recent_days")
def q_report_recent(spark, sf_dir):
    return rp.recent_days(published(spark, sf_dir)[1])


@register("report_rule_bounds")
def q_report_bounds(spark, sf_dir):
    sig, mart = published(spark, sf_dir)
    return rp.rule_bounds_violations(rp.daily_with_hits(sig)).agg(F.count(F.lit(1)).alias("violations"))


@register("report_quality_rollup")
def q_report_rollup(spark, sf_dir):
    return rp.quality_rollup(q_reconcile_rows(spark, sf_dir), q_reconcile_amounts(spark, sf_dir))


@register("report_row_balance")
def q_report_balance(spark, sf_dir):
    return rp.row_balance(q_reconcile_rows(spark, sf_dir))


@register("report_quality_status")
def q_report_status(spark, sf_dir):
    """The status over all files, over the balanced file, and over none. The reconciliations (rows per file and
    currency) run once for the three."""
    rows, amounts = written(q_reconcile_rows(spark, sf_dir), "row_recon"), written(q_reconcile_amounts(spark, sf_dir), "amount_recon")
    parts = [rp.quality_status(rows.filter(keep), amounts.filter(keep)).withColumn("files", F.lit(name))
             for name, keep in (("all", "true"), ("balanced", "file_id = 4"), ("none", "false"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("report_export_checks")
def q_report_export_checks(spark, sf_dir):
    """The assertions on a sound export, and on one that holds the cash rows twice."""
    sig, mart = published(spark, sf_dir)
    daily, ctrl = rp.daily_with_hits(sig), rp.controls(mart)
    twice = daily.unionByName(daily.filter("payment_format = 'Cash'"))
    return rp.check_export(daily, ctrl).withColumn("export", F.lit("sound")).unionByName(
        rp.check_export(twice, ctrl).withColumn("export", F.lit("doubled")))


@register("report_selection")
def q_report_selection(spark, sf_dir):
    daily = rp.daily_with_hits(published(spark, sf_dir)[0])
    picks = (("Euro", "Cheque"), ("US Dollar", None), ("Not present", None))
    parts = [r9(rp.selection(daily, currency=c, fmt=f)).withColumn("picked", F.lit(f"{c}/{f or 'any'}")) for c, f in picks]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("report_captions")
def q_report_captions(spark, sf_dir):
    sig, mart = published(spark, sf_dir)
    return rp.captions(mart, rp.alert_sample(sig).count(), 1, "2024-02-01 00:00:00")


def correction_lines(spark, sf_dir) -> DataFrame:
    """Correction lines rendered from the events, with a fault by ID."""
    c = adapter.corrections(events(spark, sf_dir))
    r = F.col("correction_id") % 9
    cents = lambda x: F.col(x).cast("decimal(18,2)").cast("string")
    target = F.col("target_raw_record_id").cast("string")
    fields = [
        F.when(r == 1, F.lit("0")).when(r == 3, F.lit("x1")).when(r == 5, F.concat(F.lit('"'), target, F.lit('"')))
        .when(r == 7, F.concat(F.lit(" +"), target)).otherwise(target),
        F.when(r == 6, F.lit("2024/02/30 10:00")).otherwise(F.date_format("event_time", "yyyy/MM/dd HH:mm")),
        F.col("from_bank"), F.when(r == 6, F.lit(" ")).otherwise(F.col("from_account")), F.col("to_bank"), F.col("to_account"),
        cents("amount_received"), F.col("receiving_currency"), cents("amount_paid"), F.col("payment_currency"),
        F.when(r == 8, F.concat(F.lit('"'), F.col("payment_format"), F.lit(', again"'))).otherwise(F.col("payment_format")),
    ]
    label = F.col("is_laundering").cast("int").cast("string")
    text = F.concat_ws(",", *fields, F.when(~r.isin(2, 3), label))
    return c.select("correction_id", F.when(r == 4, F.concat(F.lit('"'), text)).otherwise(text).alias("raw_text"))


@register("correction_errors")
def q_correction_errors(spark, sf_dir):
    """Error and parsed target of each correction line."""
    return cls.parse_corrections(correction_lines(spark, sf_dir)).select("correction_id", "target_raw_record_id", "error",
                                               F.col("payload.payment_format").alias("payment_format"))


from . import queries_checks, queries_more, queries_state  # noqa: E402, F401  (they register further queries)
