"""Operators on small fixtures against brute-force Python (the reference's test model)."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark import config as C
from ledgerlark.functions import contract
from ledgerlark.operators import classify as cls
from ledgerlark.operators import metrics as met
from ledgerlark.operators import risk
from ledgerlark.operators.scale import assign_ids, grouped_cumsum
from ledgerlark.sources import lines as src


def brute_ap_auc(scores, labels):
    pos = sum(labels)
    neg = len(labels) - pos
    ap, seen_tp, seen = 0.0, 0, 0
    for s in sorted(set(scores), reverse=True):
        grp = [l for x, l in zip(scores, labels) if x == s]
        seen += len(grp)
        seen_tp += sum(grp)
        if pos:
            ap += sum(grp) / pos * seen_tp / seen
    # mid-rank AUC
    pairs = sorted(zip(scores, labels))
    ranks, i = {}, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        ranks[pairs[i][0]] = (i + 1 + j) / 2.0
        i = j
    auc = None
    if pos and neg:
        auc = (sum(ranks[s] for s, l in zip(scores, labels) if l) - pos * (pos + 1) / 2) / (pos * neg)
    return ap, auc


def test_rank_metrics_match_brute_force(spark):
    """F14/F15 checked independently."""
    rnd = random.Random(7)
    rows = [(i, round(rnd.random(), 1), int(rnd.random() < 0.2), i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "transaction_id long, review_score double, is_laundering int, g int")
    got = {r["g"]: r for r in met.rank_metrics(df, ["g"]).collect()}
    for g in range(3):
        sc = [r[1] for r in rows if r[3] == g]
        lb = [r[2] for r in rows if r[3] == g]
        ap, auc = brute_ap_auc(sc, lb)
        assert got[g]["average_precision"] == pytest.approx(ap, abs=1e-12)
        assert got[g]["roc_auc"] == pytest.approx(auc, abs=1e-12)


def test_rank_metrics_edge_cases(spark):
    df = spark.createDataFrame([(1, 0.5, 0), (2, 0.4, 0)], "transaction_id long, review_score double, is_laundering int")
    r = met.rank_metrics(df).collect()[0]
    assert r["average_precision"] == 0.0 and r["roc_auc"] is None
    with pytest.raises(ValueError):
        met.check_metric_input(df.limit(0))
    bad = spark.createDataFrame([(1, float("nan"), 0)], "transaction_id long, review_score double, is_laundering int")
    with pytest.raises(ValueError):
        met.check_metric_input(bad)


def test_ranking_at_k_ties_by_id(spark):
    rows = [(i, 1.0 if i < 6 else 0.1, int(i in (4, 5, 7))) for i in range(10)]
    df = spark.createDataFrame(rows, "transaction_id long, review_score double, is_laundering int")
    r = met.ranking_at_k(df, ks=(4, 6, 100)).collect()[0]
    assert (r["found_at_4"], r["found_at_6"], r["found_at_100"]) == (0, 2, 3)


def test_grouped_cumsum_and_ids(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.randint(1, 9)) for g in ("a", "b", "hot") for i in range(40 if g != "hot" else 400)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    out = grouped_cumsum(df, ["g"], ["o"], "v", "cv", inclusive=False, num_partitions=7).collect()
    exp, run = {}, {}
    for g, o, v in sorted(rows):
        exp[(g, o)] = run.get(g, 0)
        run[g] = run.get(g, 0) + v
    assert {(r["g"], r["o"]): r["cv"] for r in out} == exp
    ids = assign_ids(df, ["g", "o"], "id", start_after=10, num_partitions=5).collect()
    order = sorted((r["g"], r["o"]) for r in ids)
    assert sorted((r["id"], (r["g"], r["o"])) for r in ids) == [(11 + k, key) for k, key in enumerate(order)]


def test_percent_rank_matches_window(spark):
    rnd = random.Random(5)
    rows = [(f"2024-01-0{1 + i % 3} 10:00:00", "Euro" if i % 2 else "US Dollar", float(rnd.randint(1, 30)))
            for i in range(300)]
    df = spark.createDataFrame(rows, "t string, payment_currency string, a double").select(
        F.col("t").cast("timestamp_ntz").alias("event_time"), "payment_currency",
        F.col("a").cast("decimal(24,6)").alias("amount_paid"))
    got = {(str(r["event_date"]), r["payment_currency"], float(r["amount_paid"])): r["amount_percent_rank"]
           for r in risk.amount_percent_rank(risk.with_event_date(df)).collect()}
    from pyspark.sql import Window
    w = Window.partitionBy("event_date", "payment_currency").orderBy("amount_paid")
    ref = risk.with_event_date(df).withColumn("pr", F.percent_rank().over(w)).collect()
    for r in ref:
        assert got[(str(r["event_date"]), r["payment_currency"], float(r["amount_paid"]))] == pytest.approx(r["pr"])


LINES = [
    ("2022/09/01 00:20,010,8000EBD30,010,8000EBD30,3697.34,US Dollar,3697.34,US Dollar,Reinvestment,0", []),
    ("2022-09-01 00:20:00,010,A,010,B,1,Bitcoin,0.000001,Bitcoin,Wire,1", []),
    ("2022/13/01 00:20,010,A,010,B,1.00,US Dollar,1.00,US Dollar,ACH,0", ["invalid_timestamp"]),
    ("2022/09/01 00:20,010, ,010,B,1.00,US Dollar,1.000,US Dollar,ACH,2",
     ["missing_from_account", "invalid_amount_paid", "invalid_laundering_label"]),
    ("2022/09/01 00:20,010,A,010,B,NaN,US Dollar,-1,US Dollar,ACH,0", ["invalid_amount_received", "invalid_amount_paid"]),
    ("2022/09/01 00:20,010,A,010,B,1,US Dollar,1,US Dollar,ACH", [C.WIDTH_REASON]),
    ('"2022/09/01 00:20,010,A,010,B,1,US Dollar,1,US Dollar,ACH,0', [C.MALFORMED_REASON]),
    ("", [C.WIDTH_REASON]),
    ('2022/09/01 00:20,"010",A,010,B,"1,000.00",US Dollar,1,US Dollar,ACH,0', ["invalid_amount_received"]),
]


def test_contract_reason_codes(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LINES)], "source_row_number long, raw_text string")
    got = {r["source_row_number"]: list(r["reason_codes"]) for r in contract.parse_frame(df).collect()}
    for i, (_, expected) in enumerate(LINES):
        assert got[i] == expected, LINES[i][0]


def test_record_hash_is_sorted_compact_json(spark):
    import hashlib
    import json
    line = LINES[0][0]
    df = spark.createDataFrame([(1, line)], "source_row_number long, raw_text string")
    h = contract.parse_frame(df).collect()[0]["record_hash"]
    payload = dict(zip(C.KEYS, [v.strip() for v in line.split(",")]))
    expected = hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert h == expected


def test_classify_duplicates_and_replay(spark):
    a, b = LINES[0][0], LINES[1][0]
    rows = [(1, 2, a), (1, 3, b), (1, 4, a), (1, 5, LINES[2][0]), (1, 6, LINES[2][0])]
    df = spark.createDataFrame(rows, "file_id long, source_row_number long, raw_text string")
    parsed = cls.parse_lines(df)
    got = {r["source_row_number"]: r["validation_status"] for r in cls.classify(parsed).collect()}
    assert got == {2: C.ACCEPTED, 3: C.ACCEPTED, 4: C.DUPLICATE, 5: C.REJECTED, 6: C.REJECTED}
    seen = parsed.filter("source_row_number = 3").select("record_hash")
    got2 = {r["source_row_number"]: r["validation_status"] for r in cls.classify(parsed, seen).collect()}
    assert got2[3] == C.DUPLICATE and got2[2] == C.ACCEPTED


def test_scan_lines_exact_numbers_across_splits(spark, tmp_path):
    body = [f"line {i}," + "x" * (i % 50) for i in range(5000)]
    p = tmp_path / "big_Trans.csv"
    p.write_text("﻿" + "header\r\n" + "\r\n".join(body) + "\r\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        out = src.scan_lines(spark, [str(p)]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    nums = {r["line_number"]: r["raw_text"] for r in out}
    assert len(nums) == 5001 and nums[1] == "header"
    assert all(nums[i + 2] == body[i] for i in range(5000))


def test_discover_and_fingerprint(spark, tmp_path):
    import hashlib
    (tmp_path / "b_Trans.csv").write_text("x\n")
    (tmp_path / "a_Trans.csv").write_text("yy\n")
    (tmp_path / "other.csv").write_text("z\n")
    paths = src.discover(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a_Trans.csv", "b_Trans.csv"]
    fp = {r["path"].rsplit("/", 1)[1]: r for r in src.fingerprint(spark, paths).collect()}
    assert fp["a_Trans.csv"]["sha256"] == hashlib.sha256(b"yy\n").hexdigest()
    assert fp["a_Trans.csv"]["byte_size"] == 3


def test_generator_and_csv_round_trip(spark):
    g = src.generate(spark, 25_000)
    r = g.agg(F.countDistinct(F.to_date("event_time")).alias("days"),
              F.min("amount_paid").alias("lo"), F.max("amount_paid").alias("hi")).collect()[0]
    assert (r["days"], float(r["lo"]), float(r["hi"])) == (3, 1.0, 1000.0)
    text = src.to_csv_lines(g.limit(50)).select(F.lit(1).alias("file_id"),
                                                F.monotonically_increasing_id().alias("source_row_number"),
                                                "raw_text")
    assert cls.parse_lines(text).filter(F.size("reason_codes") > 0).count() == 0


def test_artifact_digest_binds_lineage(spark):
    scores = spark.createDataFrame([(i, float(i) / 3, i % 2) for i in range(100)], "transaction_id long, review_score double, is_laundering int")
    features = spark.createDataFrame([(i, None if i % 3 else "x", None) for i in range(100)], "transaction_id long, a string, b string")
    metrics = met.bound_evaluation(scores, features, ks=(5,))
    met.check_lineage(metrics, scores.orderBy(F.desc("transaction_id")).repartition(7), features)   # order-free
    swapped = features.select("transaction_id", F.col("b").alias("a"), F.col("a").alias("b"))
    for bad in ((scores.filter("transaction_id > 0"), features), (scores.unionByName(scores.limit(1)), features), (scores, swapped)):
        with pytest.raises(ValueError, match="differ"):
            met.check_lineage(metrics, *bad)


def test_document_is_whole_or_absent(spark, tmp_path):
    from ledgerlark.sources import documents
    rows = spark.createDataFrame([(i, "é\n" if i % 2 else None) for i in range(50)], "n long, t string").repartition(4)
    head = spark.createDataFrame([(7, None)], "id long, note string")
    path = str(tmp_path / "doc")
    with pytest.raises(Exception):
        documents.write_document(path, head, {"a": rows, "b": rows.select(F.raise_error(F.lit("stop")).alias("x"))})
    assert not (tmp_path / "doc").exists()
    documents.write_document(path, head, {"a": rows})
    assert sorted(map(str, documents.read_document(spark, path, "a", rows.schema).collect())) == sorted(map(str, rows.collect()))
    assert documents.read_document(spark, path, "header", head.schema).collect() == head.collect()
    with pytest.raises(FileExistsError):
        documents.write_document(path, head, {"a": rows})


def test_star_keeps_quality_apart_from_dates():
    from ledgerlark.operators import star
    named = lambda *names: [star.Relation(n, None, "", None, "") for n in names]
    assert star.separated(named("daily.date", "quality.file", "reconciliation.currency"))
    assert not star.separated(named("quality.date")) and not star.separated(named("daily.rule"))


def test_case_gates(spark):
    from ledgerlark.operators import queue as qu
    c = spark.createDataFrame([(1, 0.0), (2, 1e-7), (3, 0.0)], "review_rank int, score_reconstruction_gap double")
    qu.check_cases(c)
    qu.check_cases(c.limit(0))
    for bad in (c.filter("review_rank <> 2"), c.unionByName(c.limit(1)), c.selectExpr("review_rank + 1 as review_rank", "score_reconstruction_gap"),
                c.selectExpr("review_rank", "score_reconstruction_gap + 2e-5 as score_reconstruction_gap")):
        with pytest.raises(ValueError):
            qu.check_cases(bad)


def test_id_windows_by_bins(spark):
    from ledgerlark.operators import promotion as pro
    ids = sorted(random.Random(2).sample(range(1, 5000), 400))
    df = spark.createDataFrame([(i,) for i in ids], "raw_record_id long").repartition(5)
    for limit in (1, 7, 250, 399, 400, 1000, None):
        for size in (10, 64, 1 << 20):
            assert pro.last_of_first(df, "raw_record_id", limit, size).first()[0] == ids[min(limit or 400, 400) - 1]
    assert pro.last_of_first(df.limit(0), "raw_record_id", 5).first()[0] is None
    raw = df.withColumn("validation_status", F.when(F.col("raw_record_id") % 2 == 0, C.ACCEPTED).otherwise(C.REJECTED))
    even = [i for i in ids if i % 2 == 0 and i > 100]
    assert tuple(pro.raw_window(raw, 100, 10).first()) == (100, even[9]) and tuple(pro.raw_window(raw, 9999, 10).first()) == (9999, 9999)
