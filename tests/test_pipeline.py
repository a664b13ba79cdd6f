"""Stateful plans end to end: load, replay, correct, block, repair, publish (A, B, C, D)."""

import datetime as dt

import pytest

from ledgerlark import config as C
from ledgerlark.plans.pipeline import Pipeline

HEADER = ",".join(C.HEADERS)


def rows(n, start=0, day=1):
    out = []
    for i in range(start, start + n):
        t = dt.datetime(2022, 9, day, 0, 0) + dt.timedelta(minutes=7 * i)
        cur = "US Dollar" if i % 3 else "Euro"
        amt = f"{(i % 50) + 1}.{i % 100:02d}"
        out.append(f"{t:%Y/%m/%d %H:%M},B{i % 4},A{i % 9},B{(i + 1) % 4},C{i % 11},{amt},{cur},{amt},{cur},ACH,{int(i % 20 == 0)}")
    return out


def write(path, lines, bom=True):
    path.write_text(("﻿" if bom else "") + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_recovery_scenario(spark, tmp_path):
    """Load, replay, correct, block a publication, repair."""
    p = Pipeline(spark, str(tmp_path / "store"))
    land = tmp_path / "land"
    land.mkdir()
    f1 = write(land / "a_Trans.csv", [HEADER, *rows(60)])
    r1 = p.ingest_file(f1)
    assert r1["status"] == "completed" and r1["accepted_rows"] == 60 and r1["total_rows"] == 60
    # Replay: the same content is skipped under the same file ID (A5).
    assert p.ingest_file(f1) == {"file_id": r1["file_id"], "status": "skipped"}
    assert p.health().first()["status"] == "AWAITING PROMOTION"
    with pytest.raises(RuntimeError):
        p.publish()                                        # C1: promotion pending
    runs = p.catch_up(raw_limit=25)
    assert [r["status"] for r in runs] == ["promoted"] * 3 + ["skipped"]
    assert p.fact_current().count() == 60
    pub = p.publish()
    assert pub["status"] == "published" and pub["signal_rows"] == 60
    assert p.publish()["status"] == "skipped"              # C3
    assert p.health().first()["status"] == "PUBLISHED"

    # Second file: 5 new rows, one invalid row and one exact duplicate of file 1.
    bad = rows(1, 201)[0].rsplit(",", 1)[0] + ",2"
    f2 = write(land / "b_Trans.csv", [HEADER, *rows(5, 100, day=2), bad, rows(1)[0]])
    r2 = p.ingest_file(f2)
    assert (r2["accepted_rows"], r2["rejected_rows"], r2["duplicate_candidates"]) == (5, 1, 1)

    # Corrections on raw IDs 1 and 2 (the later one wins on ID 1).
    corr_header = ",".join((C.CORRECTION_TARGET_HEADER, *C.HEADERS))
    c1 = rows(1)[0].replace(",1.00,", ",9.99,")
    c2 = rows(2)[1]
    c3 = rows(1)[0].replace(",1.00,", ",11.11,")
    cf = write(land / "corr.csv", [corr_header, f"1,{c1}", f"2,{c2}", f"1,{c3}"])
    rc = p.ingest_corrections(cf)
    assert rc["corrections"] == 3
    # One bad row fails the whole correction file.
    cbad = write(land / "corr_bad.csv", [corr_header, f"1,{c1}", f"0,{c2}"])
    with pytest.raises(ValueError, match="row 3"):
        p.ingest_corrections(cbad)

    p.catch_up()
    cur = p.fact_current()
    assert cur.count() == 65
    row1 = cur.filter("source_raw_record_id = 1").collect()[0]
    assert str(row1["amount_paid"]) == "11.110000" and row1["current_correction_id"] == 3

    # A failing gate leaves the published snapshot untouched.
    before = p.read_published("signal")
    before_rows = before.collect()
    strict = Pipeline(spark, str(tmp_path / "store"), policy=C.QualityPolicy(max_rejected_fraction=0.0))
    with pytest.raises(RuntimeError, match="quality policy"):
        strict.publish()
    after = p.read_published("signal")
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0
    assert len(before_rows) == 60
    assert p.health().first()["status"] == "FAILED FILES"  # the refused correction file outranks the refused publication
    recon = {r["file_id"]: r["is_balanced"] for r in p.read_published("row_reconciliation").collect()}
    assert recon and all(recon.values())

    # Repair: publish with the default policy (1 of 7 rows rejected is above 5 %, so relax it).
    ok = Pipeline(spark, str(tmp_path / "store"), policy=C.QualityPolicy(max_rejected_fraction=0.2))
    pub2 = ok.publish()
    assert pub2["status"] == "published"
    sig = ok.read_published("signal")
    assert sig.count() == 65
    mart = ok.read_published("mart")
    assert mart.agg({"transaction_count": "sum"}).collect()[0][0] == 65
    assert ok.health().first()["status"] == "FAILED FILES" and ok.health().first()["failed_correction_files"] == 1
    assert ok.read_published("amount_reconciliation").filter("effective_core_delta <> 0 or raw_staging_delta <> 0").count() == 0
    # D3: every full-run check passes after the repair.
    checks = {r["check_name"]: r["passed"] for r in ok.verify_run(min_source_rows=60).collect()}
    assert len(checks) == 12 and all(checks.values()), checks


def test_header_mismatch_fails_file(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "store"))
    f = write(tmp_path / "x_Trans.csv", ["Timestamp,From Bank", *rows(3)])
    with pytest.raises(ValueError, match="header_mismatch"):
        p.ingest_file(f)
    m = p.manifest().collect()
    assert m[0]["status"] == "failed"
    assert p.health().first()["status"] == "FAILED FILES"


def test_backfill_range_checks(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "store"))
    assert p.health().first()["status"] == "NO DATA"
    p.ingest_file(write(tmp_path / "y_Trans.csv", [HEADER, *rows(10)]))
    with pytest.raises(ValueError):
        p.promote(mode="incremental", backfill=(0, 5))
    with pytest.raises(ValueError):
        p.promote(mode="backfill", backfill=(5, 2))
    with pytest.raises(ValueError):
        p.promote(mode="backfill", backfill=(0, 99))
    r = p.promote(mode="backfill", backfill=(0, 4))
    assert r["staged_rows"] == 4
    # Backfill does not move the incremental cursor; the next incremental run is idempotent.
    r2 = p.promote()
    assert r2["staged_rows"] == r2["fact_rows"] == 6 and p.fact_current().count() == 10
    assert p.health().first()["status"] == "AWAITING PUBLICATION"


def test_failed_load_is_never_read(spark, tmp_path, monkeypatch):
    p = Pipeline(spark, str(tmp_path / "store"))
    f = write(tmp_path / "z_Trans.csv", [HEADER, *rows(5)])
    monkeypatch.setattr(Pipeline, "_assert_unchanged", lambda *a: (_ for _ in ()).throw(RuntimeError("source_changed_during_load")))
    with pytest.raises(RuntimeError, match="changed"):
        p.ingest_file(f)
    monkeypatch.undo()
    assert p.promote()["status"] == "skipped" and p.publish()["status"] == "skipped"
    assert p.health().first()["status"] == "FAILED FILES"
    # the same rows in another file are no duplicates of the failed load, and the failed file can be loaded again
    assert p.ingest_file(write(tmp_path / "w_Trans.csv", [HEADER, *rows(4)]))["accepted_rows"] == 4
    assert p.ingest_file(f)["duplicate_candidates"] == 4
    p.catch_up()
    assert p.fact_current().count() == 5
    assert p.publish()["status"] == "published" and p.publish()["status"] == "skipped"


def test_publish_on_unusual_stores(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "store"), policy=C.QualityPolicy(max_rejected_fraction=1.0))
    assert p.publish()["status"] == "skipped"
    bad = [",".join(["x"] * 11)] * 2
    p.ingest_file(write(tmp_path / "a_Trans.csv", [HEADER, *bad]))
    assert p.promote()["status"] == "skipped"
    with pytest.raises(RuntimeError, match="quality policy"):
        Pipeline(spark, str(tmp_path / "store")).publish()
    assert p.publish()["signal_rows"] == 0
    p.ingest_file(write(tmp_path / "b_Trans.csv", [HEADER, *rows(3)]))
    with pytest.raises(ValueError):
        p.promote(raw_limit=0)
    p.catch_up(raw_limit=2)
    assert p.publish()["signal_rows"] == 3
    # a file of duplicates only
    p.ingest_file(write(tmp_path / "c_Trans.csv", [HEADER, *rows(3), ""]))
    p.catch_up()
    assert p.health().first()["status"] == "AWAITING PUBLICATION"
    assert p.publish()["affected_days"] == 0 and p.read_published("signal").count() == 3
    assert p.health().first()["status"] == "PUBLISHED" and p.read_published("row_reconciliation").count() == 3
    # a backfill leads to a publication
    p.promote(mode="backfill", backfill=(2, 5))
    assert p.publish()["affected_days"] >= 1


def test_publications_merge_on_read(spark, tmp_path):
    """Partitioned fact, correction deltas and their compaction, index of publications, snapshots, correction backfill."""
    from ledgerlark.operators import snapshot
    from ledgerlark.plans.pipeline import SNAPSHOT_KEYS
    p = Pipeline(spark, str(tmp_path / "store"))
    p.ingest_file(write(tmp_path / "a_Trans.csv", [HEADER, *rows(6, day=1), *rows(6, 50, day=2), *rows(6, 80, day=3)]))
    p.catch_up()
    p.publish()
    first = {t: d.checkpoint(eager=True) for t, d in p.snapshot().items()}
    p.save_snapshot("before")
    assert p.changed_since("before").count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        p.save_snapshot("before")
    header = ",".join((C.CORRECTION_TARGET_HEADER, *C.HEADERS))
    moved = rows(1)[0].replace("2022/09/01 00:00", "2022/09/03 00:00")   # row 1 moves to another day
    p.ingest_corrections(write(tmp_path / "c1.csv", [header, f"1,{moved}"]))
    p.catch_up()
    plan = p.fact_current([dt.date(2022, 9, 3)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [source_date" in plan and "2022-09-02" not in plan
    assert p.fact_current([dt.date(2022, 9, 3)]).count() == 7 and p.fact_current([dt.date(2022, 9, 1)]).count() == 5
    before = sorted(map(tuple, p.fact_current().collect()), key=str)
    assert p.compact_corrections() == 1 and sorted(map(tuple, p.fact_current().collect()), key=str) == before
    pub = p.publish()
    assert (pub["affected_days"], pub["affected_files"], pub["publication_id"]) == (2, 1, 2)
    index = {(r["kind"], r["key"]): r["v"] for r in p.published_index().collect()}
    assert index == {("day", "2022-09-01"): 2, ("day", "2022-09-02"): 1, ("day", "2022-09-03"): 2, ("file", "1"): 2}
    signal = p.read_published("signal")
    assert signal.count() == 18 and str(signal._jdf.queryExecution().analyzed()).count("Relation [") == 2  # the table and its index
    second = p.snapshot()
    changed = {r["table_name"]: r["is_equal"] for r in snapshot.compare(first, second, SNAPSHOT_KEYS).collect()}
    assert sorted(r[0] for r in p.changed_since("before").collect()) == sorted(t for t, same in changed.items() if not same)
    assert changed["signal"] is False and changed["index"] is False and changed["row_reconciliation"] is True
    with pytest.raises(ValueError):
        p.promote(mode="backfill", correction_backfill=(0, 9))
    again = p.promote(mode="backfill", correction_backfill=(0, 1))
    assert again["corrections_applied"] == 0 and p.fact_current().count() == 18
