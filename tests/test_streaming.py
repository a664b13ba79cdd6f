"""Landing stream (Spark-side option): two triggers, each file loaded once."""

from ledgerlark.plans.pipeline import Pipeline
from ledgerlark.streaming.landing import start_landing_stream
from test_pipeline import HEADER, rows, write


def test_landing_stream_available_now(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    store, ckpt = str(tmp_path / "store"), str(tmp_path / "ckpt")
    write(land / "a_Trans.csv", [HEADER, *rows(20)])
    q = start_landing_stream(spark, str(land), store, ckpt)
    q.awaitTermination(600)
    p = Pipeline(spark, store)
    assert p.health().first()["status"] == "PUBLISHED"
    assert p.read_published("signal").count() == 20
    # A second file arrives; the restarted stream only sees the new one.
    write(land / "b_Trans.csv", [HEADER, *rows(7, 300, day=3)])
    q = start_landing_stream(spark, str(land), store, ckpt)
    q.awaitTermination(600)
    m = p.manifest().collect()
    assert sorted(r["status"] for r in m) == ["completed", "completed"]
    assert p.read_published("signal").count() == 27
