"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is fully executed into a no-op sink (every row produced, nothing collected).
The stateful pipeline is timed too, as in the published baseline: one transaction CSV
file rendered from the whole events table (untimed) is ingested, promoted in batches of
50,000 raw IDs and published (pipeline_ingest / pipeline_promote / pipeline_publish).
The reported value is the sum of all wall times after one warm-up query.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlark import config as C  # noqa: E402
from ledgerlark import queries as Q  # noqa: E402
from ledgerlark.plans.pipeline import Pipeline  # noqa: E402
from ledgerlark.session import build_session  # noqa: E402
from ledgerlark.sources import adapter  # noqa: E402
from ledgerlark.sources import lines as src  # noqa: E402


def pipeline_times(spark, sf_dir: str) -> dict:
    scratch = tempfile.mkdtemp(prefix="ledgerlark-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    t = adapter.transactions(Q.events(spark, sf_dir))
    body = src.to_csv_lines(t.orderBy("event_id")).select(
        F.lit(1).alias("k"), F.monotonically_increasing_id().alias("o"), "raw_text")
    header = spark.createDataFrame([(0, 0, ",".join(C.HEADERS))], "k int, o long, raw_text string")
    (header.unionByName(body).repartition(1).sortWithinPartitions("k", "o").select("raw_text")
     .write.text(f"{scratch}/landing"))
    path = glob.glob(f"{scratch}/landing/part-*")[0]
    p = Pipeline(spark, f"{scratch}/store")
    out = {}
    t0 = time.time()
    p.ingest_file(path)
    out["pipeline_ingest"] = round(time.time() - t0, 3)
    t0 = time.time()
    p.catch_up(raw_limit=50_000)
    out["pipeline_promote"] = round(time.time() - t0, 3)
    t0 = time.time()
    if p.publish()["status"] != "published":
        raise RuntimeError("bench publication did not publish")
    out["pipeline_publish"] = round(time.time() - t0, 3)
    return out

HEADLINE = (
    "ingest_records", "risk_signal", "daily_mart", "investigate_usd_spikes",
    "model_features", "model_scores", "evaluate_test", "review_queue",
    "promote_fact_current", "reconcile_amounts", "report_fact_daily",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = list(HEADLINE)
    if unknown := [n for n in names if n not in Q.REGISTRY]:
        raise KeyError(f"unknown headline queries: {unknown}")
    Q.REGISTRY["investigate_period"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        Q.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    times.update(pipeline_times(spark, sf_dir))
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
