"""Streamed digests, numbered lines, headers and the index of accepted hashes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import hashindex
from ledgerlark.sources import lines as src

FILES = {"plain": b"a,b\nc,d\n", "open_end": b"a,b\nc,d", "crlf": b"a\r\nb\r\n", "marked": b"\xef\xbb\xbfa\nb\n",
         "marked_open": b"\xef\xbb\xbfa\nb", "blank_lines": b"\n\n\na\n\n", "one_feed": b"\n", "one_byte": b"x", "empty": b"",
         "not_utf8": b"\xff\xfe\n\x80\n", "long": b"".join(b"line %d," % i + b"x" * (i % 700) + b"\n" for i in range(9000))}


@pytest.mark.parametrize("limit,split", [(1 << 26, "64m"), (0, "64m"), (0, "16k"), (100, "1m")])
def test_digests(spark, tmp_path, limit, split):
    for name, content in FILES.items():
        (tmp_path / f"{name}_Trans.csv").write_bytes(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["path"].rsplit("/", 1)[1][:-10]: (r["sha256"], r["byte_size"])
               for r in src.fingerprint(spark, src.discover(spark, str(tmp_path)), cell_limit=limit).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {n: (hashlib.sha256(c).hexdigest(), len(c)) for n, c in FILES.items()}
    assert got == want


def test_streamed_digests_hold_nothing(spark, tmp_path):
    """No sort and no shuffle of the lines, a task per file, every split in its place."""
    want = {}
    for name in ("a", "b", "c"):
        content = b"".join(b"%s,%d\n" % (name.encode(), i) * (1 + i % 3) for i in range(40_000))
        (tmp_path / f"{name}_Trans.csv").write_bytes(content)
        want[name] = (hashlib.sha256(content).hexdigest(), len(content))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        got = src.fingerprint(spark, src.discover(spark, str(tmp_path)), cell_limit=0)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Exchange" not in plan
        assert got.rdd.getNumPartitions() > len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["path"].rsplit("/", 1)[1][0]: (r["sha256"], r["byte_size"]) for r in rows} == want


def test_first_line_and_header(spark, tmp_path):
    f = tmp_path / "a_Trans.csv"
    for content, header in ((b"\xef\xbb\xbfx,y\n1,2\n", None), (b"x,z\n", 'header_mismatch: expected ["x","y"]; got ["x","z"]'),
                            (b'"x,y\n', 'header_mismatch: expected ["x","y"]; got "x,y')):
        f.write_bytes(content)
        assert src.header_status(src.first_line(spark, str(f)), ("x", "y")).collect()[0]["error"] == header
    f.write_bytes(b"")
    assert src.first_line(spark, str(f)).collect() == []


def hashes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "n string").select(F.sha2("n", 256).alias("record_hash"))


def test_index_finds_what_was_accepted(spark, tmp_path):
    raw = hashes(spark, map(str, range(3000))).withColumn("file_id", F.lit(1).cast("long")) \
        .withColumn("validation_status", F.when(F.col("record_hash") < "8", "accepted").otherwise("rejected"))
    hashindex.index_rows(raw).write.partitionBy("prefix").parquet(str(tmp_path / "index"))
    index = spark.read.schema(hashindex.SCHEMA).parquet(str(tmp_path / "index"))
    incoming = hashes(spark, map(str, range(2500, 5000)))
    incoming = incoming.unionByName(incoming)
    want = {h for h in (hashlib.sha256(str(i).encode()).hexdigest() for i in range(2500, 3000)) if h < "8"}
    got = [r[0] for r in hashindex.seen(index, incoming).collect()]
    assert set(got) == want and len(got) == len(want)
    assert hashindex.seen(index, incoming.limit(0)).count() == 0 and hashindex.seen(index.limit(0), incoming).count() == 0


def test_a_small_load_reads_only_its_prefixes(spark, tmp_path):
    raw = hashes(spark, map(str, range(3000))).selectExpr("record_hash", "1L as file_id", "'accepted' as validation_status")
    hashindex.index_rows(raw).write.partitionBy("prefix").parquet(str(tmp_path / "index"))
    index = spark.read.schema(hashindex.SCHEMA).parquet(str(tmp_path / "index"))
    one = hashes(spark, ["7"])
    plan = hashindex.seen(index, one)._jdf.queryExecution().executedPlan().toString()
    assert hashindex.touched(one) == [hashlib.sha256(b"7").hexdigest()[:hashindex.PREFIX_DIGITS]]
    assert "PartitionFilters: [" in plan and f"= {hashindex.touched(one)[0]})" in plan


def test_filter_is_exact_when_it_is_full(spark, monkeypatch):
    monkeypatch.setattr(hashindex, "FILTER_WORDS", 1)
    index = hashindex.index_rows(hashes(spark, map(str, range(500))).selectExpr("record_hash", "1L as file_id", "'accepted' as validation_status"))
    assert hashindex.seen(index, hashes(spark, map(str, range(400, 900)))).count() == 100
