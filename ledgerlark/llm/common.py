"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Give Python workers this package (as ``--py-files`` would); once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="ledgerlark-"), "ledgerlark_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._ledgerlark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, which cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` written as a table in buckets of ``key`` (as many as shuffle partitions): joins and groups on
    ``key`` then move the other side only. The files are in the shared folder, the name in the session's catalog."""
    spark = df.sparkSession
    table_name = f"ledgerlark_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).option("path", scratch(spark, name)).format("parquet").saveAsTable(table_name)
    return spark.table(table_name)


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """As ``pinned``; the shuffle files that made it go at once, not when the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return pinned(df.select("*"))  # the setting is read when a frame is made
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def freed(*frames: DataFrame) -> None:
    """Delete the files of checkpoints (of ``pinned`` or ``settled``) that nothing reads any more."""
    for df in frames:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def keyed(documents: DataFrame) -> DataFrame:
    """(row, id, key): whole rows as a struct, so that no name clashes, with their ID and text hash."""
    return documents.select(F.struct(*(f"`{c}`" for c in documents.columns)).alias("row")).select(
        "row", F.col("row.doc_id").alias("id"), F.xxhash64(text_or_empty("row.text")).alias("key"))


_KEPT: dict = {}


def kept(name: str, build: Callable):
    """What this Python worker keeps from task to task: the tables of one operator, built anew after another's."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = build()
    return _KEPT[name]


def small_slices(batches: Iterator[pa.RecordBatch], column: str,
                 max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        col = batch.column(column)
        rows, start, size = batch.num_rows, 0, 0
        if col.nbytes <= max_bytes:
            if rows:
                yield batch
            continue
        sizes = pc.binary_length(col).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start, rows - start)


def map_texts(df: DataFrame, fn: Callable[[list], list[pa.Array]], schema: str, text: str = "text",
              key: str = "doc_id") -> DataFrame:
    """``schema`` is ``key`` and then the arrays that ``fn`` returns for a list of texts."""
    from pyspark.sql.types import _parse_datatype_string  # public parser of DDL schemas
    struct = _parse_datatype_string(schema)
    names = struct.fieldNames()

    def run(batches):
        for b in small_slices(batches, text):
            yield pa.RecordBatch.from_arrays([b.column(key), *fn(b.column(text).to_pylist())], names=names)

    return df.select(key, F.col(text)).mapInArrow(run, struct)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (u, v long): (node, root), root the smallest node.

    Alternating large-star and small-star rounds. A round takes the smallest neighbour per node by a
    partial aggregate and joins it back on a side with one row per node, so a node of very high
    degree is summed map-side and its rows can be split. Each round is pinned by a reliable
    checkpoint, and the files of the round before are deleted; nothing but a row count and a checksum reaches the driver.
    """
    both = lambda e: e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        near = both(e) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = near.join(low, "u")
        out = joined.filter(F.col("v") > F.col("u")) if large else joined
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            out = out.unionByName(low.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = settled(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v").distinct())
    seen = mark(e)
    for _ in range(max_rounds if seen[0] else 0):
        last, e = e, settled(star(star(e, True), False))
        freed(last)
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()
