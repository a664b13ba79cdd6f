"""Parquet table store with append logs, versioned snapshots and atomic pointers.

Layout under ``root`` (any Hadoop file system path):
  <table>/                      append-only tables (manifest, raw, runs, logs)
  <name>/<table>/v=<n>/         immutable versions of a table; all versions read as one, partitioned by v
  _pointers/<name>.<n>          one empty marker per committed version

A version becomes visible only when its marker is created, by renaming a finished
temporary file to a name that did not exist before (atomic on HDFS and local disks).
Readers take the highest marker, so a failed publish leaves the earlier version.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop_path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop_path(self.root).getFileSystem(conf)

    # --- paths -----------------------------------------------------------------------
    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._hadoop_path(self.path(*parts)))

    # --- append tables ---------------------------------------------------------------
    def read(self, table: str, schema: str | None = None) -> DataFrame | None:
        if not self.exists(table):
            return self.spark.createDataFrame([], schema) if schema else None
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path(table))

    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(table))

    def overwrite_partitions(self, table: str, df: DataFrame, partition_by: list[str]) -> None:
        """Replace only the partitions present in ``df`` (C6 delete + insert by key)."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(self.path(table)))

    def write_once(self, table: str, df: DataFrame) -> None:
        """Refuse to overwrite an existing artifact."""
        df.write.mode("errorifexists").parquet(self.path(table))

    def append_rows(self, table: str, rows: list[dict], schema: str) -> None:
        """Append a few control rows (run logs, manifest events); absent fields are null."""
        names = [f.strip().split(" ")[0] for f in schema.split(",")]
        tuples = [tuple(r.get(n) for n in names) for r in rows]
        self.append(table, self.spark.createDataFrame(tuples, schema).coalesce(1))

    # --- versioned snapshots -------------------------------------------------------------
    def current_version(self, name: str) -> int | None:
        d = self._hadoop_path(self.path("_pointers"))
        if not self._fs.exists(d):
            return None
        best = None
        for st in self._fs.listStatus(d):
            fname = st.getPath().getName()
            if fname.startswith(name + ".") and not fname.endswith(".tmp"):
                try:
                    v = int(fname[len(name) + 1:])
                except ValueError:
                    continue
                best = v if best is None or v > best else best
        return best

    def next_version(self, name: str) -> int:
        v = self.current_version(name)
        return 1 if v is None else v + 1

    def version_path(self, name: str, table: str, version: int) -> str:
        return self.path(name, table, f"v={version}")

    def write_version_table(self, name: str, table: str, version: int, df: DataFrame,
                            partition_by: list[str] | None = None) -> None:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.version_path(name, table, version))

    def commit_version(self, name: str, version: int, info: dict | None = None) -> None:
        """Make ``version`` current: write a temp marker, then rename it to its final name."""
        d = self.path("_pointers")
        tmp = self._hadoop_path(f"{d}/{name}.{version}.tmp")
        final = self._hadoop_path(f"{d}/{name}.{version}")
        if self._fs.exists(final):
            raise RuntimeError(f"version {version} of {name} is already committed")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(info or {}).encode()))
        out.close()
        if not self._fs.rename(tmp, final):
            raise RuntimeError(f"could not commit version {version} of {name}")

    def read_pointer(self, name: str, version: int) -> dict:
        """The JSON document committed with ``version``."""
        stream = self._fs.open(self._hadoop_path(f"{self.path('_pointers')}/{name}.{version}"))
        reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
            self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = []
        line = reader.readLine()
        while line is not None:
            text.append(line)
            line = reader.readLine()
        reader.close()
        return json.loads("\n".join(text) or "{}")

    def read_version(self, name: str, table: str, version: int, schema: str | StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.version_path(name, table, version))

    def read_versions(self, name: str, table: str, schema: StructType) -> DataFrame:
        """All versions of a table as one scan, with the partition column ``v``."""
        return self.spark.read.schema(StructType([*schema.fields, StructField("v", LongType())])).parquet(self.path(name, table))
