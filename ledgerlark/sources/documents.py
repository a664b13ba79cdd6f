"""Snapshot documents: parts written in parallel as JSON lines beside a small header, committed by one rename (H5).

Layout: <path>/header (one line) and <path>/<part> (JSON lines, one file per task). A document becomes visible as a whole
when its finished folder is renamed to its name; a name that exists is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    made = jvm.org.apache.hadoop.fs.Path
    return made, made(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_document(path: str, header: DataFrame, parts: dict[str, DataFrame]) -> None:
    """``header``: one row. Nothing is visible at ``path`` before everything is written."""
    spark = header.sparkSession
    made, fs = _file_system(spark, path)
    if fs.exists(made(path)):
        raise FileExistsError(path)
    unfinished = f"{path.rstrip('/')}.unfinished-{uuid.uuid4().hex}"
    for name, df in parts.items():
        df.write.option("ignoreNullFields", "false").json(f"{unfinished}/{name}")
    header.coalesce(1).write.option("ignoreNullFields", "false").json(f"{unfinished}/header")
    if not fs.rename(made(unfinished), made(path)):
        raise RuntimeError(f"could not commit {path}")


def read_document(spark: SparkSession, path: str, part: str, schema) -> DataFrame:
    """A part (or ``header``) with the schema it was written with."""
    return spark.read.schema(schema).json(f"{path}/{part}")
