"""Landing-folder stream: new transaction files are ingested, promoted and published.

A Structured Streaming file source tracks which files were already seen (in its
checkpoint, which must be on the shared file system). Each micro-batch carries
the paths of new files, one row per file, from the listing alone; ``foreachBatch``
runs the batch plans on them. The plans are idempotent by file
SHA-256 and by raw/correction ID, so a batch replayed after a failure is safe.

No watermark is set on purpose: late rows must load (they are counted as late by
promotion, never dropped), and duplicates are classified against every accepted
row ever loaded, not only those inside a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Pipeline


def landing_batch(pipeline: Pipeline, publish: bool = True):
    """foreachBatch body: ingest every new file in path order, catch up, publish."""
    def run(batch: DataFrame, batch_id: int) -> None:
        paths = [r[0] for r in batch.select("path").distinct().orderBy("path").collect()]
        if not paths:
            return
        for path in paths:
            pipeline.ingest_file(path)
        pipeline.catch_up()
        if publish:
            pipeline.publish()
    return run


def start_landing_stream(spark: SparkSession, landing_dir: str, store_root: str, checkpoint: str,
                         pattern: str = "*Trans.csv", available_now: bool = True,
                         max_files_per_trigger: int | None = None, publish: bool = True) -> StreamingQuery:
    """Start the landing stream; with ``available_now`` it processes what is there and stops."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(landing_dir).select("path")  # the content column is not read
    pipeline = Pipeline(spark, store_root)
    writer = (files.writeStream.foreachBatch(landing_batch(pipeline, publish))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
