"""Continuous ingestion and running reports with Structured Streaming."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from billflow.plans.store import StagingStore

def document_stream(spark: SparkSession, directory: str, schema: str,
                    files_per_batch: int | None = None, source: str = "parquet") -> DataFrame:
    """New files of a directory as a stream of documents."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(source).load(directory)


def _trigger(pace: str | None) -> dict:
    return {"availableNow": True} if pace is None else {"processingTime": pace}


def stream_ingest(documents: DataFrame, store: StagingStore, checkpoint: str,
                  pace: str | None = None) -> StreamingQuery:
    """Validate, route and upsert each micro-batch, each at most once. The writer's name is the checkpoint,
    whose numbers start again with it."""
    writer = f"stream {checkpoint}"

    def load(batch: DataFrame, number: int) -> None:
        # a file is often one split: its documents are validated by all cores, not by one for each file; a batch
        # of many splits is not moved
        cores = batch.sparkSession.sparkContext.defaultParallelism
        spread = batch.repartition(cores) if batch.rdd.getNumPartitions() < cores else batch
        store.load(spread, number, writer=writer)

    return (documents.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(**_trigger(pace)).start())


def stream_dedup(documents: DataFrame, event_time: str, delay: str,
                 key: str = "invoice_hash") -> DataFrame:
    """Drop re-delivered documents. Use the arrival time: rows later than ``delay`` are lost,
    and what slips through is caught by the keyed upsert."""
    timed = documents.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 pace: str | None = None) -> StreamingQuery:
    """Stream into Parquet: ``append`` adds files, ``complete`` rewrites each batch's result."""
    if mode == "append":
        return (stream.writeStream.format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint)
                .trigger(**_trigger(pace)).start())

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.outputMode("complete").foreachBatch(replace)
            .option("checkpointLocation", checkpoint).trigger(**_trigger(pace)).start())


def latest_result(spark: SparkSession, path: str) -> DataFrame:
    """The last complete result written by :func:`run_to_table`."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("batch_id") == rows.agg(F.max("batch_id")).scalar()).drop("batch_id")


def wait_for_rows(query: StreamingQuery, path: str, schema, n_rows: int,
                  seconds: float = 600.0) -> DataFrame:
    """The rows that a running stream has written once there are so many; stops the stream."""
    stop = time.monotonic() + seconds
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    try:
        while time.monotonic() < stop:
            if query.lastProgress is not None:
                rows = spark.read.schema(schema).parquet(path)
                if rows.count() >= n_rows:
                    return rows
            if query.exception() is not None:
                raise query.exception()
            time.sleep(0.5)
    finally:
        query.stop()
    raise TimeoutError(f"{path} has fewer than {n_rows} rows after {seconds} seconds")


def observed_batches(query: StreamingQuery, name: str) -> list[dict]:
    """What each micro-batch with rows has reported under this name (as many as the session keeps)."""
    told = []
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        if row is not None and progress.numInputRows:
            told.append({"batch_id": progress.batchId, **row.asDict()})
    return told
