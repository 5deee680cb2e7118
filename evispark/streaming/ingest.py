"""Streaming ingest: records that come in files, each kept once, with aggregates over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet", files_per_trigger: int = 100) -> DataFrame:
    """Events of a folder's Parquet files as a stream; zoneless times count as UTC, since watermarks need an instant."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def once(stream: DataFrame, key: list[str], time: str = "ts", late: str | None = None) -> DataFrame:
    """Rows whose key has not come before.

    Without `late` every key is kept in state for good: no row is lost, however old its time and whatever batch it comes in.
    With `late`, as an endless stream needs, state older than that goes; then rows older than the watermark of an earlier batch
    are dropped, whether their key has come before or not."""
    if late is None:
        return stream.dropDuplicates(key)
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def counts(stream: DataFrame, time: str = "ts", window: str = "1 day", late: str = "1 day") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, window), "event_type").agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there into Parquet files, exactly once for a checkpoint, and end."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def each_batch(stream: DataFrame, work, checkpoint: str) -> StreamingQuery:
    """work(batch, id) for every batch; a batch that is tried again has the same id."""
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
