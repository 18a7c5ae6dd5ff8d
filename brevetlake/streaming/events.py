"""Streams of events: counts in windows of event time, late events bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of events as a stream, with the schema of those that are there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day", by: str = "event_type") -> DataFrame:
    """window_start, `by`, n and total of each window; the same plan for a table and for a stream."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    out = events.groupBy(F.window("ts", width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def run_to_memory(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """All that a stream has to give now, as a table."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
