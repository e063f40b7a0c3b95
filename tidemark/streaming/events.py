"""Streaming over event tables: windowed counts with late data, sessions, and idempotent batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import keep_last


def stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed(events: DataFrame, ts: str = "ts", size: str = "1 hour", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Counts and sums by window and type; the same rows from a stream (with a watermark) and from a table."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("_ts", late) if events.isStreaming else timed
    w = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    return timed.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n", "total")


def sessions(events: DataFrame, ts: str = "ts", gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("_ts", late) if events.isStreaming else timed
    return timed.groupBy(F.session_window("_ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def latest_by_key(path: str, key: str, order: str):
    """A sink for ``foreachBatch``: each batch's last rows by key, under the batch's number, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        keep_last(batch, [key], order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
