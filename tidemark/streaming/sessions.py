"""Streams: intervals of activity merged as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_sessions(events: DataFrame, gap: str = "10 minutes", late: str = "30 minutes", key: str = "user_id") -> DataFrame:
    """Per key, events less than `gap` apart as one session: key, start, end, n, total. On a stream, sessions close once the watermark passes."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    by = rows.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return by.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def merge_islands(intervals: DataFrame, keys: tuple[str, ...] = ("chrom",), gap: int = 0, late: int = 100_000) -> DataFrame:
    """Intervals that overlap, meet or are at most `gap` apart as one, on a stream or a table: keys, start, end, n, as merge_intervals gives them.

    An interval is a session that lasts as long as the interval itself, so the gap comes from the data. Places stand for seconds: on
    a stream an island closes once places come that lie `late` beyond it; what begins before that is late and left out. Empty
    intervals and rows with a null key or place count for nothing.
    """
    named = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    rows = intervals.where("start < `end`").where(named).withColumn("_at", F.timestamp_seconds("start"))
    if rows.isStreaming:
        rows = rows.withWatermark("_at", f"{late} seconds")
    lasts = F.concat((F.col("end") - F.col("start") + gap).cast("string"), F.lit(" seconds 1 microseconds"))  # sessions that only meet would stay apart
    by = rows.groupBy(*keys, F.session_window("_at", lasts).alias("w")).agg(F.max("end").cast("long").alias("end"), F.count(F.lit(1)).alias("n"))
    return by.select(*keys, F.unix_seconds("w.start").alias("start"), "end", "n")


def windowed_counts(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "30 minutes") -> DataFrame:
    """Events and their sum by type and window: event_type, start, n, total."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    by = rows.groupBy("event_type", F.window("ts", size, slide or size).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return by.select("event_type", F.col("w.start").alias("start"), "n", "total")


def stream_table(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
