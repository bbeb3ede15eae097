"""An extension beyond the reference's operators: windowed counts of an event stream, late events dropped by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, late: str = "2 hours", width: str = "1 hour") -> DataFrame:
    """(start, event_type, n) of a stream or table of (ts, event_type)."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    counted = events.withWatermark("ts", late) if events.isStreaming else events
    return counted.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
