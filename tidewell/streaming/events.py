"""Windowed counts over a stream of events, with late rows dropped by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema, pattern: str = "events*.parquet") -> DataFrame:
    """A stream of the Parquet files that arrive in ``folder``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows and values of each kind of event in each window; works on streams and on tables."""
    ts = F.col("ts").cast("timestamp")
    rows = events.withColumn("ts", ts).withWatermark("ts", late)
    out = rows.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
