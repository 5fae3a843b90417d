"""Structured Streaming forms of the live counters, budgets and progress views.

Each takes a streaming (or batch) DataFrame and returns one; sinks and checkpoints are the caller's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "video_id STRING, event_type STRING, progress INT, amount DOUBLE, status STRING, ts TIMESTAMP"


def read_events(spark: SparkSession, path: str, schema: str = EVENT, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def counts_by_video(events: DataFrame) -> DataFrame:
    """Events per video and type: small state, one row per pair."""
    return events.groupBy("video_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, width: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """Events per video and tumbling window; rows later than ``late`` are dropped by the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "video_id").agg(F.count(F.lit(1)).alias("n")).select("video_id", F.col("window.start").alias("start"), "n")


def review_progress(events: DataFrame) -> DataFrame:
    """Total, decided and pending items per video; a review is done when pending is 0."""
    decided = F.count_if(F.col("status").isin("approved", "rejected"))
    return events.groupBy("video_id").agg(F.count(F.lit(1)).alias("total"), decided.alias("decided"), (F.count(F.lit(1)) - decided).alias("pending"))


def latest_state(events: DataFrame) -> DataFrame:
    """The newest progress of each video."""
    return events.groupBy("video_id").agg(F.max_by("progress", "ts").alias("progress"), F.max("ts").alias("ts"))


def budget_state(events: DataFrame, limit: float, warn: float = 0.9) -> DataFrame:
    """Money spent per video, with its state against the limit."""
    spent = events.groupBy("video_id").agg(F.sum("amount").alias("spent"))
    return spent.withColumn("state", F.when(F.col("spent") > limit, "exceeded").when(F.col("spent") > limit * warn, "warning").otherwise("ok"))


def run_available(result: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> None:
    """Process what is there and stop; a restart continues from the checkpoint."""
    result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start().awaitTermination()
