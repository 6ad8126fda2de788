"""Usage metrics per hour and provider from a stream of call records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_usage(calls: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Requests, successes, failures, tokens, cost and latency per window and provider.

    On a stream, records later than ``late`` behind the newest are dropped and a window
    is final once the watermark passes its end, so state holds open windows only.
    """
    timed = calls.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", late).groupBy(F.window("ts", width), "provider").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("error").isNull()).alias("successful_requests"),
        F.count_if(F.col("error").isNotNull()).alias("failed_requests"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("total_prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("total_completion_tokens"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"),
        F.coalesce(F.sum("latency"), F.lit(0.0)).alias("total_latency"),
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "provider",
        "total_requests", "successful_requests", "failed_requests", "total_prompt_tokens",
        "total_completion_tokens", "total_cost", "total_latency",
    )


def write_hourly_usage(calls: DataFrame, path: str, checkpoint: str, late: str = "10 minutes"):
    """Append finished windows to a Parquet table; reads what is there and stops."""
    return (
        hourly_usage(calls, late).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
