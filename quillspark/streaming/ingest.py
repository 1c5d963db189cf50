"""Streaming forms of ingest and ledger rollup, with Structured Streaming's own state.

An extension: the order-aware near-duplicate rule looks at all of the past and stays a batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(files: DataFrame, time_col: str = "modificationTime", within: str = "7 days") -> DataFrame:
    """Files whose content was not seen within a time: exact duplicates go, and state is bounded by the watermark."""
    hashed = files if "sha256" in files.columns else files.withColumn("sha256", F.sha2("content", 256))
    return hashed.withWatermark(time_col, within).dropDuplicatesWithinWatermark(["sha256"])


def spend(calls: DataFrame, time_col: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Calls, tokens and cost by stage and window; rows later than `late` are left out."""
    return (
        calls.withWatermark(time_col, late)
        .groupBy(F.window(time_col, width).alias("window"), "stage")
        .agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost_usd").alias("cost_usd"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "stage", "calls", "input_tokens", "output_tokens", "cost_usd")
    )
