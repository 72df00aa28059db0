"""Time bounds of traces. Only min and max, so every groupBy combines on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trace_bounds(spans: DataFrame) -> DataFrame:
    """Per trace the first and the last span start."""
    return (
        spans.filter(F.col("TraceId") != "")
        .groupBy("TraceId")
        .agg(F.min("Timestamp").alias("Start"), F.max("Timestamp").alias("End"))
    )


def merge_trace_bounds(partials: DataFrame) -> DataFrame:
    """One row per trace from the partial rows that separate loads appended."""
    return partials.groupBy("TraceId").agg(F.min("Start").alias("Start"), F.max("End").alias("End"))


def trace_bounds_exact(spans: DataFrame) -> DataFrame:
    """Per trace the first span start and the last span end, in nanoseconds."""
    return (
        spans.filter(F.col("TraceId") != "")
        .groupBy("TraceId")
        .agg(
            F.min("TimestampNs").alias("StartNs"),
            F.max(F.col("TimestampNs") + F.col("Duration")).alias("EndNs"),
        )
    )
