"""Loads of messages into tables: one parse, one job, for batches and streams alike."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from telesift.operators import bounds as bounds_ops
from telesift.sources import otlp, tables


def load_records(
    messages: DataFrame, signal: str, path: str, promote: dict[str, list[str]] | None, batch_id: int, writer: str = tables.LOADS
) -> dict[str, int]:
    """Store what a signal's table takes, and aside what it doesn't; how many rows went where, counted as they were written."""
    counted = Observation()
    refused = F.col(otlp.REASON).isNotNull()
    rows = otlp.judged(messages, signal).observe(counted, F.count_if(~refused).alias("stored"), F.count_if(refused).alias("refused"))
    write = {"traces": tables.write_spans, "logs": tables.write_logs, "metrics": tables.write_metric_points}[signal]
    write(rows, path, promote, batch_id, writer)
    try:
        return counted.get
    except Py4JJavaError:
        # The write went through; of rows that Spark found to be none before it came to count them there are no counts.
        return {"stored": 0, "refused": 0}


def load_spans(
    messages: DataFrame, path: str, bounds: str | None, promote: dict[str, list[str]] | None, batch_id: int, writer: str = tables.LOADS
) -> dict[str, int]:
    """The same for spans; the traces' partial bounds are then worked out from the spans as stored, not from the messages."""
    counts = load_records(messages, "traces", path, promote, batch_id, writer)
    if bounds is not None and counts["stored"]:
        stored = tables.batch_of(messages.sparkSession, path, batch_id, writer)
        tables.write_bounds(bounds_ops.trace_bounds(stored), bounds, batch_id, writer)
    return counts
