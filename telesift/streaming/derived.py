"""Stateful streams; each is bounded by a watermark on event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telesift.operators import logs as log_ops
from telesift.operators import span_metrics as metric_ops
from telesift.session import configure
from telesift.streaming.ingest import AVAILABLE


def to_table(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream's rows to Parquet, each once."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE)).start(path)


def span_metrics_stream(spans: DataFrame, delay: str = "10 minutes", **how) -> DataFrame:
    """span_metrics, each window once, when the watermark has passed it."""
    return metric_ops.span_metrics(spans.withWatermark("Timestamp", delay), **how)


def severity_series_stream(logs: DataFrame, delay: str = "10 minutes", width: int = 60) -> DataFrame:
    """severity_series, each interval once, when the watermark has passed it."""
    return log_ops.severity_series(logs.withWatermark("Timestamp", delay), width=width)


def group_by_trace_stream(spans: DataFrame, gap: str = "30 seconds", delay: str = "10 minutes") -> DataFrame:
    """A trace's counts and bounds, when no span of it came for `gap`.

    Only sums and bounds are state, so a giant trace costs no more than a small one; the spans
    themselves stay in the spans table, to be gathered by group_by_trace. The session setting
    that merges a hot trace's sessions on the map side too is part of session.configure.
    """
    configure(spans.sparkSession)
    session = F.session_window("Timestamp", gap)
    return (
        spans.filter(F.col("TraceId") != "")
        .withWatermark("Timestamp", delay)
        .groupBy(session.alias("session"), "TraceId")
        .agg(
            F.count("*").alias("span_count"),
            F.min("TimestampNs").alias("StartNs"),
            F.max(F.col("TimestampNs") + F.col("Duration")).alias("EndNs"),
            F.count_if(F.col("StatusCode") == metric_ops.ERROR).alias("errors"),
        )
        .select("TraceId", "span_count", "StartNs", "EndNs", "errors")
    )


def _clients(traced: DataFrame, delay: str, dimensions: tuple[str, ...]) -> DataFrame:
    failed = F.col("StatusCode") == metric_ops.ERROR
    return (
        traced.filter(F.col("SpanKind") == "SPAN_KIND_CLIENT")
        .select(
            F.col("Timestamp").alias("client_time"), F.col("TraceId").alias("client_trace"), F.col("SpanId").alias("client_id"),
            F.col("ServiceName").alias("client"), failed.alias("client_failed"), F.col("Duration").alias("client_ns"),
            *[metric_ops.dimension(d).alias(f"client_{d}") for d in dimensions],
        )
        .withWatermark("client_time", delay)
    )


def _servers(traced: DataFrame, delay: str, dimensions: tuple[str, ...]) -> DataFrame:
    failed = F.col("StatusCode") == metric_ops.ERROR
    return (
        traced.filter((F.col("SpanKind") == "SPAN_KIND_SERVER") & (F.col("ParentSpanId") != ""))
        .select(
            F.col("Timestamp").alias("server_time"), F.col("TraceId").alias("server_trace"), F.col("SpanId").alias("server_id"),
            F.col("ParentSpanId").alias("server_parent"), F.col("ServiceName").alias("server"),
            failed.alias("server_failed"), F.col("Duration").alias("server_ns"),
            *[metric_ops.dimension(d).alias(f"server_{d}") for d in dimensions],
        )
        .withWatermark("server_time", delay)
    )


def _calls(ttl: str) -> Column:
    span_of = F.expr(f"INTERVAL {ttl}")
    return (
        (F.col("client_trace") == F.col("server_trace")) & (F.col("client_id") == F.col("server_parent"))
        & (F.col("server_time") >= F.col("client_time") - span_of) & (F.col("server_time") <= F.col("client_time") + span_of)
    )


def service_graph_pairs_stream(
    spans: DataFrame, ttl: str = "1 second", delay: str = "1 second", salts: int = 4, dimensions: tuple[str, ...] = ()
) -> DataFrame:
    """Client spans with the server spans they call, paired when both have come within `ttl`, with the graph's dimensions.

    Both sides have a watermark and the join a time range, so unpaired spans leave the state; see unpaired_spans_stream for these.
    A client span is kept once per salt and its children are spread over the salts, so that a client span with countless children
    is not all one task's; the number of salts changes no row.
    """
    traced = spans.filter(F.col("TraceId") != "")
    clients = _clients(traced, delay, dimensions).withColumn("client_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    servers = _servers(traced, delay, dimensions).withColumn("server_salt", F.pmod(F.xxhash64("server_id"), F.lit(salts)).cast("int"))
    return clients.join(servers, _calls(ttl) & (F.col("client_salt") == F.col("server_salt"))).select(
        F.col("client_trace").alias("TraceId"), "client", "server", "client_time", "server_time", "client_ns", "server_ns",
        (F.col("client_failed") | F.col("server_failed")).alias("failed"),
        *[F.col(f"`{side}_{d}`") for d in dimensions for side in ("client", "server")],
    )


def unpaired_spans_stream(spans: DataFrame, ttl: str = "1 second", delay: str = "1 second") -> DataFrame:
    """(side, TraceId, SpanId, ServiceName, Timestamp): client spans that no server span answered within `ttl`, and server spans
    whose client never came, when the watermark has passed the time in which it could have."""
    traced = spans.filter(F.col("TraceId") != "")
    joined = _clients(traced, delay, ()).join(_servers(traced, delay, ()), _calls(ttl), "full_outer")
    alone = F.col("server_id").isNull()
    pick = lambda name: F.when(alone, F.col(f"client{name}")).otherwise(F.col(f"server{name}"))
    return joined.filter(F.col("client_id").isNull() | alone).select(
        F.when(alone, "client").otherwise("server").alias("side"), pick("_trace").alias("TraceId"), pick("_id").alias("SpanId"),
        pick("").alias("ServiceName"), pick("_time").alias("Timestamp"),
    )


def edges_of(pairs: DataFrame, dimensions: tuple[str, ...] = (), bounds_ms: tuple[float, ...] | None = None) -> DataFrame:
    """Edges of the service graph from stored pairs, with the dimensions these were made with, and latency buckets if asked for."""
    buckets = []
    for side in ("client", "server") if bounds_ms else ():
        counts = [F.count_if(c) for c in metric_ops.bucket_conditions(F.col(f"{side}_ns"), bounds_ms)]
        buckets.append(F.array(*counts).alias(f"{side}_bucket_counts"))
    return pairs.groupBy("client", "server", *[F.col(f"`{side}_{d}`") for d in dimensions for side in ("client", "server")]).agg(
        F.count("*").alias("calls"),
        F.count_if("failed").alias("failed"),
        F.sum("client_ns").alias("client_duration_ns"),
        F.sum("server_ns").alias("server_duration_ns"),
        *buckets,
    )
