"""Metrics derived from spans: request counts and latencies, and the graph of calling services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.functions import times

# Fixed value: bounds of the sample service graph, in milliseconds.
GRAPH_BOUNDS_MS = (1.0, 2.0, 3.0, 4.0, 5.0)
ERROR = "STATUS_CODE_ERROR"


def _bounds_ns(bounds_ms) -> list[int]:
    return [int(round(b * 1_000_000)) for b in bounds_ms]


def bucket_conditions(duration: Column, bounds_ms) -> list[Column]:
    """One condition per bucket, upper bound inclusive; the last is everything above."""
    bounds = _bounds_ns(bounds_ms)
    conditions = [duration <= bounds[0]]
    conditions += [(duration > low) & (duration <= high) for low, high in zip(bounds, bounds[1:])]
    return conditions + [duration > bounds[-1]]


def dimension(name: str) -> Column:
    return F.coalesce(F.col("SpanAttributes")[name], F.col("ResourceAttributes")[name], F.lit(""))


def span_metrics(
    spans: DataFrame, dimensions: tuple[str, ...] = (), bounds_ms=(2.0, 10.0, 100.0, 1000.0), width: int = 60
) -> DataFrame:
    """Calls, total duration and latency buckets per window, service, operation, kind and status."""
    keys = ["ServiceName", "SpanName", "SpanKind", "StatusCode"]
    interval = F.window("Timestamp", f"{width} seconds").alias("interval")
    duration = F.col("Duration")
    counts = [F.count_if(c).alias(f"_b{i}") for i, c in enumerate(bucket_conditions(duration, bounds_ms))]
    grouped = spans.groupBy(interval, *keys, *[dimension(d).alias(d) for d in dimensions]).agg(
        F.count("*").alias("calls"), F.sum("Duration").alias("duration_sum_ns"), *counts
    )
    return grouped.select(
        F.col("interval.start").alias("window_start"),
        *keys,
        *[F.col(f"`{d}`") for d in dimensions],
        "calls",
        "duration_sum_ns",
        F.array(*[f"_b{i}" for i in range(len(counts))]).alias("bucket_counts"),
    )


def client_server_pairs(spans: DataFrame) -> DataFrame:
    """Client spans joined to the server spans they are the parent of, one row per pair."""
    traced = spans.filter(F.col("TraceId") != "")
    clients = traced.filter(F.col("SpanKind") == "SPAN_KIND_CLIENT").select(
        "TraceId", F.col("SpanId").alias("ParentSpanId"), F.col("ServiceName").alias("client")
    )
    servers = traced.filter((F.col("SpanKind") == "SPAN_KIND_SERVER") & (F.col("ParentSpanId") != "")).select(
        "TraceId", "ParentSpanId", "SpanId", F.col("ServiceName").alias("server")
    )
    return servers.join(clients, ["TraceId", "ParentSpanId"])


def service_graph(
    spans: DataFrame,
    dimensions: tuple[str, ...] = ("k8s.cluster.id", "k8s.namespace.name"),
    bounds_ms=GRAPH_BOUNDS_MS,
) -> DataFrame:
    """Edges between services: a client span and the server spans that are its children.

    Both sides are combined per (trace, client span) before the join, so that a client span
    with countless children is one row per called service when it is shuffled. A pair fails
    if either of its spans does.
    """
    traced = spans.filter(F.col("TraceId") != "")
    duration = F.col("Duration")
    conditions = bucket_conditions(duration, bounds_ms)
    dims = {d: dimension(d) for d in dimensions}
    clients = (
        traced.filter(F.col("SpanKind") == "SPAN_KIND_CLIENT")
        .groupBy("TraceId", "SpanId", F.col("ServiceName").alias("client"),
                 *[c.alias(f"client_{d}") for d, c in dims.items()])
        .agg(
            F.count("*").alias("client_spans"),
            F.count_if(F.col("StatusCode") == ERROR).alias("client_failed"),
            F.sum("Duration").alias("client_ns"),
            *[F.count_if(c).alias(f"client_b{i}") for i, c in enumerate(conditions)],
        )
    )
    servers = (
        traced.filter((F.col("SpanKind") == "SPAN_KIND_SERVER") & (F.col("ParentSpanId") != ""))
        .groupBy("TraceId", F.col("ParentSpanId").alias("SpanId"), F.col("ServiceName").alias("server"),
                 *[c.alias(f"server_{d}") for d, c in dims.items()])
        .agg(
            F.count("*").alias("server_spans"),
            F.count_if(F.col("StatusCode") == ERROR).alias("server_failed"),
            F.sum("Duration").alias("server_ns"),
            *[F.count_if(c).alias(f"server_b{i}") for i, c in enumerate(conditions)],
        )
    )
    # Of m client rows and n server rows under one id there are m*n pairs; a pair is well only
    # if both sides are, so failures are what is left of the pairs.
    pairs = F.col("client_spans") * F.col("server_spans")
    well = (F.col("client_spans") - F.col("client_failed")) * (F.col("server_spans") - F.col("server_failed"))

    def summed(side: str, other: str, column: str) -> Column:
        return F.sum(F.col(f"{side}_{column}") * F.col(f"{other}_spans"))

    buckets = range(len(conditions))
    keys = ["client", "server"] + [f"`{side}_{d}`" for d in dimensions for side in ("client", "server")]
    edges = (
        servers.join(clients, ["TraceId", "SpanId"])
        .groupBy(*[F.col(k) for k in keys])
        .agg(
            F.sum(pairs).alias("calls"),
            F.sum(pairs - well).alias("failed"),
            summed("client", "server", "ns").alias("client_duration_ns"),
            summed("server", "client", "ns").alias("server_duration_ns"),
            *[summed("client", "server", f"b{i}").alias(f"_c{i}") for i in buckets],
            *[summed("server", "client", f"b{i}").alias(f"_s{i}") for i in buckets],
        )
    )
    return edges.select(
        *[F.col(k) for k in keys],
        "calls", "failed", "client_duration_ns", "server_duration_ns",
        F.array(*[f"_c{i}" for i in buckets]).alias("client_bucket_counts"),
        F.array(*[f"_s{i}" for i in buckets]).alias("server_bucket_counts"),
    )


def count_signals(
    df: DataFrame, by: list[str], conditions: dict[str, Column] | None = None
) -> DataFrame:
    """Rows per group, and per named condition the rows that meet it."""
    extra = [F.count_if(c).alias(name) for name, c in (conditions or {}).items()]
    return df.groupBy(*by).agg(F.count("*").alias("count"), *extra)


def interval_counts(df: DataFrame, by: list[str], width: int = 60, column: str = "Timestamp") -> DataFrame:
    """Rows per epoch-aligned interval and group."""
    start = times.interval_start(F.col(column), width).alias("interval_start")
    return df.groupBy(start, *by).agg(F.count("*").alias("count"))
