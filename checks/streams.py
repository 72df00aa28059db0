"""Streams over the events file, run to its end; each must give what its batch operator gives.

Windows and sessions are written when the watermark has passed them, so the SQL leaves out those
that end after it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.ingest import FNV_SQL
from checks.metrics import BOUNDS, COUNTS_SQL, GRAPH_SQL
from checks.registry import query
from checks.traces import BOUNDS_SQL, micros
from checks.views import duck
from telesift.operators import bounds
from telesift.session import scratch_path
from telesift.sources import tables
from telesift.streaming import assembly, derived, ingest

LAST_SQL = "(SELECT max(\"Timestamp\") FROM spans_v)"


def _spans(v):
    return v.spans_of(v.event_stream())


def _finish(v, start, *names: str):
    """Run a stream to the end of its input; `start` gets fresh folders, the table's first."""
    paths = [scratch_path(v.spark, name) for name in names]
    start(*paths).awaitTermination()
    return paths[0]


@query("stream_ingest", duck("spans_v", """SELECT ServiceName, SpanKind, count(*) AS spans, sum(Duration)::BIGINT AS ns
  FROM spans_v GROUP BY 1, 2"""))
def _(v):
    # Four files, or one for a million events, so that a batch of two doesn't grow with the table.
    messages = v.written(v.trace_messages, max(4, -(-v.event_count // 2**20)))
    path = _finish(
        v, lambda table, checkpoint: ingest.stream_ingest(
            ingest.message_stream(v.spark, messages, files_per_batch=2), "traces", table, checkpoint),
        "spans", "checkpoint",
    )
    return tables.read_table(v.spark, path).groupBy("ServiceName", "SpanKind").agg(
        F.count("*").alias("spans"), F.sum("Duration").alias("ns")
    )


@query("two_streams_one_table", duck("spans_v", """SELECT ServiceName, count(*) AS spans, sum(Duration)::BIGINT AS ns
  FROM spans_v GROUP BY 1"""))
def _(v):
    # Each stream takes half of the messages, and both number their batches from 0.
    table = scratch_path(v.spark, "spans")
    # Made once: made again, a message may hold its spans in another order, and its hash be of the other half.
    messages = v.spark.read.text(v.written(v.trace_messages)).withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2)))
    for half in range(2):
        source = v.written(messages.filter(F.col("half") == half).select("value"))
        stream = ingest.message_stream(v.spark, source)
        ingest.stream_ingest(stream, "traces", table, scratch_path(v.spark, "checkpoint")).awaitTermination()
    return tables.read_table(v.spark, table).groupBy("ServiceName").agg(F.count("*").alias("spans"), F.sum("Duration").alias("ns"))


@query("stream_trace_bounds", duck("spans_v", "SELECT TraceId, epoch_us(s) AS start_us, epoch_us(e) AS end_us FROM b", b=BOUNDS_SQL))
def _(v):
    path = _finish(v, lambda table, checkpoint: ingest.stream_trace_bounds(_spans(v), table, checkpoint), "bounds", "checkpoint")
    merged = bounds.merge_trace_bounds(tables.read_table(v.spark, path))
    return merged.select("TraceId", micros("Start").alias("start_us"), micros("End").alias("end_us"))


@query("stream_span_metrics", duck("spans_v", f"""SELECT epoch_us("Timestamp") // 3600000000 * 3600 AS window_s, ServiceName, SpanName, SpanKind,
  StatusCode, count(*) AS calls, sum(Duration)::BIGINT AS duration_sum_ns, {COUNTS_SQL} AS buckets FROM spans_v
  WHERE (epoch_us("Timestamp") // 3600000000 + 1) * 3600000000 <= epoch_us({LAST_SQL}) - 600000000 GROUP BY ALL"""))
def _(v):
    stream = derived.span_metrics_stream(_spans(v), bounds_ms=BOUNDS, width=3600)
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "metrics", "checkpoint")
    return tables.read_table(v.spark, path).select(
        F.unix_seconds("window_start").alias("window_s"), "ServiceName", "SpanName", "SpanKind", "StatusCode", "calls",
        "duration_sum_ns", F.concat_ws(",", F.col("bucket_counts").cast("array<string>")).alias("buckets"),
    )


@query("stream_severity_series", duck("logs_v", """SELECT epoch_us("Timestamp") // 60000000 * 60 AS time_s, SeverityText, count(*) AS count FROM logs_v
  WHERE (epoch_us("Timestamp") // 60000000 + 1) * 60000000 <= epoch_us((SELECT max("Timestamp") FROM logs_v)) - 600000000 GROUP BY 1, 2"""))
def _(v):
    stream = derived.severity_series_stream(v.logs_of(_spans(v)))
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "series", "checkpoint")
    return tables.read_table(v.spark, path).select(F.unix_seconds("time").alias("time_s"), "SeverityText", "count")


SESSIONS_SQL = """
  SELECT *, sum(fresh) OVER (PARTITION BY TraceId ORDER BY "Timestamp", SpanId ROWS UNBOUNDED PRECEDING) AS session FROM (
    SELECT *, CASE WHEN "Timestamp" < lag("Timestamp") OVER (PARTITION BY TraceId ORDER BY "Timestamp", SpanId) + INTERVAL 2 HOUR
      THEN 0 ELSE 1 END AS fresh FROM spans_v WHERE TraceId <> '')
"""


@query("stream_group_by_trace", duck("spans_v", f"""SELECT TraceId, count(*) AS span_count, min(TimestampNs) AS StartNs,
  max(TimestampNs + Duration) AS EndNs, count(CASE WHEN StatusCode = 'STATUS_CODE_ERROR' THEN 1 END) AS errors
  FROM sessions GROUP BY TraceId, session
  HAVING max("Timestamp") + INTERVAL 2 HOUR <= (SELECT max("Timestamp") FROM spans_v WHERE TraceId <> '') - INTERVAL 10 MINUTE""", sessions=SESSIONS_SQL))
def _(v):
    stream = derived.group_by_trace_stream(_spans(v), gap="2 hours")
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "traces", "checkpoint")
    return tables.read_table(v.spark, path)


@query("stream_assemble_traces", duck("spans_v", """SELECT TraceId, SpanId, SpanName, ServiceName, Duration, size, place FROM (
  SELECT *, count(*) OVER (PARTITION BY TraceId, session) AS size, row_number() OVER (PARTITION BY TraceId, session ORDER BY TimestampNs, SpanId) AS place,
    max("Timestamp") OVER (PARTITION BY TraceId, session) AS ended FROM sessions)
  WHERE ended + INTERVAL 2 HOUR <= (SELECT max("Timestamp") FROM spans_v WHERE TraceId <> '') - INTERVAL 10 MINUTE""", sessions=SESSIONS_SQL))
def _(v):
    stream = assembly.assemble_traces_stream(_spans(v), gap_ms=7_200_000)
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "traces", "checkpoint")
    rows = tables.read_table(v.spark, path).select("TraceId", F.col("span_count").cast("bigint").alias("size"), F.posexplode("Spans").alias("at", "s"))
    return rows.select("TraceId", "s.SpanId", "s.SpanName", "s.ServiceName", "s.Duration", "size", (F.col("at") + 1).cast("bigint").alias("place"))


@query("stream_service_graph_full", duck("spans_v", GRAPH_SQL))
def _(v):
    """Dimensions and latency buckets as in the batch, whose pairs are as far apart as they like."""
    stream = derived.service_graph_pairs_stream(_spans(v), ttl="400 days", dimensions=("host.name",))
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "pairs", "checkpoint")
    edges = derived.edges_of(tables.read_table(v.spark, path), ("host.name",), BOUNDS)
    return edges.select(
        "client", "server", F.col("`client_host.name`").alias("client_host"), F.col("`server_host.name`").alias("server_host"),
        "calls", "failed", "client_duration_ns", "server_duration_ns",
        F.concat_ws(",", F.col("client_bucket_counts").cast("array<string>")).alias("client_buckets"),
        F.concat_ws(",", F.col("server_bucket_counts").cast("array<string>")).alias("server_buckets"),
    )


_NEAR = """o."Timestamp" BETWEEN spans_v."Timestamp" - INTERVAL 1 HOUR AND spans_v."Timestamp" + INTERVAL 1 HOUR AND o.TraceId = spans_v.TraceId"""


@query("stream_unpaired_spans", duck("spans_v", f"""SELECT side, TraceId, SpanId, ServiceName FROM (
  SELECT 'client' AS side, TraceId, SpanId, ServiceName, "Timestamp" FROM spans_v WHERE TraceId <> '' AND SpanKind = 'SPAN_KIND_CLIENT' AND NOT EXISTS (
    SELECT 1 FROM spans_v o WHERE o.SpanKind = 'SPAN_KIND_SERVER' AND o.ParentSpanId = spans_v.SpanId AND {_NEAR})
  UNION ALL SELECT 'server', TraceId, SpanId, ServiceName, "Timestamp" FROM spans_v WHERE TraceId <> '' AND SpanKind = 'SPAN_KIND_SERVER' AND ParentSpanId <> '' AND NOT EXISTS (
    SELECT 1 FROM spans_v o WHERE o.SpanKind = 'SPAN_KIND_CLIENT' AND o.SpanId = spans_v.ParentSpanId AND {_NEAR}))
  WHERE "Timestamp" < {LAST_SQL} - INTERVAL 2 DAY"""))
def _(v):
    stream = derived.unpaired_spans_stream(_spans(v), ttl="1 hour", delay="1 hour")
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "unpaired", "checkpoint")
    last = v.spans.agg((F.max("Timestamp") - F.expr("INTERVAL 2 DAY")).alias("t")).scalar()
    return tables.read_table(v.spark, path).filter(F.col("Timestamp") < last).select("side", "TraceId", "SpanId", "ServiceName")


@query("stream_service_graph", duck("spans_v", """SELECT c.ServiceName AS client, s.ServiceName AS server, count(*) AS calls,
  count(CASE WHEN c.StatusCode = 'STATUS_CODE_ERROR' OR s.StatusCode = 'STATUS_CODE_ERROR' THEN 1 END) AS failed,
  sum(c.Duration)::BIGINT AS client_duration_ns, sum(s.Duration)::BIGINT AS server_duration_ns
  FROM spans_v c JOIN spans_v s ON s.TraceId = c.TraceId AND s.ParentSpanId = c.SpanId
  WHERE c.TraceId <> '' AND c.SpanKind = 'SPAN_KIND_CLIENT' AND s.SpanKind = 'SPAN_KIND_SERVER'
    AND s."Timestamp" BETWEEN c."Timestamp" - INTERVAL 1 HOUR AND c."Timestamp" + INTERVAL 1 HOUR GROUP BY 1, 2"""))
def _(v):
    stream = derived.service_graph_pairs_stream(_spans(v), ttl="1 hour")
    path = _finish(v, lambda table, checkpoint: derived.to_table(stream, table, checkpoint), "pairs", "checkpoint")
    return derived.edges_of(tables.read_table(v.spark, path))


@query("stream_service_operations", duck("spans_v", FNV_SQL))
def _(v):
    path = _finish(
        v, lambda table, checkpoint: ingest.stream_service_operations(_spans(v), table, checkpoint), "operations", "checkpoint"
    )
    return tables.read_table(v.spark, path).select("id", "serviceName", "operationName")


# The spans of odd events come first, those of even events when the stream is started again. Of
# the second load, all that are a day behind the newest of the first are late.
@query("stream_split_late", duck("spans_v", """SELECT SpanId, CASE WHEN event_id % 2 = 0 AND "Timestamp" <
    (SELECT max("Timestamp") FROM spans_v WHERE event_id % 2 = 1) - INTERVAL 1 DAY THEN 'late' ELSE 'on_time' END AS side FROM spans_v"""))
def _(v):
    folder, path, checkpoint = (scratch_path(v.spark, name) for name in ("loads", "split", "checkpoint"))
    rows = v.wide_spans.select("SpanId", "Timestamp", "event_id")
    for remainder in (1, 0):
        rows.filter(F.col("event_id") % 2 == remainder).write.mode("append").parquet(folder)
        stream = v.spark.readStream.schema(rows.schema).parquet(folder)
        ingest.stream_split_late(stream, "Timestamp", "1 DAY", path, checkpoint).awaitTermination()
    sides = [ingest.read_side(v.spark, path, side).select("SpanId", F.lit(side).alias("side")) for side in ("on_time", "late")]
    return sides[0].unionAll(sides[1])
