"""Scalar functions over columns of the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.documents import NS_TEXT
from checks.registry import query
from checks.traces import DURATION_SQL
from checks.views import duck
from telesift.functions import ids, maps, names, text, times


@query("hex_id", duck("spans_v", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE md5(CAST(event_id AS VARCHAR)) END AS id FROM spans_v"""))
def _(v):
    raw = F.expr("CASE WHEN event_id % 10 = 0 THEN unhex(repeat('0', 32)) WHEN event_id % 5 = 0 THEN NULL ELSE unhex(md5(CAST(event_id AS STRING))) END")
    return v.wide_spans.select("event_id", ids.hex_id(raw).alias("id"))


@query("id_to_u64", duck("spans_v", """SELECT SpanId, CAST(('0x' || SpanId)::UBIGINT AS VARCHAR) AS span_number,
  CASE WHEN TraceId <> '' THEN CAST(('0x' || substr(TraceId, 1, 16))::UBIGINT AS VARCHAR) END AS high,
  CASE WHEN TraceId <> '' THEN CAST(('0x' || substr(TraceId, 17))::UBIGINT AS VARCHAR) END AS low FROM spans_v"""))
def _(v):
    pair = ids.trace_id_to_u64_pair(F.expr("nullif(TraceId, '')"))
    return v.spans.select(
        "SpanId", ids.span_id_to_u64(F.col("SpanId")).cast("string").alias("span_number"),
        pair["high"].cast("string").alias("high"), pair["low"].cast("string").alias("low"),
    )


@query("u64_to_id", duck("spans_v", "SELECT SpanId, nullif(TraceId, '') AS trace_id, SpanId AS span_id FROM spans_v"))
def _(v):
    pair = ids.trace_id_to_u64_pair(F.expr("nullif(TraceId, '')"))
    return v.spans.select(
        "SpanId", ids.u64_pair_to_trace_id(pair["high"], pair["low"]).alias("trace_id"),
        ids.u64_to_span_id(ids.span_id_to_u64(F.col("SpanId"))).alias("span_id"),
    )


@query("span_kind_name", duck("spans_v", """SELECT event_id, CASE WHEN event_id % 8 > 5 THEN '' ELSE ['SPAN_KIND_UNSPECIFIED',
  'SPAN_KIND_INTERNAL', 'SPAN_KIND_SERVER', 'SPAN_KIND_CLIENT', 'SPAN_KIND_PRODUCER', 'SPAN_KIND_CONSUMER'][event_id % 8 + 1] END AS kind FROM spans_v"""))
def _(v):
    return v.wide_spans.select("event_id", names.span_kind_name(F.col("event_id") % 8).alias("kind"))


@query("status_code_name", duck("spans_v", """SELECT event_id, CASE WHEN event_id % 4 > 2 THEN '' ELSE ['STATUS_CODE_UNSET', 'STATUS_CODE_OK',
  'STATUS_CODE_ERROR'][event_id % 4 + 1] END AS status FROM spans_v"""))
def _(v):
    return v.wide_spans.select("event_id", names.status_code_name(F.col("event_id") % 4).alias("status"))


@query("merge_maps", duck("spans_v", """SELECT SpanId, host AS host_name, 'later' AS user_id, k FROM spans_v"""))
def _(v):
    merged = maps.merge_maps(F.col("SpanAttributes"), F.col("ResourceAttributes"), F.expr("map('user.id', 'later')"))
    return v.spans.select(
        "SpanId", merged["host.name"].alias("host_name"), merged["user.id"].alias("user_id"), merged["k"].alias("k")
    )


@query("format_ns", duck("spans_v", f"SELECT SpanId, {NS_TEXT.format(ns='TimestampNs')} AS time_text FROM spans_v"))
def _(v):
    return v.spans.select("SpanId", times.format_ns(F.col("TimestampNs")).alias("time_text"))


@query("parse_ns", duck("spans_v", "SELECT SpanId, TimestampNs AS ns FROM spans_v"))
def _(v):
    return v.spans.select("SpanId", times.parse_ns(times.format_ns(F.col("TimestampNs"))).alias("ns"))


# Durations of every magnitude: the span's, times a power of ten by event.
SCALED = "CAST(Duration AS BIGINT) * [1, 7, 1000, 100000, 0][event_id % 5 + 1] // [1000000, 10, 1, 1, 1][event_id % 5 + 1]"


@query("format_duration", duck("spans_v", f"SELECT event_id, d AS ns, {DURATION_SQL} AS duration FROM (SELECT event_id, {SCALED} AS d FROM spans_v)"))
def _(v):
    factor = F.expr("element_at(array(1L, 7L, 1000L, 100000L, 0L), CAST(event_id % 5 AS INT) + 1)")
    divisor = F.expr("element_at(array(1000000L, 10L, 1L, 1L, 1L), CAST(event_id % 5 AS INT) + 1)")
    ns = F.call_function("div", F.col("Duration") * factor, divisor)
    return v.wide_spans.select("event_id", ns.alias("ns"), times.format_duration(ns).alias("duration"))


@query("strip_control", duck("doc_logs_v", "SELECT doc_id, md5(replace(replace(Body, chr(10), ''), chr(13), '')) AS clean FROM doc_logs_v"))
def _(v):
    return v.table("documents").select("doc_id", F.md5(text.strip_control(F.col("text"))).alias("clean"))


@query("status_from_http", duck("spans_v", """SELECT event_id, CASE WHEN event_id % 600 >= 100 AND event_id % 600 < 399 THEN 'STATUS_CODE_UNSET'
  ELSE 'STATUS_CODE_ERROR' END AS status FROM spans_v"""))
def _(v):
    return v.wide_spans.select("event_id", names.status_from_http(F.col("event_id") % 600).alias("status"))


@query("first_attribute", duck("spans_v", "SELECT SpanId, coalesce(k, nullif(ServiceName, '')) AS first, host FROM spans_v"))
def _(v):
    both = F.col("SpanAttributes"), F.col("ResourceAttributes")
    found = F.coalesce(maps.first_attribute("k", *both), maps.first_attribute("service.name", *both))
    return v.spans.select("SpanId", found.alias("first"), maps.first_attribute("host.name", *both).alias("host"))


@query("number_value", duck("spans_v", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN CAST(k AS DOUBLE) ELSE 0.0 END AS number FROM spans_v"""))
def _(v):
    double = F.expr("CASE WHEN event_id % 3 = 0 THEN value END")
    whole = F.expr("CASE WHEN event_id % 3 = 1 THEN k END")
    return v.wide_spans.select("event_id", text.number_value(whole, double).alias("number"))


@query("interval_start", duck("spans_v", """SELECT SpanId, epoch_us("Timestamp") // 60000000 * 60 AS start_s FROM spans_v"""))
def _(v):
    return v.spans.select("SpanId", F.unix_seconds(times.interval_start(F.col("Timestamp"), 60)).alias("start_s"))
