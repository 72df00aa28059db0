"""Trace lookups, searches, summaries, catalogues and bounds."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import duck
from telesift.functions import maps, times
from telesift.operators import bounds, spans as span_ops
from telesift.plans import trace_search as ts
from telesift.session import scratch_path
from telesift.sources import tables

START = dt.datetime(2024, 1, 1)
END = dt.datetime(2024, 1, 31)
SPAN_OUT = ("TraceId", "SpanId", "ParentSpanId", "SpanName", "SpanKind", "ServiceName", "TimestampNs", "Duration", "StatusCode")
SPAN_SQL = ", ".join(SPAN_OUT)

# A trace the fixture has at every size.
TRACE = hashlib.md5(b"t3").hexdigest()

ROOTS_SQL = """
  SELECT s.*, row_number() OVER (PARTITION BY TraceId ORDER BY TimestampNs, SpanId) AS rn
  FROM spans_v s
  WHERE TraceId <> '' AND NOT EXISTS (
    SELECT 1 FROM spans_v p WHERE p.TraceId = s.TraceId AND p.SpanId = s.ParentSpanId)
"""
BOUNDS_SQL = """
  SELECT TraceId, min("Timestamp") AS s, max("Timestamp") AS e,
    min(TimestampNs) AS s_ns, max(TimestampNs) AS e_ns, max(TimestampNs + Duration) AS end_ns
  FROM spans_v WHERE TraceId <> '' GROUP BY TraceId
"""
DURATION_SQL = """
  CASE WHEN d = 0 THEN '0s' WHEN d < 1000 THEN d || 'ns'
    WHEN d < 1000000 THEN (d // 1000) || rtrim(rtrim('.' || lpad(CAST(d % 1000 AS VARCHAR), 3, '0'), '0'), '.') || 'µs'
    WHEN d < 1000000000 THEN (d // 1000000) || rtrim(rtrim('.' || lpad(CAST(d % 1000000 AS VARCHAR), 6, '0'), '0'), '.') || 'ms'
    ELSE CASE WHEN d >= 3600000000000 THEN (d // 3600000000000) || 'h' ELSE '' END
      || CASE WHEN d >= 60000000000 THEN (d // 60000000000 % 60) || 'm' ELSE '' END
      || (d // 1000000000 % 60) || rtrim(rtrim('.' || lpad(CAST(d % 1000000000 AS VARCHAR), 9, '0'), '0'), '.') || 's'
  END
"""
STATUS_SQL = """
  CASE WHEN StatusCode = 'STATUS_CODE_OK' THEN 1
    WHEN StatusCode = 'STATUS_CODE_UNSET' AND SpanKind IN ('SPAN_KIND_SERVER', 'SPAN_KIND_INTERNAL') THEN 1 ELSE 0 END
"""


def micros(column: str):
    return F.unix_micros(F.col(column))


# ---- bounds -----------------------------------------------------------------------------------


@query("trace_bounds", duck("spans_v", "SELECT TraceId, epoch_us(s) AS start_us, epoch_us(e) AS end_us FROM b", b=BOUNDS_SQL))
def _(v):
    return bounds.trace_bounds(v.spans).select("TraceId", micros("Start").alias("start_us"), micros("End").alias("end_us"))


@query("merge_trace_bounds", duck("spans_v", "SELECT TraceId, epoch_us(s) AS start_us, epoch_us(e) AS end_us FROM b", b=BOUNDS_SQL))
def _(v):
    # Two loads, split by event so that traces span both, each with its own partial rows.
    even = v.wide_spans.filter("event_id % 2 = 0")
    odd = v.wide_spans.filter("event_id % 2 = 1")
    path = scratch_path(v.spark, "bounds")
    tables.write_bounds(bounds.trace_bounds(even), path)
    tables.write_bounds(bounds.trace_bounds(odd), path)
    merged = bounds.merge_trace_bounds(tables.read_table(v.spark, path))
    return merged.select("TraceId", micros("Start").alias("start_us"), micros("End").alias("end_us"))


@query("trace_bounds_exact", duck("spans_v", "SELECT TraceId, s_ns AS StartNs, end_ns AS EndNs FROM b", b=BOUNDS_SQL))
def _(v):
    return bounds.trace_bounds_exact(v.spans)


# ---- lookups ----------------------------------------------------------------------------------


@query("get_trace", duck("spans_v", f"SELECT {SPAN_SQL} FROM spans_v WHERE TraceId = '{TRACE}'"))
def _(v):
    return ts.get_trace(v.spans, TRACE).select(*SPAN_OUT)


@query(
    "get_trace_pruned",
    duck(
        "spans_v",
        f"""SELECT {SPAN_SQL} FROM spans_v, (SELECT s, e FROM b WHERE TraceId = '{TRACE}') AS x
        WHERE TraceId = '{TRACE}' AND "Timestamp" >= x.s AND "Timestamp" <= x.e + INTERVAL 1 SECOND
        ORDER BY TimestampNs, SpanId LIMIT 100""",
        b=BOUNDS_SQL,
    ),
)
def _(v):
    path = scratch_path(v.spark, "spans")
    tables.write_spans(v.spans, path)
    stored = tables.read_table(v.spark, path)
    return ts.get_trace_pruned(stored, bounds.trace_bounds(v.spans), TRACE, limit=100).select(*SPAN_OUT)


MULTI_SQL = duck(
    "spans_v",
    f"""SELECT {SPAN_SQL} FROM spans_v WHERE TraceId IN
      (SELECT md5('t' || CAST(o_orderkey AS VARCHAR)) FROM orders)""",
)


@query("multi_get_traces", MULTI_SQL)
def _(v):
    ids = v.table("orders").select(F.md5(F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))).alias("TraceId"))
    return ts.multi_get_traces(v.spans, ids, max_rows=None).select(*SPAN_OUT)


@query(
    "multi_get_traces_capped",
    duck(
        "spans_v",
        f"""SELECT {SPAN_SQL} FROM spans_v WHERE TraceId IN
          (SELECT md5('t' || CAST(o_orderkey AS VARCHAR)) FROM orders)
        ORDER BY TraceId, TimestampNs, SpanId LIMIT 500""",
    ),
)
def _(v):
    ids = v.table("orders").select(F.md5(F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))).alias("TraceId"))
    return ts.multi_get_traces(v.spans, ids, max_rows=500).select(*SPAN_OUT)


# ---- searches ---------------------------------------------------------------------------------

BY_SERVICE = ts.TraceQuery(service_name="svc-click", start=START, end=END, num_traces=20)
BY_TAGS = ts.TraceQuery(
    operation_name="op-3", tags={"host.name": "host-1"}, start=START, end=END, num_traces=50,
    duration_min=1_000_000, duration_max=400_000_000,
)
RANGE_SQL = """"Timestamp" BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'"""
BY_SERVICE_SQL = f"""
  SELECT TraceId, count(*) AS matches FROM spans_v
  WHERE TraceId <> '' AND ServiceName = 'svc-click' AND {RANGE_SQL}
  GROUP BY TraceId ORDER BY matches DESC, TraceId LIMIT 20
"""


@query("find_trace_ids", duck("spans_v", "SELECT * FROM ids", ids=BY_SERVICE_SQL))
def _(v):
    return ts.find_trace_ids(v.spans, BY_SERVICE)


@query(
    "find_trace_ids_by_tags",
    duck(
        "spans_v",
        f"""SELECT TraceId, count(*) AS matches FROM spans_v
        WHERE TraceId <> '' AND SpanName = 'op-3' AND host = 'host-1' AND {RANGE_SQL}
          AND Duration BETWEEN 1000000 AND 400000000
        GROUP BY TraceId ORDER BY matches DESC, TraceId LIMIT 50""",
    ),
)
def _(v):
    return ts.find_trace_ids(v.spans, BY_TAGS)


def _summary_sql(where: str) -> str:
    return f"""
      SELECT c.TraceId AS trace_id, coalesce(r.SpanName, '') AS operation_name, coalesce(r.status, 0) AS status,
        c.n AS span_count, r.start_us, r.d AS duration_ns, coalesce(r.duration, '') AS duration,
        coalesce(p.n, 0) AS processes
      FROM (SELECT TraceId, count(*) AS n FROM spans_v WHERE TraceId <> '' {where} GROUP BY TraceId) c
      LEFT JOIN (SELECT TraceId, SpanName, {STATUS_SQL} AS status, TimestampNs // 1000 AS start_us, d,
          {DURATION_SQL} AS duration FROM (SELECT *, Duration AS d FROM roots WHERE rn = 1)) r ON r.TraceId = c.TraceId
      LEFT JOIN (SELECT TraceId, count(DISTINCT ServiceName) AS n FROM spans_v WHERE ServiceName <> '' GROUP BY TraceId) p
        ON p.TraceId = c.TraceId
    """


def _summary_out(df):
    return df.select(
        "trace_id", "operation_name", "status", "span_count", micros("start_time").alias("start_us"), "duration_ns",
        "duration", F.size("process_map").cast("bigint").alias("processes"),
    )


@query("search_traces_by_matches", duck("spans_v", _summary_sql("AND TraceId IN (SELECT TraceId FROM ids)"), ids=BY_SERVICE_SQL, roots=ROOTS_SQL))
def _(v):
    return _summary_out(ts.search_traces_by_matches(v.spans, BY_SERVICE))


@query("search_traces_by_matches_in_days", duck("spans_v", _summary_sql("AND TraceId IN (SELECT TraceId FROM ids)"), ids=BY_SERVICE_SQL, roots=ROOTS_SQL))
def _(v):
    path = scratch_path(v.spark, "spans")
    tables.write_spans(v.spans, path)
    stored = tables.read_table(v.spark, path)
    return _summary_out(ts.search_traces_by_matches(stored, BY_SERVICE, bounds.trace_bounds(v.spans)))


@query("trace_summaries", duck("spans_v", _summary_sql(""), roots=ROOTS_SQL))
def _(v):
    return _summary_out(span_ops.trace_summaries(v.spans))


RECENT = ts.TraceQuery(
    service_name="svc-view", tags={"user.id": "7"}, start=START, end=END,
    duration_min=60 * times.NS_PER_SECOND, duration_max=7 * 3600 * times.NS_PER_SECOND, num_traces=200,
)


@query(
    "search_spans_recent",
    duck(
        "spans_v",
        f"""SELECT {SPAN_SQL} FROM spans_v WHERE ServiceName = 'svc-view' AND user_text = '7' AND TraceId IN (
          SELECT TraceId FROM b WHERE s BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'
            AND epoch_us(e) - epoch_us(s) BETWEEN 60 * 1000000 AND 7 * 3600 * 1000000::BIGINT
          ORDER BY s DESC, TraceId LIMIT 200)""",
        b=BOUNDS_SQL,
    ),
)
def _(v):
    return ts.search_spans_recent(v.spans, bounds.trace_bounds(v.spans), RECENT).select(*SPAN_OUT)


@query(
    "search_spans_recent_until",
    duck(
        "spans_v",
        f"""SELECT {SPAN_SQL} FROM spans_v WHERE ServiceName = 'svc-view' AND TraceId IN (
          SELECT TraceId FROM b WHERE s <= TIMESTAMP '2024-01-12' ORDER BY s DESC, TraceId LIMIT 300)""",
        b=BOUNDS_SQL,
    ),
)
def _(v):
    # Stored bounds, so that only the days up to the end are read.
    path = scratch_path(v.spark, "bounds")
    tables.write_bounds(bounds.trace_bounds(v.spans), path)
    query = ts.TraceQuery(service_name="svc-view", end=dt.datetime(2024, 1, 12), num_traces=300)
    return ts.search_spans_recent(v.spans, tables.read_table(v.spark, path), query).select(*SPAN_OUT)


# ---- roots, status, processes -----------------------------------------------------------------


@query("root_spans", duck("spans_v", "SELECT TraceId, SpanId, SpanName, SpanKind, StatusCode, TimestampNs, Duration FROM roots WHERE rn = 1", roots=ROOTS_SQL))
def _(v):
    return span_ops.root_spans(v.spans).select("TraceId", "SpanId", "SpanName", "SpanKind", "StatusCode", "TimestampNs", "Duration")


@query("trace_status", duck("spans_v", f"SELECT TraceId, {STATUS_SQL} AS status FROM roots WHERE rn = 1", roots=ROOTS_SQL))
def _(v):
    roots = span_ops.root_spans(v.spans)
    return roots.select("TraceId", span_ops.trace_status(F.col("StatusCode"), F.col("SpanKind")).alias("status"))


@query(
    "trace_processes",
    duck(
        "spans_v",
        """SELECT TraceId, ServiceName, host FROM (
          SELECT *, row_number() OVER (PARTITION BY TraceId, ServiceName ORDER BY TimestampNs, SpanId) AS rn
          FROM spans_v WHERE TraceId <> '' AND ServiceName <> '') WHERE rn = 1""",
    ),
)
def _(v):
    return span_ops.trace_processes(v.spans).select("TraceId", "ServiceName", F.col("Tags")["host.name"].alias("host"))


@query("trace_start_and_duration", duck("spans_v", f"""SELECT TraceId, d AS duration_ns, {DURATION_SQL} AS duration, start_us
  FROM (SELECT TraceId, Duration AS d, TimestampNs // 1000 AS start_us FROM roots WHERE rn = 1)""", roots=ROOTS_SQL))
def _(v):
    roots = span_ops.root_spans(v.spans)
    return roots.select(
        "TraceId", F.col("Duration").alias("duration_ns"), times.format_duration(F.col("Duration")).alias("duration"),
        times.floor_div(F.col("TimestampNs"), 1000).alias("start_us"),
    )


# ---- catalogues -------------------------------------------------------------------------------


@query("services_latest", duck("spans_v", """
  SELECT DISTINCT s.ServiceName, s.host, s.TimestampNs FROM spans_v s
  JOIN (SELECT ServiceName, max(TimestampNs) AS m FROM spans_v GROUP BY 1) x
    ON x.ServiceName = s.ServiceName AND x.m = s.TimestampNs"""))
def _(v):
    return span_ops.services_latest(v.spans).select(
        "ServiceName", F.col("ResourceAttributes")["host.name"].alias("host"), "TimestampNs"
    )


@query("services_top", duck("spans_v", """SELECT ServiceName, count(*) AS span_count FROM spans_v
  WHERE ServiceName <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100"""))
def _(v):
    return span_ops.services_top(v.spans, 100)


@query("operations", duck("spans_v", "SELECT DISTINCT SpanName FROM spans_v"))
def _(v):
    return span_ops.operations(v.spans)


@query("operations_of_service", duck("spans_v", """SELECT DISTINCT SpanName FROM spans_v
  WHERE ServiceName = 'svc-view' AND SpanKind = 'SPAN_KIND_CLIENT'"""))
def _(v):
    return span_ops.operations(v.spans, "svc-view", "SPAN_KIND_CLIENT")


@query("operations_top", duck("spans_v", """SELECT SpanName, count(*) AS span_count FROM spans_v
  WHERE SpanKind <> 'SPAN_KIND_INTERNAL' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10000"""))
def _(v):
    return span_ops.operations_top(v.spans, n=10_000)


@query("operations_top_of_kind", duck("spans_v", """SELECT SpanName, count(*) AS span_count FROM spans_v
  WHERE SpanKind = 'SPAN_KIND_INTERNAL' AND ServiceName = 'svc-error' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10000"""))
def _(v):
    return span_ops.operations_top(v.spans, "svc-error", "SPAN_KIND_INTERNAL", 10_000)


# ---- span filters -----------------------------------------------------------------------------


@query("spans_with_attribute", duck("spans_v", f"""SELECT {SPAN_SQL} FROM spans_v
  WHERE ServiceName = 'svc-click' AND k = '42' AND "Timestamp" >= TIMESTAMP '2024-01-01'"""))
def _(v):
    return span_ops.spans_with_attribute(v.spans, "svc-click", "k", "42", START, limit=None).select(*SPAN_OUT)


def _mixed_loads(first: str | None, second: str | None):
    """Two loads of half the events each, of which one promotes the attribute."""

    def build(v):
        path = scratch_path(v.spark, "spans")
        for part, key in enumerate((first, second)):
            half = v.wide_spans.filter(F.col("event_id") % 2 == part).select(*v.spans.columns)
            tables.write_spans(half, path, promote={"SpanAttributes": [key]} if key else None, batch_id=part)
        stored = tables.read_table(v.spark, path)
        return span_ops.spans_with_attribute(stored, "svc-click", "k", "42", START).select(*SPAN_OUT)

    return build


for _order, _keys in (("", ("k", None)), ("_reversed", (None, "k"))):
    query(f"spans_with_attribute_mixed_loads{_order}", duck("spans_v", f"""SELECT {SPAN_SQL} FROM spans_v
      WHERE ServiceName = 'svc-click' AND k = '42' AND "Timestamp" >= TIMESTAMP '2024-01-01'"""))(_mixed_loads(*_keys))


@query("operations_of_days", duck("spans_v", """SELECT DISTINCT SpanName FROM spans_v
  WHERE "Timestamp" BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-05'"""))
def _(v):
    return span_ops.operations(v.spans, start=dt.datetime(2024, 1, 3), end=dt.datetime(2024, 1, 5))


@query("services_of_days", duck("spans_v", """SELECT ServiceName, count(*) AS span_count FROM spans_v
  WHERE ServiceName <> '' AND "Timestamp" BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-05' GROUP BY 1"""))
def _(v):
    return span_ops.services_top(v.spans, start=dt.datetime(2024, 1, 3), end=dt.datetime(2024, 1, 5))


@query("spans_with_promoted_attribute", duck("spans_v", f"""SELECT {SPAN_SQL} FROM spans_v
  WHERE ServiceName = 'svc-click' AND k = '42' AND "Timestamp" >= TIMESTAMP '2024-01-01'"""))
def _(v):
    path = scratch_path(v.spark, "spans")
    tables.write_spans(v.spans, path, promote={"SpanAttributes": ["k"]})
    stored = tables.read_table(v.spark, path)
    return span_ops.spans_with_attribute(stored, "svc-click", "k", "42", START, limit=None).select(*SPAN_OUT)


@query("error_spans", duck("spans_v", f"""SELECT {SPAN_SQL} FROM spans_v
  WHERE ServiceName = 'svc-error' AND StatusCode = 'STATUS_CODE_ERROR' AND "Timestamp" >= TIMESTAMP '2024-01-01'"""))
def _(v):
    return span_ops.error_spans(v.spans, "svc-error", START, limit=None).select(*SPAN_OUT)


@query("slow_spans", duck("spans_v", f"""SELECT {SPAN_SQL} FROM spans_v
  WHERE ServiceName = 'svc-purchase' AND Duration > 100000000 AND "Timestamp" >= TIMESTAMP '2024-01-01'"""))
def _(v):
    return span_ops.slow_spans(v.spans, "svc-purchase", 100_000_000, START, limit=None).select(*SPAN_OUT)


@query("slow_spans_first_100", duck("spans_v", f"""SELECT {SPAN_SQL} FROM spans_v
  WHERE ServiceName = 'svc-purchase' AND Duration > 100000000 ORDER BY TimestampNs, SpanId LIMIT 100"""))
def _(v):
    return span_ops.slow_spans(v.spans, "svc-purchase", 100_000_000, limit=100).select(*SPAN_OUT)


@query("display_spans", duck("spans_v", """SELECT SpanId,
  CASE WHEN k IS NULL THEN '' ELSE '"k":"' || k || '",' END AS k_text,
  CASE event_type WHEN 'error' THEN '["exception"]' WHEN 'purchase' THEN '["cart","pay"]' ELSE '[]' END AS EventNames
  FROM spans_v"""))
def _(v):
    shown = span_ops.display(v.spans)
    found = F.regexp_extract("SpanAttributes", r'"k":"[^"]*",', 0)
    return shown.select("SpanId", found.alias("k_text"), "EventNames")


@query("spans_to_resource_spans", duck("spans_v", """SELECT CASE WHEN ServiceName = '' THEN 'host.name:' || host
    ELSE 'host.name:' || host || ';service.name:' || ServiceName END AS resource_id,
  count(*) AS spans, sum(Duration)::BIGINT AS duration_ns FROM spans_v GROUP BY 1"""))
def _(v):
    grouped = span_ops.spans_to_resource_spans(v.spans, max_spans=100)
    total = F.aggregate("Spans", F.lit(0).cast("bigint"), lambda a, s: a + s["EndTimestampNs"] - s["TimestampNs"])
    return grouped.groupBy("resource_id").agg(
        F.sum(F.size("Spans")).alias("spans"), F.sum(total).alias("duration_ns")
    )


@query("attributes_id", duck("spans_v", """SELECT SpanId, CASE WHEN k IS NULL THEN '' ELSE 'k:' || k || ';' END
  || 'user.id:' || user_text AS attributes_id FROM spans_v"""))
def _(v):
    return v.spans.select("SpanId", maps.attributes_id(F.col("SpanAttributes")).alias("attributes_id"))
