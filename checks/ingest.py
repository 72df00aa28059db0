"""Messages to tables, tables to files, quarantine, index routing, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import query
from checks.traces import SPAN_OUT, SPAN_SQL
from checks.views import EXPONENTS, HISTOGRAM_BOUNDS, duck
from telesift import schema
from telesift.functions import maps
from telesift.operators import attributes, catalog
from telesift.session import scratch_path
from telesift.sources import otlp, tables


def _flat_spans(v, **how):
    return otlp.flatten_spans(otlp.parse_otlp_json(v.trace_messages, "value", "traces"), **how)


def _flat_metric(v, kind):
    return otlp.flatten_metric(otlp.parse_otlp_json(v.metric_messages, "value", "metrics"), kind)


# ---- flattening -------------------------------------------------------------------------------


@query("flatten_spans", duck("spans_v", f"""SELECT {SPAN_SQL}, StatusMessage, 'fixture' AS ScopeName, '1.0' AS ScopeVersion,
  epoch_us("Timestamp") AS us, host FROM spans_v"""))
def _(v):
    return _flat_spans(v).select(
        *SPAN_OUT, "StatusMessage", "ScopeName", "ScopeVersion", F.unix_micros("Timestamp").alias("us"),
        F.col("ResourceAttributes")["host.name"].alias("host"),
    )


@query("flatten_spans_of_written_messages", duck("spans_v", """SELECT ServiceName, count(*) AS spans,
  sum(Duration)::BIGINT AS ns FROM spans_v GROUP BY 1"""))
def _(v):
    path = scratch_path(v.spark, "messages")
    v.trace_messages.write.text(path)
    spans = otlp.flatten_spans(otlp.read_otlp_json(v.spark, path, "traces"))
    return spans.groupBy("ServiceName").agg(F.count("*").alias("spans"), F.sum("Duration").alias("ns"))


@query("attributes_to_map", duck("spans_v", r"""SELECT SpanId, k, user_text AS user_id, 7::BIGINT - (k IS NULL)::BIGINT AS given,
  regexp_replace(CAST(value AS VARCHAR), '\.0$', '') AS value,
  CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS even,
  '[' || k || ',"x"]' AS list, '{"a":"x","b.c":' || k || '}' AS deep FROM spans_v""").replace("7::BIGINT", "6::BIGINT"))
def _(v):
    attrs = F.col("SpanAttributes")
    return _flat_spans(v).select(
        "SpanId", attrs["k"].alias("k"), attrs["user.id"].alias("user_id"), attrs["value"].alias("value"),
        attrs["even"].alias("even"), attrs["list"].alias("list"), attrs["deep"].alias("deep"),
        F.size(attrs).cast("bigint").alias("given"),
    )


@query("span_events", duck("spans_v", """
  SELECT SpanId, 'exception' AS Name, TimestampNs + 1000 AS ns, 'E' || (event_id % 3) AS detail FROM spans_v WHERE event_type = 'error'
  UNION ALL SELECT SpanId, 'cart', TimestampNs, NULL FROM spans_v WHERE event_type = 'purchase'
  UNION ALL SELECT SpanId, 'pay', TimestampNs + 2000, CAST(Duration // 10000 AS VARCHAR) FROM spans_v WHERE event_type = 'purchase'"""))
def _(v):
    events = _flat_spans(v).select("SpanId", F.explode("Events").alias("e"))
    detail = F.coalesce(F.col("e.Attributes")["exception.type"], F.col("e.Attributes")["amount"])
    return events.select("SpanId", "e.Name", F.col("e.TimestampNs").alias("ns"), detail.alias("detail"))


@query("span_links", duck("spans_v", """SELECT SpanId, md5('t' || (trace_no + 3)) AS LinkTraceId,
  substr(md5(CAST(event_id + 1 AS VARCHAR)), 1, 16) AS LinkSpanId, '' AS TraceState, 'follows' AS why
  FROM spans_v WHERE event_id % 10 = 3"""))
def _(v):
    links = _flat_spans(v).select("SpanId", F.explode("Links").alias("l"))
    return links.select(
        "SpanId", F.col("l.TraceId").alias("LinkTraceId"), F.col("l.SpanId").alias("LinkSpanId"), "l.TraceState",
        F.col("l.Attributes")["why"].alias("why"),
    )


@query("flatten_logs", duck("logs_v", """SELECT TimestampNs, TraceId, SpanId, 1::BIGINT AS TraceFlags, SeverityText, SeverityNumber,
  ServiceName, Body, 'urn:telesift:fixture:resource' AS ResourceSchemaUrl,
  'urn:telesift:fixture:scope' AS ScopeSchemaUrl, 'fixture' AS ScopeName, '1.0' AS ScopeVersion,
  'events' AS origin, k, event_type AS event, host FROM logs_v"""))
def _(v):
    logs = otlp.flatten_logs(otlp.parse_otlp_json(v.log_messages, "value", "logs"))
    return logs.select(
        "TimestampNs", "TraceId", "SpanId", "TraceFlags", "SeverityText", "SeverityNumber", "ServiceName", "Body",
        "ResourceSchemaUrl", "ScopeSchemaUrl", "ScopeName", "ScopeVersion",
        F.col("ScopeAttributes")["origin"].alias("origin"), F.col("LogAttributes")["k"].alias("k"),
        F.col("LogAttributes")["event"].alias("event"), F.col("ResourceAttributes")["host.name"].alias("host"),
    )


@query("split_metrics", duck("spans_v", """
  SELECT 'gauge' AS kind, event_type || '.value' AS MetricName, count(*) AS points FROM spans_v GROUP BY 2
  UNION ALL SELECT 'sum', event_type || '.total', count(*) FROM spans_v GROUP BY 2
  UNION ALL SELECT kind, event_type || '.size', count(DISTINCT CAST("Timestamp" AS DATE))
    FROM spans_v, (VALUES ('histogram'), ('exponential_histogram'), ('summary')) x(kind) GROUP BY 1, 2"""))
def _(v):
    points = otlp.flatten_metrics(otlp.parse_otlp_json(v.metric_messages, "value", "metrics"))
    return points.groupBy("kind", "MetricName").agg(F.count("*").alias("points"))


@query("untyped_metrics", duck("spans_v", """SELECT 'untyped.' || event_type || '.size' AS MetricName,
  'metric type is unset or unsupported' AS reason, count(DISTINCT CAST("Timestamp" AS DATE)) AS metrics
  FROM spans_v GROUP BY 1"""))
def _(v):
    bad = otlp.untyped_metrics(otlp.parse_otlp_json(v.metric_messages, "value", "metrics"))
    return bad.groupBy("MetricName", "reason").agg(F.count("*").alias("metrics"))


@query("flatten_gauge", duck("gauge_v", "SELECT MetricName, user_text, host, TimeUnixNs, Value, '1' AS MetricUnit, 0::BIGINT AS Flags FROM gauge_v"))
def _(v):
    return _flat_metric(v, "gauge").select(
        "MetricName", F.col("Attributes")["user"].alias("user_text"), F.col("ResourceAttributes")["host.name"].alias("host"),
        "TimeUnixNs", "Value", "MetricUnit", "Flags",
    )


@query("flatten_sum", duck("sum_v", "SELECT MetricName, user_text, host, TimeUnixNs, Value, 2 AS AggTemp, true AS IsMonotonic FROM sum_v"))
def _(v):
    return _flat_metric(v, "sum").select(
        "MetricName", F.col("Attributes")["user"].alias("user_text"), F.col("ResourceAttributes")["host.name"].alias("host"),
        "TimeUnixNs", "Value", "AggTemp", "IsMonotonic",
    )


def _csv(columns) -> str:
    return " || ',' || ".join(columns)


@query("flatten_histogram", duck("day_v", f"""SELECT MetricName, day_text, n AS "Count", total AS "Sum",
  {_csv(f"b{i}" for i in range(len(HISTOGRAM_BOUNDS) + 1))} AS counts, low AS "Min", high AS "Max", {len(HISTOGRAM_BOUNDS)}::BIGINT AS bounds
  FROM day_v"""))
def _(v):
    return _flat_metric(v, "histogram").select(
        "MetricName", F.col("Attributes")["day"].alias("day_text"), "Count", "Sum",
        F.concat_ws(",", F.col("BucketCounts").cast("array<string>")).alias("counts"), "Min", "Max",
        F.size("ExplicitBounds").cast("bigint").alias("bounds"),
    )


@query("flatten_exponential_histogram", duck("day_v", f"""SELECT MetricName, day_text, n AS "Count", total AS "Sum", 0 AS Scale,
  zeros AS ZeroCount, {EXPONENTS[0]} AS PositiveOffset, {_csv(f"e{i}" for i in range(len(EXPONENTS)))} AS counts,
  0 AS NegativeOffset, 0::BIGINT AS negative, low AS "Min", high AS "Max" FROM day_v"""))
def _(v):
    return _flat_metric(v, "exponential_histogram").select(
        "MetricName", F.col("Attributes")["day"].alias("day_text"), "Count", "Sum", "Scale", "ZeroCount", "PositiveOffset",
        F.concat_ws(",", F.col("PositiveBucketCounts").cast("array<string>")).alias("counts"), "NegativeOffset",
        F.size("NegativeBucketCounts").cast("bigint").alias("negative"), "Min", "Max",
    )


@query("flatten_summary", duck("day_v", """SELECT MetricName, day_text, n AS "Count", total AS "Sum" FROM day_v"""))
def _(v):
    return _flat_metric(v, "summary").select("MetricName", F.col("Attributes")["day"].alias("day_text"), "Count", "Sum")


@query("quantile_pairs", duck("day_v", """SELECT MetricName, day_text, 0.0::DOUBLE AS Quantile, low AS Value FROM day_v
  UNION ALL SELECT MetricName, day_text, 1.0, high FROM day_v"""))
def _(v):
    pairs = _flat_metric(v, "summary").select(
        "MetricName", F.col("Attributes")["day"].alias("day_text"), F.explode("ValueAtQuantiles").alias("q")
    )
    return pairs.select("MetricName", "day_text", "q.Quantile", "q.Value")


@query("exemplars", duck("gauge_v", """SELECT MetricName, user_text, TimeUnixNs, Value, repeat('0', 32) AS TraceId, repeat('0', 16) AS SpanId,
  epoch_us(TimeUnix) AS us, 0::BIGINT AS attrs FROM gauge_v"""))
def _(v):
    rows = _flat_metric(v, "gauge").select(
        "MetricName", F.col("Attributes")["user"].alias("user_text"), "TimeUnixNs", F.explode("Exemplars").alias("e")
    )
    return rows.select(
        "MetricName", "user_text", "TimeUnixNs", "e.Value", "e.TraceId", "e.SpanId",
        F.unix_micros("e.TimeUnix").alias("us"), F.size("e.FilteredAttributes").cast("bigint").alias("attrs"),
    )


# ---- tables -----------------------------------------------------------------------------------


@query("write_spans", duck("spans_v", """SELECT CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS day_text, ServiceName, SpanName,
  count(*) AS spans, sum(Duration)::BIGINT AS ns FROM spans_v GROUP BY ALL"""))
def _(v):
    path = scratch_path(v.spark, "spans")
    tables.write_spans(v.spans, path)
    stored = tables.read_table(v.spark, path)
    return stored.groupBy(F.col("day").cast("string").alias("day_text"), "ServiceName", "SpanName").agg(
        F.count("*").alias("spans"), F.sum("Duration").alias("ns")
    )


@query("write_logs", duck("logs_v", """SELECT CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS day_text, ServiceName, SeverityText,
  count(*) AS records FROM logs_v GROUP BY ALL"""))
def _(v):
    path = scratch_path(v.spark, "logs")
    tables.write_logs(v.logs, path)
    stored = tables.read_table(v.spark, path)
    return stored.groupBy(F.col("day").cast("string").alias("day_text"), "ServiceName", "SeverityText").agg(
        F.count("*").alias("records")
    )


@query("write_metrics", duck("day_v", """
  SELECT 'gauge' AS kind, event_type || '.value' AS MetricName, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text, count(*) AS points
    FROM base GROUP BY ALL
  UNION ALL SELECT 'sum', event_type || '.total', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM base GROUP BY ALL
  UNION ALL SELECT kind, MetricName, day_text, 1 FROM day_v, (VALUES ('histogram'), ('exponential_histogram'), ('summary')) x(kind)"""))
def _(v):
    path = scratch_path(v.spark, "metrics")
    tables.write_metrics({kind: getattr(v, kind) for kind in schema.METRIC_KINDS}, path)
    counts = None
    for kind in schema.METRIC_KINDS:
        stored = tables.read_metric_table(v.spark, path, kind)
        one = stored.groupBy(F.lit(kind).alias("kind"), "MetricName", F.col("day").cast("string").alias("day_text")).agg(
            F.count("*").alias("points")
        )
        counts = one if counts is None else counts.unionAll(one)
    return counts


@query("write_metric_points", duck("day_v", """
  SELECT 'gauge' AS kind, event_type || '.value' AS MetricName, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text, count(*) AS points
    FROM base GROUP BY ALL
  UNION ALL SELECT 'sum', event_type || '.total', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM base GROUP BY ALL
  UNION ALL SELECT kind, MetricName, day_text, 1 FROM day_v, (VALUES ('histogram'), ('exponential_histogram'), ('summary')) x(kind)"""))
def _(v):
    path = scratch_path(v.spark, "metrics")
    tables.write_metric_points(otlp.flatten_metrics(otlp.parse_otlp_json(v.metric_messages, "value", "metrics")), path)
    stored = tables.read_table(v.spark, path)
    return stored.groupBy("kind", "MetricName", F.col("day").cast("string").alias("day_text")).agg(F.count("*").alias("points"))


@query("apply_retention", duck("spans_v", """SELECT CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS day_text, count(*) AS spans
  FROM spans_v WHERE CAST("Timestamp" AS DATE) >= DATE '2024-01-21' GROUP BY 1"""))
def _(v):
    path = scratch_path(v.spark, "spans")
    tables.write_spans(v.spans, path)
    tables.apply_retention(v.spark, path, 10, dt.datetime(2024, 1, 31, 12))
    stored = tables.read_table(v.spark, path)
    return stored.groupBy(F.col("day").cast("string").alias("day_text")).agg(F.count("*").alias("spans"))


@query("retained", duck("spans_v", """SELECT SpanId FROM spans_v WHERE CAST("Timestamp" AS DATE) >= DATE '2024-01-21'"""))
def _(v):
    spans = v.spans.withColumn("day", F.to_date("Timestamp"))
    return tables.retained(spans, 10, dt.datetime(2024, 1, 31, 12)).select("SpanId")


@query("append_if_absent", duck("spans_v", """SELECT SpanName, min(ServiceName) AS ServiceName FROM spans_v
  WHERE SpanName NOT IN (SELECT DISTINCT SpanName FROM spans_v WHERE Duration < 30000) GROUP BY SpanName"""))
def _(v):
    spans = v.spans.select("SpanName", "ServiceName")
    existing = v.spans.filter("Duration < 30000").select("SpanName", "ServiceName")
    return tables.append_if_absent(existing, spans, "SpanName")


# ---- quarantine, routing, catalogue -----------------------------------------------------------

# Every third trace id is cut short first, so that there is more than one reason.
BROKEN_SQL = """SELECT *, CASE WHEN event_id % 3 = 0 THEN substr(TraceId, 1, 20) ELSE TraceId END AS trace FROM spans_v"""
REASON_SQL = """SELECT SpanId, CASE WHEN trace = '' THEN 'trace id is missing'
  WHEN length(trace) <> 32 THEN 'trace id is not 32 hex digits' END AS reason FROM broken"""


def _broken(v):
    cut = F.when(F.col("event_id") % 3 == 0, F.substring("TraceId", 1, 20)).otherwise(F.col("TraceId"))
    return v.wide_spans.withColumn("TraceId", cut)


@query("quarantine", duck("spans_v", "SELECT SpanId, reason FROM marked WHERE reason IS NOT NULL", broken=BROKEN_SQL, marked=REASON_SQL))
def _(v):
    _, bad = catalog.validate(_broken(v), catalog.span_rules())
    return bad.select("SpanId", "reason")


@query("quarantine_rest", duck("spans_v", "SELECT SpanId FROM marked WHERE reason IS NULL", broken=BROKEN_SQL, marked=REASON_SQL))
def _(v):
    good, _ = catalog.validate(_broken(v), catalog.span_rules())
    return good.select("SpanId")


# Records whose time or count no table takes: every seventh event's is 2^63, every eleventh's -2^63.
BAD_TIME_SQL = "event_id % 7 = 0 OR event_id % 11 = 0"


def _with_bad_times(v, column: str, at: str):
    """A copy of the messages' rows of events, with some times out of range, as messages of one record each."""
    bad = "CASE WHEN event_id % 7 = 0 THEN '9223372036854775808' WHEN event_id % 11 = 0 THEN '-9223372036854775808' ELSE CAST(TimestampNs AS STRING) END"
    record = f"named_struct('spanId', SpanId, '{at}', {bad})"
    scope, top = {"spans": ("scopeSpans", "resourceSpans"), "logRecords": ("scopeLogs", "resourceLogs")}[column]
    message = f"to_json(named_struct('{top}', array(named_struct('{scope}', array(named_struct('{column}', array({record})))))))"
    return v.wide_spans.selectExpr(f"{message} AS value")


def _kept_and_rejected(stored, rejected):
    counted = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("went"), "records") for name, df in (("stored", stored), ("rejected", rejected))]
    return counted[0].unionAll(counted[1])


_WENT_SQL = "SELECT CASE WHEN {bad} THEN 'rejected' ELSE 'stored' END AS went, count(*) AS records FROM spans_v GROUP BY 1"


@query("quarantine_mixed_load", duck("spans_v", _WENT_SQL.format(bad=BAD_TIME_SQL)))
def _(v):
    parsed = otlp.parse_otlp_json(_with_bad_times(v, "spans", "startTimeUnixNano"), "value", "traces")
    return _kept_and_rejected(otlp.flatten_spans(parsed).filter("TimestampNs > 0"), otlp.rejected(parsed, "traces"))


@query("quarantine_logs", duck("spans_v", _WENT_SQL.format(bad=BAD_TIME_SQL)))
def _(v):
    parsed = otlp.parse_otlp_json(_with_bad_times(v, "logRecords", "timeUnixNano"), "value", "logs")
    return _kept_and_rejected(otlp.flatten_logs(parsed).filter("TimestampNs > 0"), otlp.rejected(parsed, "logs"))


@query("quarantine_metrics", duck("spans_v", _WENT_SQL.format(bad="event_id % 5 = 0")))
def _(v):
    point = """named_struct('timeUnixNano', CAST(TimestampNs AS STRING), 'count', if(event_id % 5 = 0, '18446744073709551615', '3'))"""
    metric = f"named_struct('name', 'm', 'histogram', named_struct('dataPoints', array({point})))"
    message = f"to_json(named_struct('resourceMetrics', array(named_struct('scopeMetrics', array(named_struct('metrics', array({metric})))))))"
    parsed = otlp.parse_otlp_json(v.wide_spans.selectExpr(f"{message} AS value"), "value", "metrics")
    return _kept_and_rejected(otlp.flatten_metrics(parsed).filter("Count = 3"), otlp.rejected(parsed, "metrics"))


FNV_SQL = """
  SELECT serviceName, operationName, printf('%x', h::UBIGINT) AS id FROM (
    SELECT ServiceName AS serviceName, SpanName AS operationName,
      list_reduce(list_prepend(14695981039346656037::HUGEINT, list_transform(
        string_split(ServiceName || SpanName, ''), lambda c: ascii(c)::HUGEINT)),
        lambda a, b: (xor(a, b) * 1099511628211::HUGEINT) % 18446744073709551616::HUGEINT) AS h
    FROM spans_v WHERE ServiceName <> '' GROUP BY 1, 2, 3)
"""


@query("service_operations", duck("spans_v", FNV_SQL))
def _(v):
    return catalog.service_operations(v.spans)


@query("route_by_index", duck("spans_v", """SELECT SpanId,
  CASE WHEN user_id % 3 = 0 THEN 'res-' WHEN event_id % 2 = 0 THEN 'attr-' ELSE '' END || 'spans' ||
  CASE WHEN event_id % 5 = 0 THEN '-suffix' ELSE '' END AS index_name FROM spans_v"""))
def _(v):
    spans = v.wide_spans.withColumns({
        "ResourceAttributes": F.when(F.col("user_id") % 3 == 0, maps.merge_maps(
            F.col("ResourceAttributes"), F.create_map(F.lit(catalog.INDEX_PREFIX), F.lit("res-")))).otherwise(F.col("ResourceAttributes")),
        "SpanAttributes": maps.merge_maps(
            F.col("SpanAttributes"),
            F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit(catalog.INDEX_PREFIX), F.lit("attr-"))),
            F.when(F.col("event_id") % 5 == 0, F.create_map(F.lit(catalog.INDEX_SUFFIX), F.lit("-suffix")))),
    })
    return catalog.route_by_index(spans, "spans").select("SpanId", "index_name")


@query("route_signals", duck("spans_v", """SELECT CASE WHEN StatusCode = 'STATUS_CODE_ERROR' THEN 'errors'
  WHEN Duration > 100000000 THEN 'slow' ELSE 'rest' END AS route, count(*) AS spans FROM spans_v GROUP BY 1"""))
def _(v):
    rules = [(F.col("StatusCode") == "STATUS_CODE_ERROR", "errors"), (F.col("Duration") > 100_000_000, "slow")]
    path = scratch_path(v.spark, "routed")
    attributes.route(v.spans, rules, "rest").hint("rebalance", F.col("route")).write.partitionBy("route").parquet(path)
    return tables.read_table(v.spark, path).groupBy("route").agg(F.count("*").alias("spans"))
