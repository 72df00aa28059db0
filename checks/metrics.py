"""Metric points, and metrics derived from metrics and from spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import duck
from telesift import schema
from telesift.operators import metrics as metric_ops
from telesift.operators import span_metrics
from telesift.sources.tables import metric_table_for

# SQL texts, as columns need a session.
USER = "Attributes['user'] AS user_text"
HOST = "ResourceAttributes['host.name'] AS host"


@query("metric_points", duck("sum_v", "SELECT TimeUnixNs, MetricName, user_text, Value FROM sum_v WHERE MetricName = 'click.total'"))
def _(v):
    return metric_ops.metric_points(v.sum, "click.total", limit=None).selectExpr("TimeUnixNs", "MetricName", USER, "Value")


@query("metric_points_first_100", duck("sum_v", """SELECT TimeUnixNs, MetricName, user_text, Value FROM sum_v
  WHERE MetricName = 'click.total' ORDER BY TimeUnixNs, user_text LIMIT 100"""))
def _(v):
    return metric_ops.metric_points(v.sum, "click.total", limit=100).selectExpr("TimeUnixNs", "MetricName", USER, "Value")


@query("metric_points_of_series", duck("sum_v", """SELECT TimeUnixNs, MetricName, user_text, Value FROM sum_v
  WHERE MetricName = 'view.total' AND user_text = '7'"""))
def _(v):
    return metric_ops.metric_points(v.sum, "view.total", {"user": "7"}, limit=None).selectExpr(
        "TimeUnixNs", "MetricName", USER, "Value"
    )


@query("metric_table_for", duck("day_v", """SELECT kind, 'kind=' || kind AS folder, points FROM (
  SELECT 'gauge' AS kind, count(*) AS points FROM base UNION ALL SELECT 'sum', count(*) FROM base
  UNION ALL SELECT kind, count(*) FROM day_v, (VALUES ('histogram'), ('exponential_histogram'), ('summary')) x(kind) GROUP BY 1)"""))
def _(v):
    rows = None
    for kind in schema.METRIC_KINDS:
        folder = metric_table_for("/", kind).lstrip("/")
        one = getattr(v, kind).agg(F.count("*").alias("points")).select(
            F.lit(kind).alias("kind"), F.lit(folder).alias("folder"), "points"
        )
        rows = one if rows is None else rows.unionAll(one)
    return rows


LAGGED_SQL = """SELECT *, lag(Value) OVER w AS before, lag(TimeUnixNs) OVER w AS before_ns FROM sum_v
  WINDOW w AS (PARTITION BY MetricName, user_text, host ORDER BY TimeUnixNs)"""
DELTA_SQL = """SELECT MetricName, user_text, host, TimeUnixNs, before_ns AS StartTimeUnixNs,
  CASE WHEN Value < before THEN Value ELSE Value - before END AS Value, 1 AS AggTemp FROM lagged WHERE before IS NOT NULL"""


@query("cumulative_to_delta", duck("sum_v", "SELECT * FROM delta", lagged=LAGGED_SQL, delta=DELTA_SQL))
def _(v):
    deltas = metric_ops.cumulative_to_delta(v.sum)
    return deltas.selectExpr("MetricName", USER, HOST, "TimeUnixNs", "StartTimeUnixNs", "Value", "AggTemp")


@query("cumulative_to_delta_of_scopes", duck("sum_v", """SELECT MetricName, user_text, scope, TimeUnixNs, count(*) AS points, round(sum(Value), 6) AS value
  FROM (SELECT MetricName, user_text, host, scope, TimeUnixNs,
      CASE WHEN Value < before OR began > began_before THEN Value ELSE Value - before END AS Value FROM (
    SELECT *, lag(Value) OVER w AS before, lag(began) OVER w AS began_before FROM (
      SELECT *, 's' || (TimeUnixNs // 1000000 % 2) AS scope, TimeUnixNs // 86400000000000 AS began FROM sum_v)
    WINDOW w AS (PARTITION BY MetricName, user_text, host, scope ORDER BY TimeUnixNs)) WHERE before IS NOT NULL)
  GROUP BY ALL"""))
def _(v):
    # Two scopes share each series, and every day counts from a new start.
    points = v.sum.withColumns({
        "ScopeName": F.concat(F.lit("s"), F.expr("TimeUnixNs DIV 1000000 % 2")), "StartTimeUnixNs": F.expr("TimeUnixNs DIV 86400000000000"),
    })
    deltas = metric_ops.cumulative_to_delta(points).withColumn("scope", F.col("ScopeName"))
    return deltas.selectExpr("MetricName", USER, "scope", "TimeUnixNs", "Value").groupBy("MetricName", "user_text", "scope", "TimeUnixNs").agg(
        F.count("*").alias("points"), F.round(F.sum("Value"), 6).alias("value")
    )


@query("delta_to_rate", duck("sum_v", """SELECT MetricName, user_text, TimeUnixNs,
  CASE WHEN TimeUnixNs > StartTimeUnixNs THEN round(Value / ((TimeUnixNs - StartTimeUnixNs) / 1000000000.0::DOUBLE), 6) END AS rate
  FROM delta""", lagged=LAGGED_SQL, delta=DELTA_SQL))
def _(v):
    rates = metric_ops.delta_to_rate(metric_ops.cumulative_to_delta(v.sum))
    return rates.selectExpr("MetricName", USER, "TimeUnixNs", "round(Rate, 6) AS rate")


# Two gauges per event, so that every pair of points shares time and series.
PAIR_SQL = """SELECT user_text, host, TimeUnixNs, Value AS a, Value * 2 + 1 AS b FROM gauge_v WHERE event_type = 'click'"""


def _pairs(v):
    a = v.gauge.filter(F.col("MetricName") == "click.value")
    b = a.withColumns({"MetricName": F.lit("click.other"), "Value": F.col("Value") * 2 + 1})
    return a.unionByName(b)


def _derived(operation: str, expression: str):
    @query(f"derive_metric_{operation}", duck("gauge_v", f"""SELECT 'derived' AS MetricName, user_text, host, TimeUnixNs,
      round({expression}, 6) AS value FROM pairs""", pairs=PAIR_SQL))
    def _(v):
        derived = metric_ops.derive_metric(_pairs(v), "derived", "click.value", "click.other", operation)
        return derived.selectExpr("MetricName", USER, HOST, "TimeUnixNs", "round(Value, 6) AS value")


_derived("add", "a + b")
_derived("subtract", "a - b")
_derived("multiply", "a * b")
_derived("divide", "a / b")
_derived("percent", "a / b * 100")


@query("scale_metric", duck("gauge_v", """SELECT 'view.ms' AS MetricName, user_text, TimeUnixNs, round(Value * 1000, 6) AS value
  FROM gauge_v WHERE event_type = 'view'"""))
def _(v):
    scaled = metric_ops.scale_metric(v.gauge, "view.ms", "view.value", 1000)
    return scaled.selectExpr("MetricName", USER, "TimeUnixNs", "round(Value, 6) AS value")


def _transformed(how: str, sql: str):
    @query(f"transform_metrics_{how}", duck("gauge_v", f"""SELECT replace(MetricName, 'click.value', 'clicks') AS MetricName,
      host, TimeUnixNs // 86400000000000 AS day_number, round({sql}(Value), 6) AS value FROM gauge_v GROUP BY ALL"""))
    def _(v):
        # All points of a day at one time, so that there is something to aggregate.
        points = v.gauge.withColumn("TimeUnixNs", F.col("TimeUnixNs") - F.pmod("TimeUnixNs", F.lit(86_400_000_000_000)))
        done = metric_ops.transform_metrics(points, {"click.value": "clicks"}, [], how)
        return done.select(
            "MetricName", F.col("ResourceAttributes")["host.name"].alias("host"),
            F.expr("TimeUnixNs DIV 86400000000000").alias("day_number"), F.round("Value", 6).alias("value")
        )


for _how, _sql in (("sum", "sum"), ("mean", "avg"), ("min", "min"), ("max", "max")):
    _transformed(_how, _sql)


# ---- from spans -------------------------------------------------------------------------------

BOUNDS = (10.0, 50.0, 100.0)
COUNTS_SQL = """count(CASE WHEN Duration <= 10000000 THEN 1 END) || ',' ||
  count(CASE WHEN Duration > 10000000 AND Duration <= 50000000 THEN 1 END) || ',' ||
  count(CASE WHEN Duration > 50000000 AND Duration <= 100000000 THEN 1 END) || ',' ||
  count(CASE WHEN Duration > 100000000 THEN 1 END)"""


@query("span_metrics", duck("spans_v", f"""SELECT epoch_us("Timestamp") // 3600000000 * 3600 AS window_s, ServiceName, SpanName, SpanKind,
  StatusCode, host, count(*) AS calls, sum(Duration)::BIGINT AS duration_sum_ns, {COUNTS_SQL} AS buckets
  FROM spans_v GROUP BY ALL"""))
def _(v):
    made = span_metrics.span_metrics(v.spans, ("host.name",), BOUNDS, width=3600)
    return made.select(
        F.unix_seconds("window_start").alias("window_s"), "ServiceName", "SpanName", "SpanKind", "StatusCode",
        F.col("`host.name`").alias("host"), "calls", "duration_sum_ns",
        F.concat_ws(",", F.col("bucket_counts").cast("array<string>")).alias("buckets"),
    )


GRAPH_SQL = """
  SELECT c.ServiceName AS client, s.ServiceName AS server, c.host AS client_host, s.host AS server_host, count(*) AS calls,
    count(CASE WHEN c.StatusCode = 'STATUS_CODE_ERROR' OR s.StatusCode = 'STATUS_CODE_ERROR' THEN 1 END) AS failed,
    sum(c.Duration)::BIGINT AS client_duration_ns, sum(s.Duration)::BIGINT AS server_duration_ns,
    count(CASE WHEN c.Duration <= 10000000 THEN 1 END) || ',' || count(CASE WHEN c.Duration > 10000000 AND c.Duration <= 50000000 THEN 1 END)
      || ',' || count(CASE WHEN c.Duration > 50000000 AND c.Duration <= 100000000 THEN 1 END) || ',' || count(CASE WHEN c.Duration > 100000000 THEN 1 END) AS client_buckets,
    count(CASE WHEN s.Duration <= 10000000 THEN 1 END) || ',' || count(CASE WHEN s.Duration > 10000000 AND s.Duration <= 50000000 THEN 1 END)
      || ',' || count(CASE WHEN s.Duration > 50000000 AND s.Duration <= 100000000 THEN 1 END) || ',' || count(CASE WHEN s.Duration > 100000000 THEN 1 END) AS server_buckets
  FROM spans_v c JOIN spans_v s ON s.TraceId = c.TraceId AND s.ParentSpanId = c.SpanId
  WHERE c.TraceId <> '' AND c.SpanKind = 'SPAN_KIND_CLIENT' AND s.SpanKind = 'SPAN_KIND_SERVER'
  GROUP BY ALL
"""


@query("service_graph", duck("spans_v", GRAPH_SQL))
def _(v):
    edges = span_metrics.service_graph(v.spans, ("host.name",), BOUNDS)
    return edges.select(
        "client", "server", F.col("`client_host.name`").alias("client_host"), F.col("`server_host.name`").alias("server_host"),
        "calls", "failed", "client_duration_ns", "server_duration_ns",
        F.concat_ws(",", F.col("client_bucket_counts").cast("array<string>")).alias("client_buckets"),
        F.concat_ws(",", F.col("server_bucket_counts").cast("array<string>")).alias("server_buckets"),
    )


@query("count_signals", duck("spans_v", """SELECT ServiceName, SpanKind, count(*) AS count,
  count(CASE WHEN StatusCode = 'STATUS_CODE_ERROR' THEN 1 END) AS errors,
  count(CASE WHEN Duration > 100000000 THEN 1 END) AS slow FROM spans_v GROUP BY 1, 2"""))
def _(v):
    return span_metrics.count_signals(
        v.spans, ["ServiceName", "SpanKind"],
        {"errors": F.col("StatusCode") == "STATUS_CODE_ERROR", "slow": F.col("Duration") > 100_000_000},
    )


@query("interval_counts", duck("spans_v", """SELECT epoch_us("Timestamp") // 900000000 * 900 AS start_s, SpanName, count(*) AS count
  FROM spans_v GROUP BY 1, 2"""))
def _(v):
    counts = span_metrics.interval_counts(v.spans, ["SpanName"], 900)
    return counts.select(F.unix_seconds("interval_start").alias("start_s"), "SpanName", "count")
