"""Log queries, over event logs and over the multilingual documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import query
from checks.traces import TRACE
from checks.views import duck
from telesift.operators import logs as log_ops
from telesift.plans.log_search import LogQuery, search_logs

START = dt.datetime(2024, 1, 1)
OUT = ("TimestampNs", "SpanId", "ServiceName", "SeverityText", "Body")
OUT_SQL = ", ".join(OUT)
DOC_OUT = ("TimestampNs", "SpanId", "ServiceName")
DOC_SQL = ", ".join(DOC_OUT)
TOKEN_SQL = r"regexp_matches(Body, '(^|[\x00-/:-@\[-`{-\x7F])the($|[\x00-/:-@\[-`{-\x7F])')"


@query("severity_series", duck("logs_v", """SELECT epoch_us("Timestamp") // 60000000 * 60 AS time_s, SeverityText,
  count(*) AS count FROM logs_v WHERE "Timestamp" >= TIMESTAMP '2024-01-01' GROUP BY 1, 2"""))
def _(v):
    series = log_ops.severity_series(v.logs, START)
    return series.select(F.unix_seconds("time").alias("time_s"), "SeverityText", "count")


@query("severity_series_by_hour", duck("logs_v", """SELECT epoch_us("Timestamp") // 3600000000 * 3600 AS time_s, SeverityText,
  count(*) AS count FROM logs_v GROUP BY 1, 2"""))
def _(v):
    series = log_ops.severity_series(v.logs, width=3600)
    return series.select(F.unix_seconds("time").alias("time_s"), "SeverityText", "count")


@query("recent_logs", duck("logs_v", f"SELECT {OUT_SQL} FROM logs_v ORDER BY TimestampNs DESC, SpanId LIMIT 100"))
def _(v):
    return log_ops.recent_logs(v.logs, START, limit=100).select(*OUT)


@query("logs_by_service", duck("logs_v", f"SELECT {OUT_SQL} FROM logs_v WHERE ServiceName = 'svc-signup'"))
def _(v):
    return log_ops.logs_by_service(v.logs, "svc-signup", START, limit=None).select(*OUT)


@query("logs_by_attribute", duck("logs_v", f"SELECT {OUT_SQL} FROM logs_v WHERE k = '17'"))
def _(v):
    return log_ops.logs_by_attribute(v.logs, "k", "17", START, limit=None).select(*OUT)


@query("logs_without_attribute", duck("logs_v", f"SELECT {OUT_SQL} FROM logs_v"))
def _(v):
    return log_ops.logs_by_attribute(v.logs, "absent", "", START, limit=None).select(*OUT)


@query("logs_has_token", duck("doc_logs_v", f"SELECT {DOC_SQL} FROM doc_logs_v WHERE {TOKEN_SQL}"))
def _(v):
    return log_ops.logs_has_token(v.doc_logs, "the", START, limit=None).select(*DOC_OUT)


@query("logs_like", duck("doc_logs_v", f"SELECT {DOC_SQL} FROM doc_logs_v WHERE Body LIKE '%tion%'"))
def _(v):
    return log_ops.logs_like(v.doc_logs, "%tion%", START, limit=None).select(*DOC_OUT)


@query("logs_match", duck("doc_logs_v", rf"SELECT {DOC_SQL} FROM doc_logs_v WHERE regexp_matches(Body, '[a-z0-9.]+@[a-z]+|[0-9]{{3}}-[0-9]{{4}}')"))
def _(v):
    return log_ops.logs_match(v.doc_logs, r"[a-z0-9.]+@[a-z]+|[0-9]{3}-[0-9]{4}", START, limit=None).select(*DOC_OUT)


@query("logs_json_number", duck("logs_v", f"""SELECT {OUT_SQL} FROM logs_v
  WHERE coalesce(try_cast(json_extract_string(Body, '$.k') AS DOUBLE), 0) > 50"""))
def _(v):
    return log_ops.logs_json_number(v.logs, "$.k", ">", 50, START, limit=None).select(*OUT)


@query("search_logs", duck("logs_v", f"""SELECT {OUT_SQL} FROM logs_v WHERE ServiceName = 'svc-error' AND SeverityNumber >= 17
  AND event_type = 'error' AND Body LIKE '%k%' AND regexp_matches(Body, '[0-9]') AND CAST(k AS DOUBLE) <= 80
  AND "Timestamp" BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'"""))
def _(v):
    wanted = LogQuery(
        service_name="svc-error", severity_text="ERROR", min_severity=17, attributes={"event": "error"}, like="%k%",
        tokens=("k",), regex="[0-9]", json_numbers=(("$.k", "<=", 80),), start=START, end=dt.datetime(2024, 1, 31), limit=None,
    )
    return search_logs(v.logs, wanted).select(*OUT)


@query("logs_for_trace", duck("logs_v", f"SELECT {OUT_SQL} FROM logs_v WHERE TraceId = '{TRACE}'"))
def _(v):
    return log_ops.logs_for_trace(v.logs, TRACE).select(*OUT)
