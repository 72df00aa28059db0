"""Log queries. `since` and `limit` are parameters; a limit fixes the order, none leaves all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telesift.functions import text
from telesift.operators.spans import first_rows
from telesift.sources.tables import attribute_equals, time_range

# The comparisons a JSON number can be filtered with.
COMPARISONS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
}


def _newest(rows: DataFrame, limit: int | None) -> DataFrame:
    return first_rows(rows, limit, F.desc("TimestampNs"), "SpanId")


def severity_series(logs: DataFrame, since=None, width: int = 60) -> DataFrame:
    """Records per interval of `width` seconds and severity."""
    interval = F.window("Timestamp", f"{width} seconds")
    return (
        time_range(logs, "Timestamp", since)
        .groupBy(interval.alias("interval"), "SeverityText")
        .agg(F.count("*").alias("count"))
        .select(F.col("interval.start").alias("time"), "SeverityText", "count")
    )


def recent_logs(logs: DataFrame, since=None, limit: int | None = None) -> DataFrame:
    return _newest(time_range(logs, "Timestamp", since), limit)


def logs_by_service(logs: DataFrame, service: str, since=None, limit: int | None = None) -> DataFrame:
    return _newest(time_range(logs, "Timestamp", since).filter(F.col("ServiceName") == service), limit)


def logs_by_attribute(logs: DataFrame, key: str, value: str, since=None, limit: int | None = None) -> DataFrame:
    rows = time_range(logs, "Timestamp", since)
    return _newest(rows.filter(attribute_equals(rows, ["LogAttributes"], key, value)), limit)


def logs_has_token(logs: DataFrame, token: str, since=None, limit: int | None = None) -> DataFrame:
    """Records whose body has the whole, case-sensitive token."""
    return _newest(time_range(logs, "Timestamp", since).filter(text.has_token(F.col("Body"), token)), limit)


def logs_like(logs: DataFrame, pattern: str, since=None, limit: int | None = None) -> DataFrame:
    return _newest(time_range(logs, "Timestamp", since).filter(F.col("Body").like(pattern)), limit)


def logs_match(logs: DataFrame, regex: str, since=None, limit: int | None = None) -> DataFrame:
    """Records whose body has a match of a regular expression anywhere."""
    return _newest(time_range(logs, "Timestamp", since).filter(F.col("Body").rlike(regex)), limit)


def logs_json_number(
    logs: DataFrame, path: str, comparison: str, number: float, since=None, limit: int | None = None
) -> DataFrame:
    """Records compared by a number in their JSON body; missing or no number counts as 0."""
    compare = COMPARISONS[comparison]
    rows = time_range(logs, "Timestamp", since)
    return _newest(rows.filter(compare(text.json_number(F.col("Body"), path), F.lit(float(number)))), limit)


def logs_for_trace(logs: DataFrame, trace_id: str, bounds: DataFrame | None = None, slack: str = "1 DAY") -> DataFrame:
    """Records of one trace. With the bounds of traces only days within `slack` of them are read, or all where it has none."""
    if not trace_id:
        raise ValueError("trace id must not be empty")
    if bounds is not None:
        one, more = bounds.filter(F.col("TraceId") == trace_id), F.expr(f"INTERVAL {slack}")
        logs = time_range(logs, "Timestamp", one.agg((F.min("Start") - more).alias("s")).scalar(), one.agg((F.max("End") + more).alias("e")).scalar())
    return logs.filter(F.col("TraceId") == trace_id)
