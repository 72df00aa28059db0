"""Log search: all given conditions at once."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telesift.operators import logs as log_ops
from telesift.sources.tables import time_range


@dataclass(frozen=True)
class LogQuery:
    """What to search for; everything is optional and AND-ed."""

    service_name: str = ""
    severity_text: str = ""
    min_severity: int | None = None
    trace_id: str = ""
    attributes: dict[str, str] = field(default_factory=dict)
    tokens: tuple[str, ...] = ()
    like: str = ""
    regex: str = ""
    json_numbers: tuple[tuple[str, str, float], ...] = ()
    start: dt.datetime | None = None
    end: dt.datetime | None = None
    limit: int | None = None


def search_logs(logs: DataFrame, query: LogQuery) -> DataFrame:
    rows = time_range(logs, "Timestamp", query.start, query.end)
    if query.service_name:
        rows = log_ops.logs_by_service(rows, query.service_name, limit=None)
    if query.severity_text:
        rows = rows.filter(F.col("SeverityText") == query.severity_text)
    if query.min_severity is not None:
        rows = rows.filter(F.col("SeverityNumber") >= query.min_severity)
    if query.trace_id:
        rows = log_ops.logs_for_trace(rows, query.trace_id)
    for key, value in query.attributes.items():
        rows = log_ops.logs_by_attribute(rows, key, value, limit=None)
    for token in query.tokens:
        rows = log_ops.logs_has_token(rows, token, limit=None)
    if query.like:
        rows = log_ops.logs_like(rows, query.like, limit=None)
    if query.regex:
        rows = log_ops.logs_match(rows, query.regex, limit=None)
    for path, comparison, number in query.json_numbers:
        rows = log_ops.logs_json_number(rows, path, comparison, number, limit=None)
    return log_ops.recent_logs(rows, limit=query.limit)
