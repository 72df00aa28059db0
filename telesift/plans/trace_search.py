"""Trace lookup and the two kinds of trace search."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.functions import times
from telesift.operators.bounds import merge_trace_bounds
from telesift.operators.spans import span_filter, trace_summaries
from telesift.sources.tables import DAY, time_range

DEFAULT_TRACES = 20


@dataclass(frozen=True)
class TraceQuery:
    """What to search for; durations are total nanoseconds, all bounds inclusive and optional."""

    service_name: str = ""
    operation_name: str = ""
    tags: dict[str, str] = field(default_factory=dict)
    start: dt.datetime | None = None
    end: dt.datetime | None = None
    duration_min: int | None = None
    duration_max: int | None = None
    num_traces: int = 0

    @property
    def limit(self) -> int:
        return self.num_traces if self.num_traces > 0 else DEFAULT_TRACES


def _between(value: Column, low: int | None, high: int | None) -> Column:
    condition = F.lit(True)
    if low is not None:
        condition = condition & (value >= low)
    if high is not None:
        condition = condition & (value <= high)
    return condition


def _spans_of(spans: DataFrame, traces: DataFrame) -> DataFrame:
    """All spans of traces given with their Start and End.

    On a table with days only the days that some trace touches are read, not those between: their set, which the number of days
    bounds, is a scalar subquery that Spark runs first. How the join is done is left to Spark, which knows the sizes.
    """
    if DAY in spans.columns:
        touched = traces.select(F.explode(F.sequence(F.to_date("Start"), F.to_date("End"))).alias("d"))
        spans = spans.filter(F.array_contains(touched.agg(F.collect_set("d").alias("days")).scalar(), F.col(DAY)))
    return spans.join(traces.select("TraceId"), "TraceId", "left_semi")


def get_trace(spans: DataFrame, trace_id: str) -> DataFrame:
    """All spans of one trace."""
    if not trace_id:
        raise ValueError("trace id must not be empty")
    return spans.filter(F.col("TraceId") == trace_id)


def get_trace_pruned(spans: DataFrame, bounds: DataFrame, trace_id: str, limit: int | None = None) -> DataFrame:
    """Spans of one trace, read only from the days its bounds name; from all days where it has no bounds.

    The bounds are two scalar subqueries; Spark runs them first and prunes the day partitions.
    """
    one = bounds.filter(F.col("TraceId") == trace_id)
    start = one.agg(F.min("Start").alias("s")).scalar()
    end = one.agg((F.max("End") + F.expr("INTERVAL 1 SECOND")).alias("e")).scalar()
    rows = time_range(get_trace(spans, trace_id), "Timestamp", start, end)
    return rows if limit is None else rows.orderBy("TimestampNs", "SpanId").limit(limit)


def find_trace_ids(spans: DataFrame, query: TraceQuery) -> DataFrame:
    """Ids of the traces with most matching spans, largest count first."""
    if query.start is None or query.end is None or not query.start < query.end:
        raise ValueError("start time must be before end time, and both must be given")
    rows = time_range(spans, "Timestamp", query.start, query.end)
    rows = span_filter(rows, query.service_name, query.operation_name, query.tags)
    rows = rows.filter(_between(F.col("Duration"), query.duration_min, query.duration_max))
    return (
        rows.filter(F.col("TraceId") != "")
        .groupBy("TraceId")
        .agg(F.count("*").alias("matches"))
        .orderBy(F.desc("matches"), "TraceId")
        .limit(query.limit)
    )


def search_traces_by_matches(spans: DataFrame, query: TraceQuery, bounds: DataFrame | None = None) -> DataFrame:
    """Summaries of the traces with most matching spans: filter first, then limit.

    A trace may reach beyond the time searched. With its bounds known only the days it touches
    are read for its other spans, without them all days are.
    """
    ids = find_trace_ids(spans, query).select("TraceId")
    if bounds is None:
        return trace_summaries(spans.join(ids, "TraceId", "left_semi"))
    traces = merge_trace_bounds(bounds.join(ids, "TraceId", "left_semi"))
    return trace_summaries(_spans_of(spans, traces))


def search_spans_recent(spans: DataFrame, bounds: DataFrame, query: TraceQuery) -> DataFrame:
    """Matching spans of the newest traces: limit first, then filter, so there may be fewer traces.

    `bounds` may hold partial rows; they are merged first.
    """
    bounds = bounds.filter(F.col("TraceId") != "")
    asked = [(bound, is_start) for bound, is_start in ((query.start, True), (query.end, False)) if bound is not None]
    if asked and DAY in bounds.columns:
        # A trace that starts in the range has a partial row that does: only traces with one on those days are merged.
        near = time_range(bounds, "Start", query.start, query.end).select("TraceId").distinct()
        bounds = bounds.join(near, "TraceId", "left_semi")
    merged = merge_trace_bounds(bounds)
    for bound, is_start in asked:
        limit = times.moment(bound)
        merged = merged.filter(F.col("Start") >= limit if is_start else F.col("Start") <= limit)
    length_ns = (F.unix_micros("End") - F.unix_micros("Start")) * 1000
    merged = merged.filter(_between(length_ns, query.duration_min, query.duration_max))
    newest = merged.orderBy(F.desc("Start"), "TraceId").limit(query.limit)
    rows = _spans_of(spans, newest)
    return span_filter(rows, query.service_name, query.operation_name, query.tags)


def multi_get_traces(
    spans: DataFrame,
    ids: DataFrame | Iterable[str],
    max_rows: int | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Spans of many traces, by a list of ids or a DataFrame with a TraceId column.

    With the traces' bounds only the days they touch are read.
    """
    if not isinstance(ids, DataFrame):
        ids = spans.sparkSession.createDataFrame([(i,) for i in ids], "TraceId string")
    wanted = ids.select("TraceId").filter(F.col("TraceId") != "")
    if bounds is not None:
        found = _spans_of(spans, merge_trace_bounds(bounds.join(wanted, "TraceId", "left_semi")))
    else:
        found = spans.join(wanted, "TraceId", "left_semi")
    return found if max_rows is None else found.orderBy("TraceId", "TimestampNs", "SpanId").limit(max_rows)
