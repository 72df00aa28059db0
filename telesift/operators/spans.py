"""Operators over the spans of traces: roots, summaries, catalogues, filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.functions import maps, times
from telesift.sources.tables import attribute_equals, time_range

# Fixed values of the summary's status.
UNHEALTHY = 0
HEALTHY = 1

READER_COLUMNS = (
    "Timestamp", "TimestampNs", "TraceId", "SpanId", "ParentSpanId", "SpanName", "SpanKind", "ServiceName",
    "Duration", "StatusCode", "StatusMessage",
)


def span_filter(
    spans: DataFrame,
    service: str | None = None,
    operation: str | None = None,
    attributes: dict[str, str] | None = None,
) -> DataFrame:
    """Spans of a service and operation that carry all attributes, on the span or else its resource."""
    if service:
        spans = spans.filter(F.col("ServiceName") == service)
    if operation:
        spans = spans.filter(F.col("SpanName") == operation)
    for key, value in (attributes or {}).items():
        spans = spans.filter(attribute_equals(spans, ["SpanAttributes", "ResourceAttributes"], key, value))
    return spans


def display(spans: DataFrame) -> DataFrame:
    """The reader's columns, with maps and nested columns as text."""
    return spans.select(
        *READER_COLUMNS,
        maps.as_text(F.col("SpanAttributes")).alias("SpanAttributes"),
        maps.as_text(F.col("ResourceAttributes")).alias("ResourceAttributes"),
        maps.as_text(F.col("Events.Name")).alias("EventNames"),
        maps.as_text(F.col("Links.TraceId")).alias("LinkTraceIds"),
    )


def first_rows(rows: DataFrame, limit: int | None, *order) -> DataFrame:
    """Top rows in a fixed order, or all rows unsorted where there is no limit."""
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def spans_with_attribute(
    spans: DataFrame, service: str, key: str, value: str, since=None, limit: int | None = None
) -> DataFrame:
    rows = time_range(spans, "Timestamp", since).filter(F.col("ServiceName") == service)
    rows = rows.filter(attribute_equals(spans, ["SpanAttributes"], key, value))
    return first_rows(rows, limit, "TimestampNs", "SpanId")


def error_spans(spans: DataFrame, service: str, since=None, limit: int | None = None) -> DataFrame:
    rows = time_range(spans, "Timestamp", since).filter(
        (F.col("ServiceName") == service) & (F.col("StatusCode") == "STATUS_CODE_ERROR")
    )
    return first_rows(rows, limit, "TimestampNs", "SpanId")


def slow_spans(
    spans: DataFrame, service: str, min_ns: int = 1_000_000_000, since=None, limit: int | None = None
) -> DataFrame:
    """Spans that took longer than `min_ns`."""
    rows = time_range(spans, "Timestamp", since).filter(
        (F.col("ServiceName") == service) & (F.col("Duration") > min_ns)
    )
    return first_rows(rows, limit, "TimestampNs", "SpanId")


# ---- roots and summaries ----------------------------------------------------------------------

_ROOT_FIELDS = ("TimestampNs", "SpanId", "SpanName", "SpanKind", "StatusCode", "ServiceName", "Duration")


def _root_struct() -> Column:
    return F.struct(*_ROOT_FIELDS)


def _order_struct() -> Column:
    """The same type with only what orders spans, for rows that are never roots."""
    order, rest = _ROOT_FIELDS[:2], _ROOT_FIELDS[2:]
    return F.struct(*order, *[F.when(F.lit(False), F.col(name)).alias(name) for name in rest])


def _by_span_key(spans: DataFrame, with_services: bool) -> DataFrame:
    """One row per (trace, part, key), from one pass over the spans.

    Every span is sent twice: under its own id ("span") and, as a root candidate, under its
    parent's id; only the first candidate per parent is kept, on the map side, so neither a
    giant trace nor a parent with countless children makes one large group. A candidate whose
    key no span has is a root. With services, every span is also sent under its service.
    """
    none, no_root = F.lit(None), F.when(F.lit(False), _root_struct())
    no_resource = none.cast("map<string,string>")

    def row(part: str, key: str, counted: Column, candidate: Column, resource: Column) -> Column:
        fields = {"part": F.lit(part), "key": F.col(key), "spans": counted.cast("bigint"), "candidate": candidate}
        if with_services:
            fields["resource"] = resource
        return F.struct(*[value.alias(name) for name, value in fields.items()])

    sent = [
        row("id", "SpanId", F.lit(1), no_root, no_resource),
        row("id", "ParentSpanId", none, _root_struct(), no_resource),
    ]
    aggregates = [F.sum("spans").alias("spans"), F.min("candidate").alias("candidate")]
    if with_services:
        sent.append(row("service", "ServiceName", none, _order_struct(), F.col("ResourceAttributes")))
        aggregates.append(F.min_by("resource", "candidate").alias("resource"))
    return (
        spans.filter(F.col("TraceId") != "")
        .select("TraceId", F.explode(F.array(*sent)).alias("x"))
        .select("TraceId", "x.*")
        .filter((F.col("part") == "id") | (F.col("key") != ""))
        .groupBy("TraceId", "part", "key")
        .agg(*aggregates)
    )


def _root() -> Column:
    """The trace's first candidate under a key that no span of the trace has."""
    orphaned = (F.col("part") == "id") & F.col("spans").isNull()
    return F.min(F.when(orphaned, F.col("candidate")))


def root_spans(spans: DataFrame) -> DataFrame:
    """Per trace the first span, by time and id, whose parent is not in the trace.

    Orphans count as roots; a trace whose parents form a cycle has none.
    """
    return (
        _by_span_key(spans, with_services=False)
        .groupBy("TraceId")
        .agg(_root().alias("root"))
        .filter(F.col("root").isNotNull())
        .select("TraceId", "root.*")
    )


def trace_status(status_code: Column, kind: Column) -> Column:
    """Health of a trace by its root span; whatever is not known to be well is unhealthy."""
    unset = status_code == "STATUS_CODE_UNSET"
    well = (status_code == "STATUS_CODE_OK") | (unset & kind.isin("SPAN_KIND_SERVER", "SPAN_KIND_INTERNAL"))
    return F.when(well, F.lit(HEALTHY)).otherwise(F.lit(UNHEALTHY))


def trace_processes(spans: DataFrame) -> DataFrame:
    """One process per trace and service: its name and the other attributes of its first resource."""
    order = F.struct("TimestampNs", "SpanId")
    return (
        spans.filter((F.col("TraceId") != "") & (F.col("ServiceName") != ""))
        .groupBy("TraceId", "ServiceName")
        .agg(F.min_by("ResourceAttributes", order).alias("resource"))
        .select("TraceId", "ServiceName", maps.without_keys(F.col("resource"), ["service.name"]).alias("Tags"))
    )


def trace_summaries(spans: DataFrame) -> DataFrame:
    """One record per trace: span count, root operation, health, start, duration, processes.

    Two combining aggregations over a single scan. The list of processes holds one entry per
    distinct service of the trace, not per span.
    """
    process = F.struct(
        F.col("key").alias("service_name"),
        maps.without_keys(F.col("resource"), ["service.name"]).alias("tags"),
    )
    per_trace = (
        _by_span_key(spans, with_services=True)
        .groupBy("TraceId")
        .agg(
            F.sum("spans").alias("span_count"),
            _root().alias("root"),
            F.collect_list(F.when(F.col("part") == "service", process)).alias("processes"),
        )
    )
    root = F.col("root")
    start_us = times.floor_div(root["TimestampNs"], 1000)
    return per_trace.select(
        F.col("TraceId").alias("trace_id"),
        F.coalesce(root["SpanName"], F.lit("")).alias("operation_name"),
        trace_status(root["StatusCode"], root["SpanKind"]).alias("status"),
        "span_count",
        F.timestamp_micros(start_us).alias("start_time"),
        root["Duration"].alias("duration_ns"),
        F.coalesce(times.format_duration(root["Duration"]), F.lit("")).alias("duration"),
        F.array().cast("array<string>").alias("warnings"),
        F.array_sort("processes", lambda a, b: F.when(a["service_name"] < b["service_name"], -1)
                     .when(a["service_name"] > b["service_name"], 1).otherwise(0)).alias("process_map"),
    )


# ---- catalogues -------------------------------------------------------------------------------


def services_latest(spans: DataFrame, start=None, end=None) -> DataFrame:
    """Per service the resource attributes at its newest timestamp; ties stay as several rows.

    The spans are first combined to one row per distinct resource, so that only these are
    compared with the service's newest time, spread by service and time.
    """
    spans = time_range(spans, "Timestamp", start, end)
    per_resource = spans.groupBy("ServiceName", "ResourceAttributes").agg(F.max("TimestampNs").alias("TimestampNs"))
    newest = per_resource.groupBy("ServiceName").agg(F.max("TimestampNs").alias("TimestampNs"))
    return per_resource.join(newest, ["ServiceName", "TimestampNs"], "left_semi").select(
        "ServiceName", "ResourceAttributes", "TimestampNs"
    )


def services_top(spans: DataFrame, n: int | None = None, start=None, end=None) -> DataFrame:
    """The services with most spans; spans without a service name do not count."""
    counted = (
        time_range(spans, "Timestamp", start, end).filter(F.col("ServiceName") != "")
        .groupBy("ServiceName")
        .agg(F.count("*").alias("span_count"))
    )
    return first_rows(counted, n, F.desc("span_count"), "ServiceName")


def operations(spans: DataFrame, service: str | None = None, kind: str | None = None, start=None, end=None) -> DataFrame:
    rows = span_filter(time_range(spans, "Timestamp", start, end), service)
    if kind:
        rows = rows.filter(F.col("SpanKind") == kind)
    return rows.select("SpanName").distinct()


def operations_top(
    spans: DataFrame, service: str | None = None, kind: str | None = None, n: int | None = None, start=None, end=None
) -> DataFrame:
    """Operations by span count; without a kind, internal spans do not count."""
    rows = span_filter(time_range(spans, "Timestamp", start, end), service)
    rows = rows.filter(F.col("SpanKind") == kind if kind else F.col("SpanKind") != "SPAN_KIND_INTERNAL")
    counted = rows.groupBy("SpanName").agg(F.count("*").alias("span_count"))
    return first_rows(counted, n, F.desc("span_count"), "SpanName")


# ---- regrouping -------------------------------------------------------------------------------


def in_parts(rows: DataFrame, keys: Iterable[str], spread: Iterable[str], max_rows: int) -> DataFrame:
    """Adds `part` and `parts`, so that groups of (keys, part) stay near `max_rows` rows.

    Groups are counted first, on the map side; the few over the bound are joined back, by whatever join Spark finds best.
    """
    keys = list(keys)
    large = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > max_rows)
        .select(*keys, F.ceil(F.col("_rows") / max_rows).cast("int").alias("parts"))
    )
    joined = rows.join(large, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return joined.withColumn("part", F.pmod(F.xxhash64(*spread), F.col("parts")).cast("int"))


def spans_to_resource_spans(spans: DataFrame, max_spans: int = 10_000) -> DataFrame:
    """Spans regrouped under one resource per distinct attribute set.

    A resource with more than `max_spans` spans comes as several rows, as the message form
    allows; no group is gathered whole.
    """
    keyed = spans.withColumn("resource_id", maps.attributes_id(F.col("ResourceAttributes")))
    parts = in_parts(keyed, ["resource_id"], ["TraceId", "SpanId", "TimestampNs"], max_spans)
    span = F.struct(
        "TraceId", "SpanId", "ParentSpanId", "TraceState", "SpanName", "SpanKind", "TimestampNs",
        (F.col("TimestampNs") + F.col("Duration")).alias("EndTimestampNs"),
        "SpanAttributes", "Events", "Links", "StatusCode", "StatusMessage",
    )
    return parts.groupBy("resource_id", "part", "parts").agg(
        F.any_value("ResourceAttributes").alias("ResourceAttributes"), F.collect_list(span).alias("Spans")
    )
