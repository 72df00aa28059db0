"""Stored flat JSON documents read back as spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift import schema
from telesift.functions import ids, maps, names, times


def _under(fields: Column, prefix: str) -> Column:
    """The fields below a dotted prefix, as a map without it."""
    kept = F.map_filter(fields, lambda k, v: k.startswith(prefix) & v.isNotNull())
    return F.transform_keys(kept, lambda k, _: F.substring(k, len(prefix) + 1, 2147483647))


def documents_to_spans(documents: DataFrame, column: str = "document") -> DataFrame:
    """Documents of the span encoder to the spans table; attribute values come back as strings.

    What is no JSON object gives a span without ids, which validation puts into quarantine.
    """
    rows = documents.filter(F.col(column).isNotNull()).select(F.from_json(column, "map<string,string>").alias("d"))
    d = F.col("d")
    start = F.coalesce(times.parse_ns(d["@timestamp"]), F.lit(0).cast("bigint"))
    end = F.coalesce(times.parse_ns(d["EndTimestamp"]), F.lit(0).cast("bigint"))
    resource = _under(d, "Resource.")
    columns = {
        "Timestamp": times.ns_to_timestamp(start),
        "TimestampNs": start,
        "TraceId": ids.normal_id(d["TraceId"]),
        "SpanId": ids.normal_id(d["SpanId"]),
        "ParentSpanId": ids.normal_id(d["ParentSpanId"]),
        "SpanName": maps.attribute(d, "Name"),
        "SpanKind": names.span_kind_name(d["Kind"]),
        "ServiceName": maps.attribute(d, "Resource.service.name"),
        "ResourceAttributes": resource,
        "SpanAttributes": _under(d, "Attributes."),
        "Duration": end - start,
        "StatusCode": names.status_code_name(d["TraceStatus"]),
        "Events": F.array().cast(schema.EVENTS),
        "Links": F.array().cast(schema.LINKS),
    }
    blank = F.lit("")
    return rows.select(*[columns.get(c, blank).alias(c) for c in schema.SPANS.names])
