"""Small tables for tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from telesift.functions import times
from telesift.schema import SPANS
from telesift.sources import otlp


def spans_of(spark, rows: list[dict]):
    """Spans from the given columns; ids, names and times default to something plain."""
    full = []
    for i, row in enumerate(rows):
        ns = row.get("TimestampNs", 1_700_000_000_000_000_000 + i)
        full.append({
            "TimestampNs": ns, "TraceId": "t1", "SpanId": f"s{i}", "ParentSpanId": "", "TraceState": "", "SpanName": "op",
            "SpanKind": "SPAN_KIND_SERVER", "ServiceName": "svc", "ResourceAttributes": {"service.name": row.get("ServiceName", "svc")},
            "ScopeName": "", "ScopeVersion": "", "SpanAttributes": {}, "Duration": 1000, "StatusCode": "STATUS_CODE_UNSET",
            "StatusMessage": "", "Events": [], "Links": [], **row,
        })
    names = [n for n in SPANS.names if n != "Timestamp"]
    schema = SPANS.__class__([f for f in SPANS.fields if f.name != "Timestamp"])
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)
    return df.withColumn("Timestamp", times.ns_to_timestamp(F.col("TimestampNs"))).select(*SPANS.names)


def messages_of(spark, messages: list, signal: str):
    """Parsed OTLP messages; a string stays as it is."""
    texts = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    return otlp.parse_otlp_json(spark.createDataFrame(texts, "value string"), "value", signal)


def attrs(**values) -> list:
    """An attribute list; Python types choose the value's kind, `_` in keys becomes a dot."""
    return [{"key": k.replace("_", "."), "value": any_value(v)} for k, v in values.items()]


def any_value(v) -> dict:
    if isinstance(v, bool):
        return {"boolValue": v}
    if isinstance(v, int):
        return {"intValue": str(v)}
    if isinstance(v, float):
        return {"doubleValue": v}
    if isinstance(v, list):
        return {"arrayValue": {"values": [any_value(i) for i in v]}}
    if isinstance(v, dict):
        return {"kvlistValue": {"values": [{"key": k, "value": any_value(i)} for k, i in v.items()]}}
    return {} if v is None else {"stringValue": v}


def trace_message(spans: list, resource=None, scope=None) -> dict:
    one = {"scopeSpans": [{"scope": scope or {}, "spans": spans}]}
    if resource is not None:
        one["resource"] = {"attributes": resource}
    return {"resourceSpans": [one]}
