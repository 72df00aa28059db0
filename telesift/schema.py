"""Fixed table schemas. Nanosecond times are kept as BIGINT next to a microsecond TIMESTAMP."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
    TimestampType,
)

TEXT, LONG, INT, DOUBLE, TIME = StringType(), LongType(), IntegerType(), DoubleType(), TimestampType()
ATTRIBUTES = MapType(TEXT, TEXT)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


EVENTS = ArrayType(_struct(Timestamp=TIME, TimestampNs=LONG, Name=TEXT, Attributes=ATTRIBUTES))
LINKS = ArrayType(_struct(TraceId=TEXT, SpanId=TEXT, TraceState=TEXT, Attributes=ATTRIBUTES))
EXEMPLARS = ArrayType(
    _struct(FilteredAttributes=ATTRIBUTES, TimeUnix=TIME, Value=DOUBLE, SpanId=TEXT, TraceId=TEXT)
)
QUANTILES = ArrayType(_struct(Quantile=DOUBLE, Value=DOUBLE))

SPANS = _struct(
    Timestamp=TIME, TimestampNs=LONG, TraceId=TEXT, SpanId=TEXT, ParentSpanId=TEXT, TraceState=TEXT, SpanName=TEXT,
    SpanKind=TEXT, ServiceName=TEXT, ResourceAttributes=ATTRIBUTES, ScopeName=TEXT, ScopeVersion=TEXT,
    SpanAttributes=ATTRIBUTES, Duration=LONG, StatusCode=TEXT, StatusMessage=TEXT, Events=EVENTS, Links=LINKS,
)

LOGS = _struct(
    Timestamp=TIME, TimestampNs=LONG, TraceId=TEXT, SpanId=TEXT, TraceFlags=LONG, SeverityText=TEXT,
    SeverityNumber=INT, ServiceName=TEXT, Body=TEXT, ResourceSchemaUrl=TEXT, ResourceAttributes=ATTRIBUTES,
    ScopeSchemaUrl=TEXT, ScopeName=TEXT, ScopeVersion=TEXT, ScopeAttributes=ATTRIBUTES, LogAttributes=ATTRIBUTES,
)

_POINT = dict(
    ResourceAttributes=ATTRIBUTES, ResourceSchemaUrl=TEXT, ScopeName=TEXT, ScopeVersion=TEXT,
    ScopeAttributes=ATTRIBUTES, ScopeDroppedAttrCount=LONG, ScopeSchemaUrl=TEXT, MetricName=TEXT,
    MetricDescription=TEXT, MetricUnit=TEXT, Attributes=ATTRIBUTES, StartTimeUnix=TIME, StartTimeUnixNs=LONG,
    TimeUnix=TIME, TimeUnixNs=LONG, Flags=LONG,
)
METRICS = {
    "gauge": _struct(**_POINT, Value=DOUBLE, Exemplars=EXEMPLARS),
    "sum": _struct(**_POINT, Value=DOUBLE, Exemplars=EXEMPLARS, AggTemp=INT, IsMonotonic=BooleanType()),
    "histogram": _struct(
        **_POINT, Count=LONG, Sum=DOUBLE, BucketCounts=ArrayType(LONG), ExplicitBounds=ArrayType(DOUBLE),
        Exemplars=EXEMPLARS, Min=DOUBLE, Max=DOUBLE,
    ),
    "exponential_histogram": _struct(
        **_POINT, Count=LONG, Sum=DOUBLE, Scale=INT, ZeroCount=LONG, PositiveOffset=INT,
        PositiveBucketCounts=ArrayType(LONG), NegativeOffset=INT, NegativeBucketCounts=ArrayType(LONG),
        Exemplars=EXEMPLARS, Min=DOUBLE, Max=DOUBLE,
    ),
    "summary": _struct(**_POINT, Count=LONG, Sum=DOUBLE, ValueAtQuantiles=QUANTILES),
}
METRIC_KINDS = tuple(METRICS)
