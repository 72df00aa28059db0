"""OTLP JSON to flat tables: one row per span, log record or data point.

A message is one JSON object per line or per row. Attribute maps are built once per resource
and scope, before the levels below them are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from telesift import schema
from telesift.functions import ids, maps, names, text, times
from telesift.sources.values import FIELDS, KVS, VALUE, attributes_to_fields, attributes_to_map, fields_sql, map_sql, type_sql, json_sql, value_text

SIGNALS = ("traces", "logs", "metrics")
CORRUPT = "_corrupt"

_SCOPE = f"STRUCT<name: STRING, version: STRING, attributes: {KVS}, droppedAttributesCount: STRING>"
_RESOURCE = f"STRUCT<attributes: {KVS}>"
_SPAN = f"""STRUCT<traceId: STRING, spanId: STRING, parentSpanId: STRING, traceState: STRING,
    name: STRING, kind: STRING, startTimeUnixNano: STRING, endTimeUnixNano: STRING, attributes: {KVS},
    events: ARRAY<STRUCT<timeUnixNano: STRING, name: STRING, attributes: {KVS}>>,
    links: ARRAY<STRUCT<traceId: STRING, spanId: STRING, traceState: STRING, attributes: {KVS}>>,
    status: STRUCT<code: STRING, message: STRING>>"""
_RECORD = f"""STRUCT<timeUnixNano: STRING, severityNumber: STRING, severityText: STRING, body: {VALUE},
    attributes: {KVS}, flags: STRING, traceId: STRING, spanId: STRING>"""
_EXEMPLAR = f"""STRUCT<filteredAttributes: {KVS}, timeUnixNano: STRING, asDouble: STRING, asInt: STRING,
    spanId: STRING, traceId: STRING>"""
_BUCKETS = "STRUCT<offset: STRING, bucketCounts: ARRAY<STRING>>"
# What data points hold in the messages, and which of it those of each kind.
_RAW_POINT = {
    "attributes": KVS, "startTimeUnixNano": "STRING", "timeUnixNano": "STRING", "flags": "STRING", "asDouble": "STRING",
    "asInt": "STRING", "exemplars": f"ARRAY<{_EXEMPLAR}>", "count": "STRING", "sum": "STRING", "min": "STRING",
    "max": "STRING", "bucketCounts": "ARRAY<STRING>", "explicitBounds": "ARRAY<STRING>", "scale": "STRING",
    "zeroCount": "STRING", "positive": _BUCKETS, "negative": _BUCKETS,
    "quantileValues": "ARRAY<STRUCT<quantile: STRING, value: STRING>>",
}
_COMMON_FIELDS = ("attributes", "startTimeUnixNano", "timeUnixNano", "flags")
_NUMBER_FIELDS = (*_COMMON_FIELDS, "asDouble", "asInt", "exemplars")
_DISTRIBUTION_FIELDS = (*_COMMON_FIELDS, "count", "sum", "min", "max", "exemplars")
_POINT_FIELDS = {
    "gauge": _NUMBER_FIELDS,
    "sum": _NUMBER_FIELDS,
    "histogram": (*_DISTRIBUTION_FIELDS, "bucketCounts", "explicitBounds"),
    "exponential_histogram": (*_DISTRIBUTION_FIELDS, "scale", "zeroCount", "positive", "negative"),
    "summary": (*_COMMON_FIELDS, "count", "sum", "quantileValues"),
}
# The message field that holds each kind of metric.
METRIC_FIELDS = {
    "gauge": "gauge",
    "sum": "sum",
    "histogram": "histogram",
    "exponential_histogram": "exponentialHistogram",
    "summary": "summary",
}


def _metric_type(kind: str) -> str:
    point = ", ".join(f"{name}: {_RAW_POINT[name]}" for name in _POINT_FIELDS[kind])
    return f"STRUCT<dataPoints: ARRAY<STRUCT<{point}>>, aggregationTemporality: STRING, isMonotonic: STRING>"


_METRIC = (
    "STRUCT<name: STRING, description: STRING, unit: STRING, "
    + ", ".join(f"{field}: {_metric_type(kind)}" for kind, field in METRIC_FIELDS.items())
    + ">"
)


def _message(top: str, scopes: str, items: str, item: str) -> str:
    return (
        f"{top} ARRAY<STRUCT<resource: {_RESOURCE}, schemaUrl: STRING, {scopes}:"
        f" ARRAY<STRUCT<scope: {_SCOPE}, schemaUrl: STRING, {items}: ARRAY<{item}>>>>>, {CORRUPT} STRING"
    )


MESSAGES = {
    "traces": _message("resourceSpans", "scopeSpans", "spans", _SPAN),
    "logs": _message("resourceLogs", "scopeLogs", "logRecords", _RECORD),
    "metrics": _message("resourceMetrics", "scopeMetrics", "metrics", _METRIC),
}


def read_otlp_json(spark: SparkSession, path: str, signal: str) -> DataFrame:
    """JSON-lines files of one signal; a line that is no JSON keeps its text in `_corrupt`."""
    return parse_otlp_json(spark.read.text(path), "value", signal)


def parse_otlp_json(messages: DataFrame, column: str, signal: str) -> DataFrame:
    """The same from a text column, for tables and streams that carry messages.

    Scalars are read as text and judged record by record, so that only what is no JSON, or has lists and objects in the wrong
    places, spoils a whole message.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return messages.select(F.from_json(F.col(column), MESSAGES[signal], options).alias("m")).select("m.*")


# ---- shared pieces ----------------------------------------------------------------------------


def _ns(raw: Column) -> Column:
    """A time or count; none given is 0. What is given and can't be stored is rejected: see is_storable."""
    return F.coalesce(raw.try_cast("bigint"), F.lit(0).cast("bigint"))


def is_storable(raw: Column) -> Column:
    """Whether a time or count is absent, or a whole number of 0 to 2^63 - 1."""
    return F.coalesce(raw.try_cast("bigint") >= 0, raw.isNull())


def _all_storable(*raws: Column) -> Column:
    held = is_storable(raws[0])
    for raw in raws[1:]:
        held = held & is_storable(raw)
    return held


def _each_storable(items: Column) -> Column:
    return F.coalesce(F.forall(items, is_storable), F.lit(True))


def _typed(kind: str, *raws: Column) -> Column:
    """Whether each is absent or reads as the type."""
    held = F.lit(True)
    for raw in raws:
        held = held & (raw.isNull() | raw.try_cast(kind).isNotNull())
    return held


def _each_typed(kind: str, items: Column) -> Column:
    return F.coalesce(F.forall(items, lambda i: _typed(kind, i)), F.lit(True))


BAD_MESSAGE = "message is not valid JSON"
BAD_NUMBER = "a time or count is no whole number of 0 to 2^63 - 1"
BAD_TYPE = "a field is not of its type"
BAD_KIND = "metric type is unset or unsupported"


def _span_fault(span: Column) -> Column:
    """Why a span can't be stored; NULL if it can."""
    events = F.transform(span["events"], lambda e: e["timeUnixNano"])
    whole = _all_storable(span["startTimeUnixNano"], span["endTimeUnixNano"]) & _each_storable(events)
    return F.when(~whole, F.lit(BAD_NUMBER))


def _record_fault(record: Column) -> Column:
    return F.when(~is_storable(record["timeUnixNano"]), F.lit(BAD_NUMBER)).when(~_typed("bigint", record["flags"]), F.lit(BAD_TYPE))


def _point_fault(point: Column, fields: tuple[str, ...] = tuple(_RAW_POINT)) -> Column:
    """The same of a data point that has these fields."""
    of = lambda *names: [point[n] for n in names if n in fields]
    inside = lambda lists, name: [F.transform(point[n], lambda i: i[name]) for n in lists if n in fields]
    plain = _all_storable(*of("startTimeUnixNano", "timeUnixNano", "count", "zeroCount"))
    counts = [*of("bucketCounts"), *[point[n]["bucketCounts"] for n in ("positive", "negative") if n in fields], *inside(["exemplars"], "timeUnixNano")]
    for items in counts:
        plain = plain & _each_storable(items)
    typed = _typed("double", *of("asDouble", "sum", "min", "max")) & _typed("bigint", *of("flags", "asInt"))
    typed = typed & _typed("int", *of("scale"), *[point[n]["offset"] for n in ("positive", "negative") if n in fields])
    numbers = [*of("explicitBounds"), *inside(["exemplars"], "asDouble"), *inside(["quantileValues"], "quantile"), *inside(["quantileValues"], "value")]
    for items in numbers:
        typed = typed & _each_typed("double", items)
    return F.when(~plain, F.lit(BAD_NUMBER)).when(~typed, F.lit(BAD_TYPE))


def _untyped(metric: Column) -> Column:
    held = F.lit(True)
    for field in METRIC_FIELDS.values():
        held = held & metric[field].isNull()
    return held


def _metric_fault(metric: Column) -> Column:
    """Something, where a metric is of no known type or has a point that can't be stored."""
    some = _untyped(metric)
    for kind, field in METRIC_FIELDS.items():
        bad = F.exists(metric[field]["dataPoints"], lambda p: _point_fault(p, _POINT_FIELDS[kind]).isNotNull())  # noqa: B023
        some = some | F.coalesce(bad, F.lit(False)) | ~_typed("boolean", metric[field]["isMonotonic"])
    return F.when(some, F.lit(BAD_NUMBER))


# Names of severities and temporalities, as messages may give them instead of numbers.
SEVERITIES = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL")
TEMPORALITIES = ("UNSPECIFIED", "DELTA", "CUMULATIVE")


def severity_number(raw: Column) -> Column:
    """1 to 24 from a number or a name: four steps for each severity, the first without a digit."""
    name = F.regexp_extract(raw, "^SEVERITY_NUMBER_([A-Z]+)([2-4]?)$", 1)
    step = F.coalesce(F.regexp_extract(raw, "^SEVERITY_NUMBER_([A-Z]+)([2-4]?)$", 2).try_cast("int"), F.lit(1))
    known = F.array_position(F.array(*map(F.lit, SEVERITIES)), name).cast("int")
    named = F.when(known > 0, (known - 1) * 4 + step)
    return F.coalesce(raw.try_cast("int"), named, F.lit(0))


def temporality(raw: Column) -> Column:
    name = F.regexp_extract(raw, "^AGGREGATION_TEMPORALITY_([A-Z]+)$", 1)
    known = F.array_position(F.array(*map(F.lit, TEMPORALITIES)), name).cast("int")
    return F.coalesce(raw.try_cast("int"), F.when(known > 0, known - 1), F.lit(0))


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _id(value: str) -> str:
    return f"if(translate({value}, '0', '') = '', '', lower(coalesce({value}, '')))"


def _ns_sql(value: str) -> str:
    return f"coalesce(try_cast({value} AS BIGINT), 0L)"


def _time_sql(value: str) -> str:
    ns = _ns_sql(value)
    return f"timestamp_micros(({ns} - pmod({ns}, 1000L)) DIV 1000L)"


def span_events(events: str) -> Column:
    return F.expr(f"""transform({events}, e -> struct({_time_sql('e.timeUnixNano')} AS Timestamp,
        {_ns_sql('e.timeUnixNano')} AS TimestampNs, coalesce(e.name, '') AS Name,
        {map_sql('e.attributes')} AS Attributes))""")


def span_links(links: str) -> Column:
    return F.expr(f"""transform({links}, l -> struct({_id('l.traceId')} AS TraceId, {_id('l.spanId')} AS SpanId,
        coalesce(l.traceState, '') AS TraceState, {map_sql('l.attributes')} AS Attributes))""")


def exemplars(items: str) -> Column:
    """Exemplars; a missing id is written as zeros here, unlike everywhere else."""

    def filled(value: str, chars: int) -> str:
        return f"if(coalesce({value}, '') = '', repeat('0', {chars}), lower({value}))"

    return F.expr(f"""transform({items}, e -> struct({map_sql('e.filteredAttributes')} AS FilteredAttributes,
        {_time_sql('e.timeUnixNano')} AS TimeUnix,
        coalesce(try_cast(e.asDouble AS DOUBLE), try_cast(e.asInt AS DOUBLE), 0.0D) AS Value,
        {filled('e.spanId', ids.SPAN_ID_CHARS)} AS SpanId, {filled('e.traceId', ids.TRACE_ID_CHARS)} AS TraceId))""")


def quantile_pairs(items: Column) -> Column:
    return F.transform(
        items,
        lambda q: F.struct(
            _zero(q["quantile"]).alias("Quantile"),
            _zero(q["value"]).alias("Value"),
        ),
    )


def _or_empty(column: Column, kind: DataType) -> Column:
    return F.coalesce(column, F.array().cast(kind))


WHAT, REASON = "what", "reason"
_LINE, _AROUND = "_line", "_around"


def _opened(parts: str) -> str:
    """SQL for the JSON object of some fields without its closing brace, ready for one more field."""
    whole = f"to_json(struct({parts}))"
    return f"transform(array({whole}), j -> if(j = '{{}}', '{{', concat(substring(j, 1, length(j) - 1), ',')))[0]"


def _scopes(messages: DataFrame, top: str, scopes: str, items: str, fault, fields: bool, refusals: bool) -> DataFrame:
    """One row per (resource, scope), with the resource's columns worked out once.

    Both levels come out of one explode, as each explode copies all that is below it. With `refusals` a message that can't be
    read is a row too, with its text; and where a scope holds a record that can't be stored, the message around it comes along.
    """
    pairs = f"transform(r.{scopes}, s -> struct(r.resource AS resource, r.schemaUrl AS schemaUrl, s AS s))"
    readable = F.col(CORRUPT).isNull()
    each = F.expr(f"flatten(transform({top}, r -> coalesce({pairs}, array())))")
    if refusals:
        rows = messages.select(F.col(CORRUPT).alias(_LINE), F.explode_outer(F.when(readable, each)).alias("r"))
    else:
        # No filter: Spark would push it below the parse, and parse for it once more.
        rows = messages.select(F.explode(F.when(readable, each)).alias("r"))
    attrs = "r.resource.attributes"
    columns = [attributes_to_map(attrs).alias("ResourceAttributes"), _blank(F.col("r.schemaUrl")).alias("ResourceSchemaUrl")]
    if fields:
        columns.append(attributes_to_fields(attrs).alias("ResourceFields"))
    if refusals:
        start = f"""concat('{{"{top}":[', {_opened("r.resource AS resource, r.schemaUrl AS schemaUrl")}, '"{scopes}":[',
            {_opened("r.s.scope AS scope, r.s.schemaUrl AS schemaUrl")}, '"{items}":[')"""
        some = F.coalesce(F.exists(F.col(f"r.s.{items}"), lambda x: fault(x).isNotNull()), F.lit(False))
        columns += [F.col(_LINE), F.when(some, F.expr(start)).alias(_AROUND)]
    service = maps.attribute(F.col("ResourceAttributes"), "service.name").alias("ServiceName")
    return rows.select(*columns, F.col("r.s").alias("s")).select("*", service)


def _each_record(scopes: DataFrame, items: str, columns: list, fault, refusals: bool) -> DataFrame:
    """Records of every scope as `x`; with `refusals` also those that can't be stored, with what and why."""
    if not refusals:
        return scopes.select(*columns, F.explode(items).alias("x")).filter(fault(F.col("x")).isNull())
    rows = scopes.select(*columns, _LINE, _AROUND, F.explode_outer(items).alias("x")).filter(F.col("x").isNotNull() | F.col(_LINE).isNotNull())
    reason = F.when(F.col(_LINE).isNotNull(), F.lit(BAD_MESSAGE)).otherwise(fault(F.col("x"))).alias(REASON)
    what = F.coalesce(_LINE, F.when(F.col(REASON).isNotNull(), F.concat(_AROUND, F.to_json("x"), F.lit("]}]}]}")))).alias(WHAT)
    return rows.select("*", reason).select("*", what)


def _marked(selected: list, refusals: bool) -> list:
    return [*selected, F.col(WHAT), F.col(REASON)] if refusals else selected


# ---- signals ----------------------------------------------------------------------------------


def flatten_spans(messages: DataFrame, fields: bool = False, refusals: bool = False) -> DataFrame:
    """Trace messages to the spans table.

    `fields` adds SpanFields, ResourceFields and, event by event, EventFields: the attributes with their types, which the
    document encoders prefer over the string maps. `refusals` adds the records and messages that the table can't take, as rows
    with a `reason` and, in `what`, the record in a message of its own, with its resource and scope, that can be loaded again.
    Their other columns mean nothing. Stored rows have no reason.
    """
    scopes = _scopes(messages, "resourceSpans", "scopeSpans", "spans", _span_fault, fields, refusals)
    extra = ["ResourceFields"] if fields else []
    columns = [
        "ResourceAttributes",
        "ServiceName",
        _blank(F.col("s.scope.name")).alias("ScopeName"),
        _blank(F.col("s.scope.version")).alias("ScopeVersion"),
        *extra,
    ]
    spans = _each_record(scopes, "s.spans", columns, _span_fault, refusals)
    start, end = _ns(F.col("x.startTimeUnixNano")), _ns(F.col("x.endTimeUnixNano"))
    columns = {
        "Timestamp": times.ns_to_timestamp(start),
        "TimestampNs": start,
        "TraceId": ids.normal_id(F.col("x.traceId")),
        "SpanId": ids.normal_id(F.col("x.spanId")),
        "ParentSpanId": ids.normal_id(F.col("x.parentSpanId")),
        "TraceState": _blank(F.col("x.traceState")),
        "SpanName": _blank(F.col("x.name")),
        "SpanKind": names.span_kind_name(F.col("x.kind")),
        "SpanAttributes": attributes_to_map("x.attributes"),
        "Duration": end - start,
        "StatusCode": names.status_code_name(F.col("x.status.code")),
        "StatusMessage": _blank(F.col("x.status.message")),
        "Events": _or_empty(span_events("x.events"), schema.EVENTS),
        "Links": _or_empty(span_links("x.links"), schema.LINKS),
    }
    selected = [columns[c].alias(c) if c in columns else F.col(c) for c in schema.SPANS.names]
    if fields:
        of_events = F.expr(f"coalesce(transform(x.events, e -> {fields_sql('e.attributes')}), CAST(array() AS ARRAY<{FIELDS}>))")
        selected += [attributes_to_fields("x.attributes").alias("SpanFields"), F.col("ResourceFields"), of_events.alias("EventFields")]
    return spans.select(*_marked(selected, refusals))


def flatten_logs(messages: DataFrame, fields: bool = False, refusals: bool = False) -> DataFrame:
    """Log messages to the logs table. A resource without a name gets '', never its neighbour's.

    `fields` adds LogFields, ResourceFields and BodyField, the body with its type; `refusals` is as for spans.
    """
    scopes = _scopes(messages, "resourceLogs", "scopeLogs", "logRecords", _record_fault, fields, refusals)
    extra = ["ResourceFields"] if fields else []
    columns = [
        "ResourceAttributes",
        "ResourceSchemaUrl",
        "ServiceName",
        _blank(F.col("s.schemaUrl")).alias("ScopeSchemaUrl"),
        _blank(F.col("s.scope.name")).alias("ScopeName"),
        _blank(F.col("s.scope.version")).alias("ScopeVersion"),
        attributes_to_map("s.scope.attributes").alias("ScopeAttributes"),
        *extra,
    ]
    records = _each_record(scopes, "s.logRecords", columns, _record_fault, refusals)
    at = _ns(F.col("x.timeUnixNano"))
    columns = {
        "Timestamp": times.ns_to_timestamp(at),
        "TimestampNs": at,
        "TraceId": ids.normal_id(F.col("x.traceId")),
        "SpanId": ids.normal_id(F.col("x.spanId")),
        "TraceFlags": _ns(F.col("x.flags")),
        "SeverityText": _blank(F.col("x.severityText")),
        "SeverityNumber": severity_number(F.col("x.severityNumber")),
        "Body": value_text("x.body"),
        "LogAttributes": attributes_to_map("x.attributes"),
    }
    selected = [columns[c].alias(c) if c in columns else F.col(c) for c in schema.LOGS.names]
    if fields:
        body = F.expr(f"struct({json_sql('x.body')} AS json, {type_sql('x.body')} AS type)")
        selected += [attributes_to_fields("x.attributes").alias("LogFields"), F.col("ResourceFields"), body.alias("BodyField")]
    return records.select(*_marked(selected, refusals))


KIND = "kind"


def _raw_points(kind: str) -> str:
    """SQL for the points of one kind as an array of points of any kind; empty where the metric is of another."""
    field = METRIC_FIELDS[kind]
    fields = [f"p.{n} AS {n}" if n in _POINT_FIELDS[kind] else f"CAST(NULL AS {t}) AS {n}" for n, t in _RAW_POINT.items()]
    fields += [f"m.{field}.aggregationTemporality AS aggregationTemporality", f"m.{field}.isMonotonic AS isMonotonic"]
    points = f"transform(m.{field}.dataPoints, p -> struct('{kind}' AS {KIND}, {', '.join(fields)}))"
    return f"coalesce({points}, array())"


def _counts(raw: Column) -> Column:
    return F.coalesce(F.transform(raw, _ns), F.array().cast("array<bigint>"))


def _zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def _int(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


_UNTYPED = "_untyped"


def _point_alone() -> str:
    """SQL for a metric of one point, as JSON."""
    point = f"to_json(struct({', '.join(f'p.{name}' for name in _RAW_POINT)}))"
    field = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in METRIC_FIELDS.items())
    shell = _opened("MetricName AS name, MetricDescription AS description, MetricUnit AS unit")
    inside = _opened("p.aggregationTemporality AS aggregationTemporality, p.isMonotonic AS isMonotonic")
    return f"""concat({shell}, '"', CASE p.{KIND} {field} END, '":', {inside}, '"dataPoints":[', {point}, ']}}}}')"""


def flatten_metrics(messages: DataFrame, kinds: tuple[str, ...] = schema.METRIC_KINDS, refusals: bool = False) -> DataFrame:
    """Metric messages to data points of all kinds in one pass, one row per point.

    `kind` names the table a point belongs to. There is a column for every column of the five
    tables; those that a point's own table lacks mean nothing in its row. `refusals` is as for spans; the rows it adds, among
    them metrics of no known type, are of no kind.
    """
    shared = ["ResourceAttributes", "ResourceSchemaUrl", "ScopeName", "ScopeVersion", "ScopeAttributes",
              "ScopeDroppedAttrCount", "ScopeSchemaUrl"]
    scopes = _scopes(messages, "resourceMetrics", "scopeMetrics", "metrics", _metric_fault, False, refusals)
    around = [_LINE, _AROUND] if refusals else []
    outer = F.explode_outer if refusals else F.explode
    metrics = scopes.select(
        "ResourceAttributes",
        "ResourceSchemaUrl",
        _blank(F.col("s.scope.name")).alias("ScopeName"),
        _blank(F.col("s.scope.version")).alias("ScopeVersion"),
        attributes_to_map("s.scope.attributes").alias("ScopeAttributes"),
        _ns(F.col("s.scope.droppedAttributesCount")).alias("ScopeDroppedAttrCount"),
        _blank(F.col("s.schemaUrl")).alias("ScopeSchemaUrl"),
        *around,
        outer("s.metrics").alias("m"),
    )
    if refusals:
        metrics = metrics.filter(F.col("m").isNotNull() | F.col(_LINE).isNotNull())
        around += [F.when(F.col("m").isNotNull() & _untyped(F.col("m")), F.to_json("m")).alias(_UNTYPED)]
    points = metrics.select(
        *shared,
        _blank(F.col("m.name")).alias("MetricName"),
        _blank(F.col("m.description")).alias("MetricDescription"),
        _blank(F.col("m.unit")).alias("MetricUnit"),
        *around,
        outer(F.expr(f"concat({', '.join(map(_raw_points, kinds))})")).alias("p"),
    )
    fault = F.coalesce(_point_fault(F.col("p")), F.when(~_typed("boolean", F.col("p.isMonotonic")), F.lit(BAD_TYPE)))
    if refusals:
        points = points.filter(F.col("p").isNotNull() | F.col(_LINE).isNotNull() | F.col(_UNTYPED).isNotNull())
        reason = F.when(F.col(_LINE).isNotNull(), F.lit(BAD_MESSAGE)).when(F.col(_UNTYPED).isNotNull(), F.lit(BAD_KIND)).otherwise(fault)
        points = points.select("*", reason.alias(REASON))
        alone = F.coalesce(_UNTYPED, F.when(F.col(REASON).isNotNull(), F.expr(_point_alone())))
        points = points.select("*", F.coalesce(_LINE, F.concat(_AROUND, alone, F.lit("]}]}]}"))).alias(WHAT))
    else:
        points = points.filter(fault.isNull())
    point = F.col("p")
    start, at = _ns(point["startTimeUnixNano"]), _ns(point["timeUnixNano"])
    columns = {
        "Attributes": attributes_to_map("p.attributes"),
        "StartTimeUnix": times.ns_to_timestamp(start),
        "StartTimeUnixNs": start,
        "TimeUnix": times.ns_to_timestamp(at),
        "TimeUnixNs": at,
        "Flags": _ns(point["flags"]),
        "Value": text.number_value(point["asInt"], point["asDouble"].try_cast("double")),
        "Exemplars": _or_empty(exemplars("p.exemplars"), schema.EXEMPLARS),
        "AggTemp": temporality(point["aggregationTemporality"]),
        "IsMonotonic": F.coalesce(point["isMonotonic"].try_cast("boolean"), F.lit(False)),
        "Count": _ns(point["count"]),
        "Sum": _zero(point["sum"]),
        "Min": _zero(point["min"]),
        "Max": _zero(point["max"]),
        "BucketCounts": _counts(point["bucketCounts"]),
        "ExplicitBounds": F.coalesce(F.transform(point["explicitBounds"], lambda b: b.try_cast("double")), F.array().cast("array<double>")),
        "Scale": _int(point["scale"]),
        "ZeroCount": _ns(point["zeroCount"]),
        "PositiveOffset": _int(point["positive"]["offset"]),
        "PositiveBucketCounts": _counts(point["positive"]["bucketCounts"]),
        "NegativeOffset": _int(point["negative"]["offset"]),
        "NegativeBucketCounts": _counts(point["negative"]["bucketCounts"]),
        "ValueAtQuantiles": _or_empty(quantile_pairs(point["quantileValues"]), schema.QUANTILES),
    }
    wanted = dict.fromkeys(name for kind in kinds for name in schema.METRICS[kind].names)
    kind = F.when(F.col(REASON).isNull(), point[KIND]) if refusals else point[KIND]
    return points.select(*_marked([kind.alias(KIND), *[columns[c].alias(c) if c in columns else F.col(c) for c in wanted]], refusals))


def flatten_metric(messages: DataFrame, kind: str) -> DataFrame:
    """Metric messages to the table of one kind, one row per data point."""
    return flatten_metrics(messages, (kind,)).select(*schema.METRICS[kind].names)


def split_metrics(messages: DataFrame) -> dict[str, DataFrame]:
    """All five metric tables by kind. A metric of no known kind is in none: see untyped_metrics.

    To write all five use flatten_metrics and write_metric_points, which parse messages once.
    """
    return {kind: flatten_metric(messages, kind) for kind in schema.METRIC_KINDS}


def rejected(messages: DataFrame, signal: str) -> DataFrame:
    """What of parsed messages no table takes: (what, reason).

    A message that can't be read, as it came; a record with a time or count out of range or a field of the wrong type, or a metric
    of no known type, in a message of its own. All other records of a message are stored.
    """
    return judged(messages, signal).filter(F.col(REASON).isNotNull()).select(WHAT, REASON)


def judged(messages: DataFrame, signal: str) -> DataFrame:
    """Rows of a signal's table and of what it can't take, out of one parse."""
    if signal == "traces":
        return flatten_spans(messages, refusals=True)
    return flatten_logs(messages, refusals=True) if signal == "logs" else flatten_metrics(messages, refusals=True)


def untyped_metrics(messages: DataFrame) -> DataFrame:
    """Metrics whose type is unset or unsupported, with the reason, for quarantine."""
    bad = flatten_metrics(messages, refusals=True).filter(F.col(REASON) == BAD_KIND)
    return bad.select("ResourceAttributes", "ScopeName", "MetricName", REASON)


def out_of_range_times(messages: DataFrame) -> DataFrame:
    """Spans with a time that can't be stored, with the reason."""
    return flatten_spans(messages, refusals=True).filter(F.col(REASON) == BAD_NUMBER).select("TraceId", "SpanId", REASON)


def corrupt_messages(messages: DataFrame) -> DataFrame:
    """Lines that were no JSON of the expected form, with the reason."""
    return messages.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("message"), F.lit(BAD_MESSAGE).alias(REASON))
