"""Documents: encoding, the field model, and reading back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.ingest import _flat_spans
from checks.registry import query
from checks.views import duck
from telesift.operators import documents as docs
from telesift.operators.catalog import route_by_index
from telesift.schema import SPANS
from telesift.session import scratch_path
from telesift.sources import tables
from telesift.sources.documents import documents_to_spans

NS_TEXT = """strftime(make_timestamp({ns} // 1000), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST({ns} % 1000000000 AS VARCHAR), 9, '0') || 'Z'"""
START_TEXT = NS_TEXT.format(ns="TimestampNs")
END_TEXT = NS_TEXT.format(ns="(TimestampNs + Duration)")
BLANK = "nullif({}, '')"


def _field(document: str, key: str, name: str):
    return F.get_json_object(document, f"$['{key}']").alias(name)


@query("encode_span_documents", duck("spans_v", f"""SELECT SpanId, {START_TEXT} AS start_text, {END_TEXT} AS end_text,
  {BLANK.format('TraceId')} AS trace_id, {BLANK.format('ParentSpanId')} AS parent_id, SpanName AS name, SpanKind AS kind,
  CASE StatusCode WHEN 'STATUS_CODE_OK' THEN '1' WHEN 'STATUS_CODE_ERROR' THEN '2' ELSE '0' END AS status, k, user_text AS user_id,
  nullif(ServiceName, '') AS service, host,
  CASE WHEN event_type = 'error' THEN 'E' || (event_id % 3) END AS exception,
  CASE WHEN event_type = 'purchase' THEN {NS_TEXT.format(ns='(TimestampNs + 2000)')} END AS paid,
  CASE WHEN event_id % 10 = 3 THEN '[{{"attribute":{{"why":"follows"}},"spanID":"' || substr(md5(CAST(event_id + 1 AS VARCHAR)), 1, 16)
    || '","traceID":"' || md5('t' || (trace_no + 3)) || '"}}]' ELSE '[]' END AS link FROM spans_v"""))
def _(v):
    encoded = docs.encode_span_documents(v.spans)
    return encoded.select(
        "SpanId", _field("document", "@timestamp", "start_text"), _field("document", "EndTimestamp", "end_text"),
        _field("document", "TraceId", "trace_id"), _field("document", "ParentSpanId", "parent_id"),
        _field("document", "Name", "name"), _field("document", "Kind", "kind"), _field("document", "TraceStatus", "status"),
        _field("document", "Attributes.k", "k"), _field("document", "Attributes.user.id", "user_id"),
        _field("document", "Resource.service.name", "service"), _field("document", "Resource.host.name", "host"),
        _field("document", "Events.exception.exception.type", "exception"), _field("document", "Events.pay.time", "paid"),
        _field("document", "Link", "link"),
    )


@query("encode_span_documents_nested", duck("spans_v", f"""SELECT SpanId, k, user_text AS user_id, nullif(ServiceName, '') AS service, host,
  CASE WHEN event_type = 'error' THEN 'E' || (event_id % 3) END AS exception, {START_TEXT} AS start_text FROM spans_v"""))
def _(v):
    encoded = docs.encode_span_documents(v.spans, dedot=True)
    return encoded.select(
        "SpanId", F.get_json_object("document", "$.Attributes.k").alias("k"),
        F.get_json_object("document", "$.Attributes.user.id").alias("user_id"),
        F.get_json_object("document", "$.Resource.service.name").alias("service"),
        F.get_json_object("document", "$.Resource.host.name").alias("host"),
        F.get_json_object("document", "$.Events.exception.exception.type").alias("exception"),
        _field("document", "@timestamp", "start_text"),
    )


@query("encode_span_documents_typed", duck("spans_v", r"""SELECT SpanId, k, regexp_replace(CAST(value AS VARCHAR), '\.0$', '') AS value,
  CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS even, '[' || k || ',"x"]' AS list, 'x' AS deep_a, k AS deep_bc FROM spans_v"""))
def _(v):
    encoded = docs.encode_span_documents(_flat_spans(v, fields=True))
    number = F.regexp_replace(_field("document", "Attributes.value", "v"), r"\.0$", "")
    return encoded.select(
        "SpanId", _field("document", "Attributes.k", "k"), number.alias("value"), _field("document", "Attributes.even", "even"),
        _field("document", "Attributes.list", "list"), _field("document", "Attributes.deep.a", "deep_a"),
        _field("document", "Attributes.deep.b.c", "deep_bc"),
    )


@query("encode_log_documents", duck("logs_v", f"""SELECT {START_TEXT} AS start_text, {BLANK.format('TraceId')} AS trace_id, SpanId AS span_id,
  '1' AS flags, SeverityText AS severity, CAST(SeverityNumber AS VARCHAR) AS number, Body AS body, k, event_type AS event,
  nullif(ServiceName, '') AS service FROM logs_v"""))
def _(v):
    encoded = docs.encode_log_documents(v.logs)
    return encoded.select(
        _field("document", "@timestamp", "start_text"), _field("document", "TraceId", "trace_id"),
        _field("document", "SpanId", "span_id"), _field("document", "TraceFlags", "flags"),
        _field("document", "SeverityText", "severity"), _field("document", "SeverityNumber", "number"),
        _field("document", "Body", "body"), _field("document", "Attributes.k", "k"),
        _field("document", "Attributes.event", "event"), _field("document", "Resource.service.name", "service"),
    )


@query("encode_jaeger_documents", duck("spans_v", """SELECT SpanId AS span_id, TraceId AS trace_id, nullif(ParentSpanId, '') AS parent_id,
  SpanName AS operation, CAST(TimestampNs // 1000 AS VARCHAR) AS start_us, CAST(TimestampNs // 1000000 AS VARCHAR) AS start_ms,
  CAST(Duration // 1000 AS VARCHAR) AS duration_us, CASE WHEN ServiceName = '' THEN 'OTLPResourceNoServiceName' ELSE ServiceName END AS service,
  ((ParentSpanId <> '')::BIGINT + (event_id % 10 = 3)::BIGINT) AS refs,
  CASE event_type WHEN 'error' THEN 1::BIGINT WHEN 'purchase' THEN 2 ELSE 0 END AS logs,
  (4 + (SpanKind <> 'SPAN_KIND_UNSPECIFIED')::BIGINT + CASE StatusCode WHEN 'STATUS_CODE_ERROR' THEN 3 WHEN 'STATUS_CODE_OK' THEN 1 ELSE 0 END)::BIGINT AS tags
  FROM spans_v"""))
def _(v):
    encoded = docs.encode_jaeger_documents(v.dealt_spans.select(*SPANS.names))

    def at(path: str, name: str):
        return F.get_json_object("document", f"$.{path}").alias(name)

    def size(path: str, name: str):
        return F.coalesce(F.json_array_length(F.get_json_object("document", f"$.{path}")), F.lit(0)).cast("bigint").alias(name)

    return encoded.select(
        at("spanID", "span_id"), at("traceID", "trace_id"), at("parentSpanID", "parent_id"), at("operationName", "operation"),
        at("startTime", "start_us"), at("startTimeMillis", "start_ms"), at("duration", "duration_us"),
        at("process.serviceName", "service"), size("references", "refs"), size("logs", "logs"), size("tags", "tags"),
    )


@query("write_documents", duck("spans_v", """SELECT CASE WHEN event_type = 'error' THEN 'errors-spans' ELSE 'spans' END AS index_name,
  count(*) AS documents FROM spans_v GROUP BY 1"""))
def _(v):
    prefix = F.when(F.col("StatusCode") == "STATUS_CODE_ERROR", F.expr("map('elasticsearch.index.prefix', 'errors-')"))
    marked = v.spans.withColumn("ResourceAttributes", F.map_concat("ResourceAttributes", F.coalesce(prefix, F.expr("CAST(map() AS MAP<STRING,STRING>)"))))
    routed = route_by_index(docs.encode_span_documents(marked), "spans").select("index_name", "document")
    path = scratch_path(v.spark, "documents")
    tables.write_documents(routed, path)
    return tables.read_table(v.spark, path).groupBy("index_name").agg(F.count("*").alias("documents"))


@query("documents_to_spans", duck("spans_v", """SELECT TraceId, SpanId, ParentSpanId, SpanName, SpanKind, ServiceName, TimestampNs, Duration,
  StatusCode, k, user_text AS user_id, host FROM spans_v"""))
def _(v):
    back = documents_to_spans(docs.encode_span_documents(v.spans))
    return back.select(
        "TraceId", "SpanId", "ParentSpanId", "SpanName", "SpanKind", "ServiceName", "TimestampNs", "Duration", "StatusCode",
        F.col("SpanAttributes")["k"].alias("k"), F.col("SpanAttributes")["user.id"].alias("user_id"),
        F.col("ResourceAttributes")["host.name"].alias("host"),
    )


# ---- the field model --------------------------------------------------------------------------


def _fields_text(column: str):
    return F.array_join(F.transform(column, lambda f: F.concat(f["key"], F.lit("="), f["json"])), " ")


@query("flatten_attributes", duck("spans_v", """SELECT SpanId, 'Attributes.k' AS key, '"' || k || '"' AS json FROM spans_v WHERE k IS NOT NULL
  UNION ALL SELECT SpanId, 'Attributes.user.id', '"' || user_text || '"' FROM spans_v"""))
def _(v):
    fields = docs.flatten_attributes("Attributes", F.col("SpanAttributes"))
    return v.spans.select("SpanId", F.explode(fields).alias("f")).select("SpanId", "f.key", "f.json")


@query("flatten_nested", duck("spans_v", """SELECT SpanId, 'p.a.k' AS key, k AS json FROM spans_v WHERE k IS NOT NULL
  UNION ALL SELECT SpanId, 'p.a.b.user', '"' || user_text || '"' FROM spans_v
  UNION ALL SELECT SpanId, 'p.list', '[' || event_id || ',{"x":{"y":1}}]' FROM spans_v"""))
def _(v):
    nested = F.expr("""concat('{"a":{"k":', k, ',"b":{"user":"', user_text, '"},"none":null},"list":[', event_id, ',{"x.y":1}],"empty":{}}')""")
    spans = v.wide_spans.withColumn("f", F.explode(docs.flatten_nested("p", nested)))
    return spans.select("SpanId", "f.key", "f.json")


# Fields with a key twice, out of order, and with a key that is also the parent of others.
MIXED = """transform(array(
  array('z', concat(event_id, '')), array('a', '1'), array('a', k), array('n', '"lifted"'), array('n.x', '2'),
  array('m', '"gone"'), array('m.value', '3'), array('m-n', '4'), array('q', '5'), array('q-r', '6'), array('q.s', '7')),
  p -> struct(p[0] AS key, p[1] AS json))"""


@query("dedup_fields", duck("spans_v", """SELECT SpanId,
  'a=' || k || ' m-n=4 m.value=3 n.value="lifted" n.x=2 q-r=6 q.s=7 q.value=5 z=' || event_id AS fields FROM spans_v"""))
def _(v):
    deduplicated = docs.with_deduplicated(v.wide_spans.withColumn("f", F.expr(MIXED)), "f")
    return deduplicated.select("SpanId", _fields_text("f").alias("fields"))


@query("sort_fields", duck("spans_v", """SELECT SpanId,
  'a=1 a=' || k || ' m="gone" m-n=4 m.value=3 n="lifted" n.x=2 q=5 q-r=6 q.s=7 z=' || event_id AS fields FROM spans_v"""))
def _(v):
    ordered = v.wide_spans.withColumn("f", docs.sort_fields(F.expr(MIXED)))
    return ordered.select("SpanId", _fields_text("f").alias("fields"))


@query("flat_json", duck("spans_v", """SELECT SpanId, '{"a.b":"he said \\"hi\\"","n":null,"i":' || event_id || '}' AS document FROM spans_v"""))
def _(v):
    fields = F.expr(r"""transform(array(array('a.b', r'"he said \"hi\""'), array('none', NULL), array('list', '[]'),
      array('object', '{}'), array('n', 'null'), array('i', CAST(event_id AS STRING))), p -> struct(p[0] AS key, p[1] AS json))""")
    return v.wide_spans.select("SpanId", docs.flat_json(fields).alias("document"))


@query("nested_json", duck("spans_v", """SELECT SpanId,
  '{"net":{"peer":{"port":' || k || '},"up":true},"span":{"no":' || event_id || ',"tag":"t' || (event_id % 5) || '"},"v":[1,2]}' AS document FROM spans_v"""))
def _(v):
    fields = F.expr("""transform(array(array('net.peer.port', k), array('net.up', 'true'), array('span.no', CAST(event_id AS STRING)),
      array('span.none', NULL), array('span.tag', concat('"t', event_id % 5, '"')), array('v', '[1,2]')), p -> struct(p[0] AS key, p[1] AS json))""")
    built = docs.with_nested_json(v.wide_spans.withColumn("f", fields), "f", "document")
    return built.select("SpanId", "document")


@query("event_fields", duck("spans_v", f"""
  SELECT SpanId, 'Events.exception.time' AS key, '"' || {NS_TEXT.format(ns='(TimestampNs + 1000)')} || '"' AS json FROM spans_v WHERE event_type = 'error'
  UNION ALL SELECT SpanId, 'Events.exception.exception.type', '"E' || (event_id % 3) || '"' FROM spans_v WHERE event_type = 'error'
  UNION ALL SELECT SpanId, 'Events.cart.time', '"' || {START_TEXT} || '"' FROM spans_v WHERE event_type = 'purchase'
  UNION ALL SELECT SpanId, 'Events.pay.time', '"' || {NS_TEXT.format(ns='(TimestampNs + 2000)')} || '"' FROM spans_v WHERE event_type = 'purchase'
  UNION ALL SELECT SpanId, 'Events.pay.amount', '"' || (Duration // 10000) || '"' FROM spans_v WHERE event_type = 'purchase'"""))
def _(v):
    fields = v.spans.select("SpanId", F.explode(docs.event_fields(F.col("Events"))).alias("f"))
    return fields.select("SpanId", "f.key", "f.json")


@query("links_text", duck("spans_v", """SELECT SpanId, CASE WHEN event_id % 10 = 3 THEN '[{"attribute":{"why":"follows"},"spanID":"'
  || substr(md5(CAST(event_id + 1 AS VARCHAR)), 1, 16) || '","traceID":"' || md5('t' || (trace_no + 3)) || '"}]' ELSE '[]' END AS link FROM spans_v"""))
def _(v):
    return v.spans.select("SpanId", docs.links_text(F.col("Links")).alias("link"))


@query("document_values", duck("spans_v", """SELECT SpanId,
  CASE WHEN event_id % 3 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END AS number,
  CASE WHEN TraceId <> '' THEN '"' || TraceId || '"' END AS text FROM spans_v"""))
def _(v):
    number = F.expr("CASE event_id % 3 WHEN 0 THEN if(event_id % 2 = 0, double('NaN'), double('-Infinity')) ELSE value END")
    return v.wide_spans.select(
        "SpanId", docs.number_value(number).alias("number"), docs.string_value(F.col("TraceId")).alias("text")
    )
