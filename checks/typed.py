"""Values with their types: bodies, tags, VARIANT, and what is refused for a wrong one."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import duck
from telesift.operators import documents as docs
from telesift.sources import otlp, values

# One message a span event, as text: every kind of body by turns, attributes of every type, a value five levels deep.
_BODY = """CASE event_id % 6 WHEN 0 THEN '{"stringValue":"plain \\\\"text\\\\""}' WHEN 1 THEN concat('{"intValue":"', event_id, '"}')
  WHEN 2 THEN concat('{"kvlistValue":{"values":[{"key":"n","value":{"intValue":', event_id, '}},{"value":{"kvlistValue":{"values":[{"key":"b","value":{"kvlistValue":{"values":[{"key":"c","value":{"kvlistValue":{"values":[{"key":"d","value":{"arrayValue":{"values":[{"boolValue":true},{"doubleValue":2.0}]}}}]}}}]}}}]}},"key":"a"}]}}')
  WHEN 3 THEN '{"boolValue":true}' WHEN 4 THEN '{"doubleValue":0.25}' ELSE '{}' END"""
_ATTRIBUTES = """concat('[{"key":"n","value":{"intValue":"', event_id, '"}},{"key":"even","value":{"boolValue":', event_id % 2 = 0, '}},',
  '{"key":"half","value":{"doubleValue":', event_id, '.5}},{"key":"raw","value":{"bytesValue":"/wA="}},',
  '{"key":"many","value":{"arrayValue":{"values":[{"intValue":1},{"arrayValue":{"values":[{"arrayValue":{"values":[{"arrayValue":{"values":[{"stringValue":"x"}]}}]}}]}}]}}}]')"""


def _messages(v, top: str, scopes: str, items: str, record: str, signal: str):
    text = f"""concat('{{"{top}":[{{"{scopes}":[{{"{items}":[', {record}, ']}}]}}]}}')"""
    return otlp.parse_otlp_json(v.dealt_spans.selectExpr(f"{text} AS value"), "value", signal)


def _records(v):
    record = f"""'{{"spanId":"', SpanId, '","timeUnixNano":"', TimestampNs, '","body":', {_BODY}, ',"attributes":', {_ATTRIBUTES}, '}}'"""
    return _messages(v, "resourceLogs", "scopeLogs", "logRecords", record, "logs")


def _spans(v):
    record = f"""'{{"spanId":"', SpanId, '","startTimeUnixNano":"', TimestampNs, '","attributes":', {_ATTRIBUTES}, '}}'"""
    return _messages(v, "resourceSpans", "scopeSpans", "spans", record, "traces")


@query("encode_log_documents_typed", duck("spans_v", """SELECT SpanId AS span_id,
  CASE event_id % 6 WHEN 0 THEN 'plain "text"' WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 3 THEN 'true' WHEN 4 THEN '0.25' END AS body,
  CASE WHEN event_id % 6 = 2 THEN CAST(event_id AS VARCHAR) END AS body_n, CASE WHEN event_id % 6 = 2 THEN '[true,2]' END AS body_deep,
  CASE WHEN event_id % 6 = 2 THEN '[true,2]' END AS nested_deep,
  CAST(event_id AS VARCHAR) AS n, '[1,[[["x"]]]]' AS many FROM spans_v"""))
def _(v):
    logs = otlp.flatten_logs(_records(v), fields=True)
    flat = docs.encode_log_documents(logs).withColumnRenamed("document", "flat")
    both = docs.encode_log_documents(flat, dedot=True)
    at = lambda column, path, name: F.get_json_object(column, path).alias(name)
    return both.select(
        F.col("SpanId").alias("span_id"), at("flat", "$.Body", "body"), at("flat", "$['Body.n']", "body_n"), at("flat", "$['Body.a.b.c.d']", "body_deep"),
        at("document", "$.Body.a.b.c.d", "nested_deep"), at("flat", "$['Attributes.n']", "n"), at("flat", "$['Attributes.many']", "many"),
    )


@query("flatten_logs_deep", duck("spans_v", """SELECT SpanId, CASE event_id % 6 WHEN 0 THEN 'plain "text"' WHEN 1 THEN CAST(event_id AS VARCHAR)
  WHEN 2 THEN '{"a":{"b":{"c":{"d":[true,2]}}},"n":' || event_id || '}' WHEN 3 THEN 'true' WHEN 4 THEN '0.25' ELSE '' END AS body,
  '[1,[[["x"]]]]' AS many, event_id || '.5' AS half FROM spans_v"""))
def _(v):
    logs = otlp.flatten_logs(_records(v))
    return logs.select("SpanId", F.col("Body").alias("body"), F.col("LogAttributes")["many"].alias("many"), F.col("LogAttributes")["half"].alias("half"))


@query("encode_jaeger_documents_typed", duck("spans_v", """SELECT SpanId AS span_id, t.key, t.type, t.value FROM spans_v, unnest([
  {'key': 'n', 'type': 'int64', 'value': CAST(event_id AS VARCHAR)}, {'key': 'even', 'type': 'bool', 'value': CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END},
  {'key': 'half', 'type': 'float64', 'value': event_id || '.5'}, {'key': 'raw', 'type': 'binary', 'value': 'ff00'},
  {'key': 'many', 'type': 'string', 'value': '[1,[[["x"]]]]'}]) AS u(t)"""))
def _(v):
    encoded = docs.encode_jaeger_documents(otlp.flatten_spans(_spans(v), fields=True))
    tags = F.from_json(F.get_json_object("document", "$.tags"), "array<struct<key:string,type:string,value:string>>")
    return encoded.select(F.col("SpanId").alias("span_id"), F.explode(tags).alias("t")).select("span_id", "t.key", "t.type", "t.value")


@query("typed_attributes", duck("spans_v", """SELECT SpanId, event_id AS n, CAST(event_id + 0.5 AS DOUBLE) AS half, event_id % 2 = 0 AS even, 'x' AS deep
  FROM spans_v WHERE event_id + 0.5 > 300"""))
def _(v):
    typed = otlp.flatten_spans(_spans(v), fields=True).select("SpanId", values.fields_to_variant("SpanFields").alias("v"))
    return typed.filter("variant_get(v, '$.half', 'double') > 300").selectExpr(
        "SpanId", "variant_get(v, '$.n', 'bigint') AS n", "variant_get(v, '$.half', 'double') AS half", "variant_get(v, '$.even', 'boolean') AS even",
        "variant_get(v, '$.many[1][0][0][0]', 'string') AS deep",
    )


_TYPES_SQL = """SELECT t.key, t.type, count(*) AS spans FROM spans_v, unnest([{'key': 'n', 'type': 'BIGINT'}, {'key': 'even', 'type': 'BOOLEAN'},
  {'key': 'half', 'type': 'DECIMAL'}, {'key': 'raw', 'type': 'STRING'}, {'key': 'many', 'type': 'ARRAY<VARIANT>'}]) AS u(t) GROUP BY ALL"""


@query("attribute_types", duck("spans_v", _TYPES_SQL))
def _(v):
    """Which types an attribute has, and in how many spans."""
    typed = otlp.flatten_spans(_spans(v), fields=True).select(F.explode(F.col("SpanFields")).alias("f"))
    kind = F.regexp_replace(F.schema_of_variant(F.try_parse_json("f.json")), r"\(.*\)", "")
    return typed.select("f.key", kind.alias("type")).groupBy("key", "type").agg(F.count("*").alias("spans"))


# Every fifth record's flags are no number, every seventh's time is out of range; flags may also be given as text.
_WENT = """CASE WHEN event_id % 7 = 0 THEN 'a time or count is no whole number of 0 to 2^63 - 1'
  WHEN event_id % 5 = 0 THEN 'a field is not of its type' ELSE 'stored' END"""


@query("quarantine_wrong_types", duck("spans_v", f"""SELECT {_WENT} AS went, CASE WHEN {_WENT} = 'stored' THEN NULL ELSE 'host-' || event_id % 3 END AS host,
  count(*) AS records, count(DISTINCT SpanId) AS ids FROM spans_v GROUP BY ALL"""))
def _(v):
    """Stored and refused make up all that was given, and what is refused knows its resource."""
    text = """concat('{"resourceLogs":[{"resource":{"attributes":[{"key":"host","value":{"stringValue":"host-', event_id % 3, '"}}]},"scopeLogs":[{"logRecords":[{"spanId":"', SpanId,
      '","timeUnixNano":"', if(event_id % 7 = 0, '-1', TimestampNs), '","flags":', CASE WHEN event_id % 5 = 0 THEN '"many"' WHEN event_id % 2 = 0 THEN '"3"' ELSE '3' END, '}]}]}]}')"""
    parsed = otlp.parse_otlp_json(v.wide_spans.selectExpr(f"{text} AS value"), "value", "logs")
    stored = otlp.flatten_logs(parsed).filter("TraceFlags = 3").select(F.lit("stored").alias("went"), F.lit(None).cast("string").alias("host"), "SpanId")
    again = otlp.rejected(parsed, "logs")
    first = "$.resourceLogs[0]"
    refused = again.select(
        F.col("reason").alias("went"), F.get_json_object("what", f"{first}.resource.attributes[0].value.stringValue").alias("host"),
        F.get_json_object("what", f"{first}.scopeLogs[0].logRecords[0].spanId").alias("SpanId"),
    )
    return stored.unionAll(refused).groupBy("went", "host").agg(F.count("*").alias("records"), F.countDistinct("SpanId").alias("ids"))
