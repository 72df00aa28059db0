"""OTLP JSON to tables, quarantine, tables on disk."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from telesift import schema
from telesift.functions import maps
from telesift.operators import catalog, spans as span_ops
from telesift.sources import otlp, tables, values
from tests.helpers import any_value, attrs, messages_of, spans_of, trace_message

BASE = 1_944_772_869_250_000_000


def test_span_columns(spark):
    message = trace_message(
        [{
            "traceId": "A1B2C3D4" * 4, "spanId": "FeedBeef" * 2, "parentSpanId": "0" * 16,
            "name": "plot course", "kind": 3, "startTimeUnixNano": str(BASE), "endTimeUnixNano": str(BASE + 77), "attributes": attrs(n=1, ok=True),
            "events": [{"timeUnixNano": str(BASE + 5), "name": "tacked", "attributes": attrs(side="port")}, {"name": "moored"}],
            "links": [{"traceId": "0A", "spanId": "0b", "traceState": "s", "attributes": attrs(l="w")}, {}],
            "status": {"code": 2, "message": "ran aground"},
        }],
        attrs(service_name="svc", host="h"), {"name": "scope", "version": "1"},
    )
    df = otlp.flatten_spans(messages_of(spark, [message], "traces"))
    assert df.schema.names == schema.SPANS.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schema.SPANS]
    row = df.first()
    assert row.TimestampNs == BASE and row.Timestamp.microsecond == 250_000 and row.Duration == 77
    assert (row.TraceId, row.SpanId, row.ParentSpanId) == ("a1b2c3d4" * 4, "feedbeef" * 2, "")
    assert (row.SpanKind, row.StatusCode, row.StatusMessage) == ("SPAN_KIND_CLIENT", "STATUS_CODE_ERROR", "ran aground")
    assert row.ServiceName == "svc" and row.ResourceAttributes == {"service.name": "svc", "host": "h"}
    assert row.SpanAttributes == {"n": "1", "ok": "true"} and (row.ScopeName, row.ScopeVersion) == ("scope", "1")
    assert [(e.Name, e.TimestampNs, e.Attributes) for e in row.Events] == [("tacked", BASE + 5, {"side": "port"}), ("moored", 0, {})]
    assert [(l.TraceId, l.SpanId, l.TraceState, l.Attributes) for l in row.Links] == [("0a", "0b", "s", {"l": "w"}), ("", "", "", {})]


def test_missing_pieces(spark):
    """No resource, an empty resource, an empty scope, and defaults of a bare span."""
    messages = [trace_message([{}]), {"resourceSpans": [{}]}, {"resourceSpans": [{"scopeSpans": [{}]}]}, {}]
    rows = otlp.flatten_spans(messages_of(spark, messages, "traces")).collect()
    assert len(rows) == 1
    assert rows[0].ServiceName == "" and rows[0].ResourceAttributes == {} and rows[0].Events == [] and rows[0].Links == []
    assert rows[0].SpanKind == "SPAN_KIND_UNSPECIFIED" and rows[0].StatusCode == "STATUS_CODE_UNSET" and rows[0].TimestampNs == 0


def test_attribute_values(spark):
    kvs = attrs(
        depth=-3, open=False, ratio=2.0, half=0.5, blank="", nothing=None, many=["s", -1, False, 2.0, None, ["t"]],
        tree={"z": 1, "m": {"q": 'a"b', "e": []}},
    ) + [{"key": "depth", "value": {"stringValue": "again"}}, {"key": "raw", "value": {"bytesValue": "/wA="}}]
    row = otlp.flatten_spans(messages_of(spark, [trace_message([{"attributes": kvs}])], "traces")).first()
    assert row.SpanAttributes == {
        "depth": "again", "open": "false", "ratio": "2", "half": "0.5", "blank": "", "nothing": "",
        "many": '["s",-1,false,2,null,["t"]]', "tree": '{"m":{"e":[],"q":"a\\"b"},"z":1}', "raw": "/wA=",
    }


def test_values_of_any_depth(spark):
    """What lies below the levels that expressions decode reads as what lies above them."""
    leaves = ["d", -1, True, None, 2.0, 0.25, 1e-7, -1.5e22, 1e21, "q\"\n\x1f\\u00e9 é", [], {}, {"b": 1, "a": [[{"z": "end"}]]}]
    shallow = otlp.flatten_spans(messages_of(spark, [trace_message([{"attributes": attrs(v=[leaves[:-1]])}])], "traces")).first().SpanAttributes["v"]
    inner = shallow[1:-2] + ',{"a":[[{"z":"end"}]],"b":1}]'
    deep, far = leaves, "x"
    for _ in range(4):
        deep = [deep]
    for _ in range(40):
        far = {"k": [far]}
    row = otlp.flatten_spans(messages_of(spark, [trace_message([{"attributes": attrs(deep=deep, map={"k": [{"k": [deep]}]}, far=far, near=["é"])}])], "traces")).first()
    assert row.SpanAttributes == {
        "deep": "[" * 4 + inner + "]" * 4, "map": '{"k":[{"k":[' + "[" * 4 + inner + "]" * 4 + "]}]}",
        "far": '{"k":[' * 40 + '"x"' + "]}" * 40, "near": '["é"]',
    }
    logs = {"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": any_value([[[["Below the third level"]]]])}]}]}]}
    assert otlp.flatten_logs(messages_of(spark, [logs], "logs")).first().Body == '[[[["Below the third level"]]]]'


def test_plainly_written_containers_are_rewritten_as_folded(spark):
    texts = [
        ('{"values":[{"intValue":"1"},{"arrayValue":{"values":[{"stringValue":"x, y"},{"arrayValue":{"values":[]}}]}},{"doubleValue":2.0}]}', False, True),
        ('{"values":[{"bytesValue":"/wA="},{"boolValue":true},{"doubleValue":"0.25"},{"intValue":-7}]}', False, True),
        ('{"values":[{"key":"b","value":{"stringValue":"]}}"}},{"key":"a","value":{"intValue":10}},{"key":"b","value":{"boolValue":false}}]}', True, True),
        ('{"values":[{"stringValue":"]}}"},{}]}', False, False), ('{"values":[{"doubleValue":-0.0},{"doubleValue":1e21}]}', False, False),
        ('{"values":[{"value":{"intValue":1},"key":"a"}]}', True, False), ('{"values":[{"stringValue":"\\n"}]}', False, False),
    ]
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, raw string, m boolean, plain boolean")
    plainly = f"if(m, raw RLIKE {values._PLAIN_MAP}, raw RLIKE {values._PLAIN_LIST}) AS found"
    # Written with a space, the same container goes through the fold.
    folded = values.plain_json("replace(raw, 'values\":', 'values\": ')", "m")
    got = rows.selectExpr("i", "plain", plainly, values.plain_json("raw", "m") + " AS now", folded + " AS folded").orderBy("i").collect()
    assert [r.found for r in got] == [r.plain for r in got]
    assert [r.now for r in got] == [r.folded for r in got]
    assert [r.now for r in got[:3]] == ['[1,["x, y",[]],2]', '["/wA=",true,0.25,-7]', '{"a":10,"b":false}']


def test_messages_are_parsed_once(spark):
    texts = [("{",), ('{"resourceSpans":[{"scopeSpans":[{"spans":[{"spanId":"0a","startTimeUnixNano":"1"}]}]}]}',), ('{"resourceSpans":[]}',), (None,)]
    parsed = otlp.parse_otlp_json(spark.createDataFrame(texts, "value string").repartition(2), "value", "traces")
    spans = otlp.flatten_spans(parsed)
    assert spans.count() == 1
    # A filter below the parse parsed every message for itself.
    plan = spans._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line[:80] and "from_json" in line for line in plan.splitlines())


def test_service_name_is_not_inherited(spark):
    """A resource without a name does not take over its neighbour's."""
    logs = {"resourceLogs": [
        {"resource": {"attributes": attrs(service_name="one")}, "schemaUrl": "urn:harbour:resource",
         "scopeLogs": [{"schemaUrl": "urn:harbour:log", "scope": {"name": "tide-gauge", "attributes": attrs(berth="north")},
                        "logRecords": [{"severityText": "Info", "severityNumber": 9, "flags": 1, "body": any_value("hello"),
                                        "timeUnixNano": str(BASE), "traceId": "3c" * 16}]}]},
        {"scopeLogs": [{"logRecords": [{"body": any_value({"k": 1})}, {}]}]},
    ]}
    df = otlp.flatten_logs(messages_of(spark, [logs], "logs"))
    assert [f.dataType for f in df.schema] == [f.dataType for f in schema.LOGS] and df.schema.names == schema.LOGS.names
    rows = df.collect()
    assert [r.ServiceName for r in rows] == ["one", "", ""] and [r.Body for r in rows] == ["hello", '{"k":1}', ""]
    assert rows[0].ResourceSchemaUrl == "urn:harbour:resource" and rows[0].ScopeSchemaUrl == "urn:harbour:log"
    assert rows[0].ScopeName == "tide-gauge" and rows[0].ScopeAttributes == {"berth": "north"}
    assert rows[0].TraceFlags == 1 and rows[0].SeverityNumber == 9 and rows[1].TraceFlags == 0


POINT = {"startTimeUnixNano": "1", "timeUnixNano": str(BASE), "flags": 1, "attributes": attrs(mast="fore")}
METRICS = {"resourceMetrics": [{"resource": {"attributes": attrs(service_name="m")}, "scopeMetrics": [{
    "scope": {"name": "barometer", "version": "1", "droppedAttributesCount": 3}, "schemaUrl": "u", "metrics": [
        {"name": "g", "unit": "1", "description": "d", "gauge": {"dataPoints": [
            {**POINT, "asInt": "-7", "exemplars": [{"filteredAttributes": attrs(why="test")},
                                                   {"timeUnixNano": str(BASE + 9), "asInt": "31", "spanId": "ab" * 8}]},
            {**POINT, "asDouble": 0.75}, POINT]}},
        {"name": "s", "sum": {"aggregationTemporality": 2, "isMonotonic": True, "dataPoints": [{**POINT, "asDouble": 1.25}]}},
        {"name": "h", "histogram": {"aggregationTemporality": 2, "dataPoints": [
            {**POINT, "count": "9", "sum": 20.5, "bucketCounts": ["4", "5"], "explicitBounds": [2.5], "min": 0.5, "max": 6.0}]}},
        {"name": "e", "exponentialHistogram": {"dataPoints": [
            {**POINT, "count": "6", "sum": 3.0, "scale": 3, "zeroCount": "2", "positive": {"offset": 1, "bucketCounts": ["1"]},
             "negative": {"offset": -4, "bucketCounts": ["1", "2"]}}]}},
        {"name": "q", "summary": {"dataPoints": [{**POINT, "count": "1", "sum": 8.0, "quantileValues": [{"quantile": 0.9, "value": 8.0}, {}]}]}},
        {"name": "empty", "gauge": {"dataPoints": []}},
        {"name": "untyped"},
    ]}]}]}


def test_metric_tables(spark):
    parsed = messages_of(spark, [METRICS], "metrics")
    made = otlp.split_metrics(parsed)
    for kind, df in made.items():
        assert df.schema.names == schema.METRICS[kind].names, kind
        assert [f.dataType for f in df.schema] == [f.dataType for f in schema.METRICS[kind]], kind
    gauge = made["gauge"].collect()
    assert [r.Value for r in gauge] == [-7.0, 0.75, 0.0]
    assert gauge[0].Attributes == {"mast": "fore"} and gauge[0].ScopeDroppedAttrCount == 3 and gauge[0].Flags == 1
    first, second = gauge[0].Exemplars
    assert (first.FilteredAttributes, first.Value, first.TraceId, first.SpanId) == ({"why": "test"}, 0.0, "0" * 32, "0" * 16)
    assert first.TimeUnix == dt.datetime(1970, 1, 1) and (second.Value, second.SpanId) == (31.0, "ab" * 8)
    total = made["sum"].first()
    assert (total.Value, total.AggTemp, total.IsMonotonic, total.StartTimeUnixNs) == (1.25, 2, True, 1)
    histogram = made["histogram"].first()
    assert (histogram.Count, histogram.BucketCounts, histogram.ExplicitBounds, histogram.Min) == (9, [4, 5], [2.5], 0.5)
    exponential = made["exponential_histogram"].first()
    assert (exponential.Scale, exponential.ZeroCount, exponential.PositiveOffset, exponential.NegativeBucketCounts) == (3, 2, 1, [1, 2])
    summary = made["summary"].first()
    assert [(q.Quantile, q.Value) for q in summary.ValueAtQuantiles] == [(0.9, 8.0), (0.0, 0.0)]
    assert [r.MetricName for r in otlp.untyped_metrics(parsed).collect()] == ["untyped"]
    kinds = otlp.flatten_metrics(parsed).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in kinds} == {
        "gauge": 3, "sum": 1, "histogram": 1, "exponential_histogram": 1, "summary": 1}


def test_quarantine(spark):
    """Bad records are collected with a reason, and the good ones go through."""
    good = {"traceId": "1" * 32, "spanId": "2" * 16, "startTimeUnixNano": "5", "endTimeUnixNano": "9"}
    odd = [{**good, "startTimeUnixNano": t} for t in (str(2**63), str(2**64 - 1), str(-(2**63)), "-1", "soon")]
    odd.append({**good, "events": [{"timeUnixNano": str(2**63)}]})
    messages = messages_of(spark, [trace_message([good, *odd, {**good, "traceId": "12"}, {**good, "endTimeUnixNano": "1"}]), "{broken"], "traces")
    assert otlp.out_of_range_times(messages).count() == 6
    assert [r.message for r in otlp.corrupt_messages(messages).collect()] == ["{broken"]
    assert sorted(r.reason for r in otlp.rejected(messages, "traces").collect()) == sorted([otlp.BAD_NUMBER] * 6 + ["message is not valid JSON"])
    kept, bad = catalog.validate(otlp.flatten_spans(messages), catalog.span_rules())
    assert kept.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["span ends before it starts", "trace id is not 32 hex digits"]


def test_quarantine_of_logs_and_metrics(spark):
    logs = {"resourceLogs": [{"scopeLogs": [{"logRecords": [
        {"timeUnixNano": str(BASE), "severityNumber": "SEVERITY_NUMBER_WARN2"}, {"timeUnixNano": str(2**63)}, {"severityNumber": 23}]}]}]}
    parsed = messages_of(spark, [logs], "logs")
    assert sorted((r.TimestampNs, r.SeverityNumber) for r in otlp.flatten_logs(parsed).collect()) == [(0, 23), (BASE, 14)]
    assert otlp.rejected(parsed, "logs").count() == 1 and otlp.corrupt_messages(parsed).count() == 0
    points = [{**POINT, "count": c, "bucketCounts": b} for c, b in (("1", ["1"]), (str(2**64 - 1), ["1"]), ("1", ["0", str(2**63)]), ("-1", []))]
    metrics = {"resourceMetrics": [{"scopeMetrics": [{"metrics": [
        {"name": "h", "histogram": {"aggregationTemporality": "AGGREGATION_TEMPORALITY_CUMULATIVE", "dataPoints": points}},
        {"name": "s", "sum": {"aggregationTemporality": "AGGREGATION_TEMPORALITY_DELTA", "dataPoints": [{**POINT, "asInt": "3"}]}}, {"name": "none"}]}]}]}
    parsed = messages_of(spark, [metrics], "metrics")
    assert [(r.kind, r.AggTemp) for r in otlp.flatten_metrics(parsed).orderBy("kind").collect()] == [("histogram", 2), ("sum", 1)]
    assert otlp.rejected(parsed, "metrics").count() == 4


def test_one_wrong_type_refuses_one_record(spark):
    """Neighbours of a record of a wrong type are stored, and each record goes one way only."""
    records = [{"timeUnixNano": "5", "flags": f, "severityText": str(i)} for i, f in enumerate([1, "1", "x", {"a": 1}, None, 2.5, True])]
    parsed = messages_of(spark, [{"resourceLogs": [{"scopeLogs": [{"logRecords": records}]}]}], "logs")
    stored = {r.SeverityText: r.TraceFlags for r in otlp.flatten_logs(parsed).collect()}
    refused = [json.loads(r.what)["resourceLogs"][0]["scopeLogs"][0]["logRecords"][0]["severityText"] for r in otlp.rejected(parsed, "logs").collect()]
    assert stored == {"0": 1, "1": 1, "4": 0} and sorted(refused) == ["2", "3", "5", "6"]
    points = [{**POINT, "asDouble": v} for v in (1.5, "2.5", "NaN", "many", [1])] + [{**POINT, "asInt": "x"}, {**POINT, "attributes": attrs(ok=True)}]
    metrics = {"resourceMetrics": [{"resource": {"attributes": attrs(host="h")}, "scopeMetrics": [{"scope": {"name": "a"}, "metrics": [{"name": "g", "unit": "m", "gauge": {"dataPoints": points}},
               {"name": "s", "sum": {"isMonotonic": "perhaps", "dataPoints": [POINT]}}]}]}]}
    parsed = messages_of(spark, [metrics], "metrics")
    assert sorted(str(r.Value) for r in otlp.flatten_metric(parsed, "gauge").collect()) == ["0.0", "1.5", "2.5", "nan"]
    rows = otlp.rejected(parsed, "metrics").collect()
    assert len(rows) == 4 and {r.reason for r in rows} == {otlp.BAD_TYPE}
    again = messages_of(spark, [r.what.replace('"many"', '"4.5"') for r in rows], "metrics")
    mended = otlp.flatten_metric(again, "gauge").collect()
    assert [(r.MetricName, r.MetricUnit, r.Value, r.ResourceAttributes, r.ScopeName, r.Attributes) for r in mended] == [("g", "m", 4.5, {"host": "h"}, "a", {"mast": "fore"})]
    # A list where an object belongs spoils the whole message: nothing of it is stored.
    whole = messages_of(spark, [{"resourceLogs": [{"scopeLogs": [{"logRecords": [{"timeUnixNano": "5"}, {"attributes": 7}]}]}]}], "logs")
    assert otlp.flatten_logs(whole).count() == 0 and [r.reason for r in otlp.rejected(whole, "logs").collect()] == [otlp.BAD_MESSAGE]


def test_typed_values(spark):
    kvs = attrs(n=7, on=True, ratio=0.5, word="x", none=None, many=[1, {"a": 2}], tree={"a": {"b": 3}}) + [{"key": "raw", "value": {"bytesValue": "/wA="}}]
    rows = otlp.flatten_spans(messages_of(spark, [trace_message([{"attributes": kvs, "events": [{"name": "e", "attributes": attrs(n=1)}]}])], "traces"), fields=True)
    row = rows.first()
    assert {f.key: f.type for f in row.SpanFields} == {"n": "int64", "on": "bool", "ratio": "float64", "word": "string", "none": None, "many": "array", "tree": "map", "raw": "binary"}
    assert [[(f.key, f.json, f.type) for f in e] for e in row.EventFields] == [[("n", "1", "int64")]]
    made = rows.select(values.fields_to_variant("SpanFields").alias("v")).selectExpr(
        "variant_get(v, '$.n', 'int') AS n", "variant_get(v, '$.tree.a.b', 'int') AS deep", "variant_get(v, '$.many[1].a', 'int') AS item",
        "try_variant_get(v, '$.word', 'int') AS odd", "schema_of_variant(v) AS kinds").first()
    assert (made.n, made.deep, made.item, made.odd) == (7, 3, 2, None) and "tree: OBJECT<a: OBJECT<b: BIGINT>>" in made.kinds


def test_severity_names(spark):
    names = [f"SEVERITY_NUMBER_{n}{d}" for n in otlp.SEVERITIES for d in ("", "2", "3", "4")] + ["SEVERITY_NUMBER_UNSPECIFIED", "x", None, "7"]
    rows = spark.createDataFrame(list(enumerate(names)), "i int, s string").orderBy("i")
    assert [r[0] for r in rows.select(otlp.severity_number(F.col("s"))).collect()] == [*range(1, 25), 0, 0, 0, 7]


def test_tables_on_disk(spark, tmp_path):
    day = 86_400_000_000_000
    rows = [{"TimestampNs": 1_704_067_200_000_000_000 + d * day + i, "TraceId": f"{i:032x}", "SpanId": f"{d}-{i}",
             "SpanAttributes": {"a.b": str(i)} if i else {}} for d in range(4) for i in range(3)]
    path = str(tmp_path / "spans")
    tables.write_spans(spans_of(spark, rows), path, promote={"SpanAttributes": ["a.b"]})
    stored = tables.read_table(spark, path)
    assert stored.count() == 12
    assert "attr_SpanAttributes_a_2e_b" in stored.columns
    assert stored.filter(tables.attribute_equals(stored, ["SpanAttributes"], "a.b", "1")).count() == 4
    assert stored.filter(tables.attribute_equals(stored, ["SpanAttributes"], "a.b", "")).count() == 4
    # A second load adds to the first, and its attributes are found though it promotes none.
    tables.write_spans(spans_of(spark, rows[1:2]), path)
    for stored in (tables.read_table(spark, path), spark.read.schema(stored.schema).parquet(path)):
        assert stored.count() == 13
        assert stored.filter(tables.attribute_equals(stored, ["SpanAttributes"], "a.b", "1")).count() == 5
    # 1 to 4 January; on the 5th, whatever is from before the 3rd is older than two days.
    now = dt.datetime(2024, 1, 5, 6)
    kept = tables.retained(spark.read.parquet(path), 2, now).select("day").distinct().count()
    assert tables.apply_retention(spark, path, 2, now) == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(path).select("day").distinct().count() == kept == 2
    assert tables.apply_retention(spark, path, 0, now) == []


def test_attribute_equals_prefers_the_first_map(spark):
    rows = spans_of(spark, [
        {"SpanAttributes": {"k": "a"}, "ResourceAttributes": {"k": "b"}}, {"ResourceAttributes": {"k": "b"}}, {"SpanAttributes": {"k": ""}}])
    both = ["SpanAttributes", "ResourceAttributes"]
    assert rows.filter(tables.attribute_equals(rows, both, "k", "a")).count() == 1
    assert rows.filter(tables.attribute_equals(rows, both, "k", "b")).count() == 1
    assert rows.filter(tables.attribute_equals(rows, both, "k", "")).count() == 1


def test_append_if_absent(spark):
    existing = spark.createDataFrame([("a", "old", {"m": "1"})], "id string, doc string, attrs map<string,string>")
    new = spark.createDataFrame([("a", "new", {}), ("b", "x", {}), ("b", "x", {}), ("c", "y", {"k": "v"}), (None, "p", {}), (None, "q", {})], existing.schema)
    assert sorted(r.id or "" for r in tables.append_if_absent(existing, new, "id").collect()) == ["", "", "b", "c"]


def test_index_names_stay_text(spark, tmp_path):
    rows = spark.createDataFrame([("{}", "007"), ("{}", "2024"), ("{}", "main")], "document string, index_name string")
    tables.write_documents(rows, str(tmp_path / "docs"))
    assert sorted(r.index_name for r in tables.read_documents(spark, str(tmp_path / "docs")).collect()) == ["007", "2024", "main"]


def test_parts_split_only_large_groups(spark):
    """A hot group is spread over parts, small ones stay whole, and nothing is lost."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("k"), "id")
    parts = span_ops.in_parts(rows, ["k"], ["id"], 1000)
    sizes = parts.groupBy("k", "part", "parts").count().collect()
    assert sum(r["count"] for r in sizes) == 30_000
    hot = [r for r in sizes if r.k == "hot"]
    assert len(hot) == 10 and max(r["count"] for r in hot) < 1300
    assert all(r.parts == 1 and r.part == 0 for r in sizes if r.k != "hot")
    assert span_ops.in_parts(rows, ["id"], ["id"], 1000).filter("part <> 0").count() == 0


def test_points_are_sorted_by_a_column_for_their_attributes(spark):
    """An expression among the sort keys would be worked out again in every comparison."""
    r = random.Random(5)
    rows = [(r.choice("ab"), {str(r.randrange(3)): str(r.randrange(9)) for _ in range(2)}, r.randrange(50)) for _ in range(300)]
    df = spark.createDataFrame([*rows, (None, None, None)], "MetricName string, Attributes map<string,string>, TimeUnix long").coalesce(1)
    laid_out = tables._laid_out(df, ["MetricName"], ["MetricName", maps.attributes_id(F.col("Attributes")), "TimeUnix"], [])
    sorts = [line for line in laid_out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "lambda" not in sorts[0]
    assert laid_out.columns == df.columns
    key = lambda row: (row[0] or "", ";".join(sorted(f"{k}:{v}" for k, v in (row[1] or {}).items())), row[2] or 0)
    parts: dict[int, list[tuple]] = {}
    for *row, part in laid_out.select("*", F.spark_partition_id()).collect():
        parts.setdefault(part, []).append(tuple(row))
    assert all(part == sorted(part, key=key) for part in parts.values())
    assert sorted(map(key, sum(parts.values(), []))) == sorted(map(key, [*rows, (None, None, None)]))
