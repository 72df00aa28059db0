"""JSON documents and the field model."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telesift.operators import catalog, documents as docs
from telesift.sources import otlp
from telesift.sources.documents import documents_to_spans
from tests.helpers import attrs, messages_of, spans_of, trace_message

FIELDS = "f array<struct<key:string,json:string>>"


def fields_table(spark, documents: list[list[tuple]]):
    rows = [(i, [(k, v) for k, v in d]) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, f"i int, {FIELDS}")


def deduplicated(spark, documents):
    made = docs.with_deduplicated(fields_table(spark, documents), "f").orderBy("i").collect()
    return [[(f.key, f.json) for f in r.f] for r in made]


@pytest.mark.parametrize("given_fields, wanted", [
    # '-' sorts before '.', and 'ab' only looks like a child of 'a'.
    ([("a", "1"), ("a-b", "2"), ("a.c", "3")], [("a-b", "2"), ("a.c", "3"), ("a.value", "1")]),
    ([("a", "1"), ("ab.c", "2")], [("a", "1"), ("ab.c", "2")]),
    ([], []),
])
def test_dedup(spark, given_fields, wanted):
    assert deduplicated(spark, [given_fields]) == [wanted]


def plain_dedup(pairs):
    last = dict(pairs)
    result = {}
    for key, value in last.items():
        if any(other.startswith(key + ".") for other in last):
            if key + ".value" in last:
                continue
            key += ".value"
        result[key] = value
    return sorted(result.items(), key=lambda p: p[0].encode())


def plain_nested(pairs):
    root = {}
    for key, value in pairs:
        *parents, leaf = key.split(".")
        level = root
        for parent in parents:
            level = level.setdefault(parent, {})
        level[leaf] = json.loads(value)
    return root


KEYS = st.lists(st.sampled_from(["a", "b", "a-b", "c d", "é", 'q"', "value"]), min_size=1, max_size=3).map(".".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(KEYS, st.integers(0, 99).map(str)), max_size=8), min_size=30, max_size=60))
def test_dedup_and_nesting_against_plain_python(spark, documents):
    made = deduplicated(spark, documents)
    assert made == [plain_dedup(d) for d in documents]
    # A lifted field can still meet a deeper one (a.value and a.value.b); such documents are left out.
    clean = [d for d in made if not any(b.startswith(a + ".") for a, _ in d for b, _ in d)]
    if clean:
        nested = docs.with_nested_json(fields_table(spark, clean), "f", "d").orderBy("i").collect()
        assert [json.loads(r.d) for r in nested] == [plain_nested(d) for d in clean]
        flat = fields_table(spark, clean).select("i", docs.flat_json(F.col("f")).alias("d")).orderBy("i").collect()
        assert [list(json.loads(r.d).items()) for r in flat] == [[(k, json.loads(v)) for k, v in d] for d in clean]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(KEYS, st.integers(0, 9).map(str)), max_size=12), min_size=5, max_size=20))
def test_sorting_is_stable(spark, documents):
    made = fields_table(spark, documents).orderBy("i").select(docs.sort_fields(F.col("f")).alias("f")).collect()
    assert [[tuple(f) for f in r.f] for r in made] == [sorted(d, key=lambda p: p[0].encode()) for d in documents]


def test_empty_values_are_left_out(spark):
    made = fields_table(spark, [[("a", None), ("b", "[]"), ("c", "{}"), ("d", "null"), ("e", '"[]"')], []])
    flat = made.orderBy("i").select(docs.flat_json(F.col("f")).alias("d")).collect()
    assert [r.d for r in flat] == ['{"d":null,"e":"[]"}', "{}"]
    nested = docs.with_nested_json(made, "f", "d").orderBy("i").collect()
    assert [r.d for r in nested] == ['{"d":null,"e":"[]"}', "{}"]


def plain_flat(prefix, value):
    """Leaves of nested maps by their joined names; lists stay whole, nothing and empty maps go."""
    out = []
    for key in value:
        name, inner = (f"{prefix}.{key}" if prefix else key), value[key]
        if isinstance(inner, dict):
            out += plain_flat(name, inner)
        elif inner is not None:
            out.append((name, inner))
    return out


LEAVES = st.one_of(st.integers(-5, 5), st.booleans(), st.sampled_from(["", "x y", 'say "so"']), st.none(), st.lists(st.integers(0, 3), max_size=2))
TREES = st.dictionaries(st.sampled_from(["k", "m", "z2", "list"]), st.recursive(LEAVES, lambda t: st.dictionaries(st.sampled_from(["p", "q", "r"]), t, max_size=3), max_leaves=6), max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TREES, min_size=5, max_size=15))
def test_flatten_nested(spark, trees):
    rows = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)] + [(len(trees), None)], "i int, t string")
    for prefix in ("outer", ""):
        made = rows.orderBy("i").select(docs.flatten_nested(prefix, F.col("t")).alias("f")).collect()
        assert [{f.key: json.loads(f.json) for f in r.f} for r in made] == [dict(plain_flat(prefix, t)) for t in trees] + [{}]


BEGIN, TOOK = dt.datetime(2031, 8, 17, 22, 41, 9, 250_000, dt.timezone.utc), dt.timedelta(milliseconds=1750)
NANOS = lambda t: (int(t.timestamp()) * 1_000_000 + t.microsecond) * 1000
SPAN = {
    "traceId": "5e" * 16, "spanId": "77" * 8, "name": "load harbour map", "kind": 2, "startTimeUnixNano": str(NANOS(BEGIN) + 37),
    "endTimeUnixNano": str(NANOS(BEGIN + TOOK) + 37), "attributes": attrs(tile="q7", zoom=11, cached=False),
    "links": [{"traceId": "d0" * 16, "spanId": "09" * 8}],
    "events": [{"timeUnixNano": str(NANOS(BEGIN) + 990), "name": "drawn", "attributes": attrs(layer="sea")}],
}


def plain_document(typed):
    """What a flat document of SPAN must hold, from the span itself."""
    text = lambda t, ns: t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond * 1000 + ns:09d}Z"
    values = {"tile": "q7", "zoom": 11, "cached": False}
    link = [{"attribute": {}, "spanID": "09" * 8, "traceID": "d0" * 16}]
    return {
        "@timestamp": text(BEGIN, 37), "EndTimestamp": text(BEGIN + TOOK, 37), "Kind": "SPAN_KIND_SERVER", "Name": "load harbour map",
        "SpanId": "77" * 8, "TraceId": "5e" * 16, "TraceStatus": 0, "Link": json.dumps(link, separators=(",", ":")),
        "Events.drawn.time": text(BEGIN, 990), "Events.drawn.layer": "sea", "Resource.service.name": "charts", "Resource.region": "north",
    } | {f"Attributes.{k}": v if typed else json.dumps(v).strip('"') for k, v in values.items()}


def test_span_document(spark):
    message = trace_message([SPAN], attrs(service_name="charts", region="north"))
    for typed in (False, True):
        spans = otlp.flatten_spans(messages_of(spark, [message], "traces"), fields=typed)
        made = json.loads(docs.encode_span_documents(spans).first().document)
        assert made == plain_document(typed) and list(made) == sorted(made, key=str.encode)
    nested = json.loads(docs.encode_span_documents(spans, dedot=True).first().document)
    assert nested == plain_nested([(k, json.dumps(v)) for k, v in plain_document(True).items()])


def test_same_name_events_collide_and_the_last_wins(spark):
    events = [{"timeUnixNano": str(i), "name": "e", "attributes": attrs(n=str(i))} for i in (1, 2)]
    spans = otlp.flatten_spans(messages_of(spark, [trace_message([{**SPAN, "events": events}])], "traces"))
    document = json.loads(docs.encode_span_documents(spans).first().document)
    assert document["Events.e.n"] == "2" and document["Events.e.time"] == "1970-01-01T00:00:00.000000002Z"


def test_fields_of_values_of_unknown_depth_are_deduplicated_once(spark):
    record = {"spanId": "0a", "body": {"stringValue": "b"}, "attributes": attrs(n=1, a={"b": 2}, a_b=3)}
    parsed = messages_of(spark, [{"resourceLogs": [{"scopeLogs": [{"logRecords": [record]}]}]}], "logs")
    flat = docs.encode_log_documents(otlp.flatten_logs(parsed, fields=True))
    nested = docs.encode_log_documents(flat.withColumnRenamed("document", "flat"), dedot=True)
    # Fields gathered below an Arrow UDF were put into every lambda that looked at them: four times a document, field by field.
    for made in (flat, nested):
        plan = made.select("document")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("map_from_entries(transform(concat(") == 1
    row = nested.select("flat", "document").first()
    assert json.loads(row["flat"])["Attributes.a.b"] == 3 and json.loads(row["document"])["Attributes"] == {"a": {"b": 3}, "n": 1}


def test_types_of_tags_are_looked_up_once(spark):
    span = {"spanId": "0a", "startTimeUnixNano": "1", "attributes": attrs(n=1, even=True, s="x", half=0.5) + [{"key": "none", "value": {}}]}
    span["attributes"].append({"key": "raw", "value": {"bytesValue": "/wA="}})
    flat = otlp.flatten_spans(messages_of(spark, [trace_message([span])], "traces"), fields=True)
    encoded = docs.encode_jaeger_documents(flat).select("document")
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    # One of the span, of an event, of the resource; before, each lookup of each tag made its own.
    assert plan.count("struct(key, lambda") and plan.split("+- ")[0].count("map_from_entries(") == 3
    tags = {t["key"]: (t["type"], t["value"]) for t in json.loads(encoded.first()[0])["tags"]}
    assert tags == {
        "n": ("int64", "1"), "even": ("bool", "true"), "s": ("string", "x"), "half": ("float64", "0.5"), "none": ("string", ""),
        "raw": ("binary", "ff00"),
    }


def test_jaeger_document(spark):
    message = trace_message([{**SPAN, "parentSpanId": "2c" * 8, "status": {"code": 2, "message": "no"}}], attrs(host="h"), {"name": "lib"})
    made = json.loads(docs.encode_jaeger_documents(otlp.flatten_spans(messages_of(spark, [message], "traces"))).first().document)
    assert made["references"] == [
        {"refType": "CHILD_OF", "traceID": "5e" * 16, "spanID": "2c" * 8}, {"refType": "FOLLOWS_FROM", "traceID": "d0" * 16, "spanID": "09" * 8}]
    micros = NANOS(BEGIN) // 1000
    assert (made["startTime"], made["startTimeMillis"], made["duration"]) == (micros, micros // 1000, TOOK // dt.timedelta(microseconds=1))
    assert made["process"] == {"serviceName": "OTLPResourceNoServiceName", "tags": [{"key": "host", "type": "string", "value": "h"}]}
    tags = {t["key"]: (t["type"], t["value"]) for t in made["tags"]}
    assert tags["error"] == ("bool", "true") and tags["span.kind"] == ("string", "server") and tags["otel.status_code"][1] == "ERROR"
    assert made["logs"][0]["timestamp"] == micros and made["logs"][0]["fields"][0]["value"] == "drawn"


def test_stored_documents_read_back(spark):
    stored = [{**plain_document(True), "TraceStatus": 2, "Attributes.share": 0.25, "Resource.argv": ["-v", "x"]}, {"@timestamp": "2031-08-17T22:41:09Z"}]
    rows = spark.createDataFrame([(json.dumps(d),) for d in stored] + [(None,), ("no json",)], "document string")
    made = documents_to_spans(rows)
    first = made.filter("SpanName = 'load harbour map'").first()
    assert first.TimestampNs == NANOS(BEGIN) + 37 and first.Duration == TOOK // dt.timedelta(microseconds=1) * 1000
    assert first.SpanAttributes == {"tile": "q7", "zoom": "11", "cached": "false", "share": "0.25"}
    assert first.ResourceAttributes == {"service.name": "charts", "region": "north", "argv": '["-v","x"]'} and first.ServiceName == "charts"
    assert (first.SpanKind, first.StatusCode) == ("SPAN_KIND_SERVER", "STATUS_CODE_ERROR")
    good, bad = catalog.validate(made, {"trace id is missing": F.col("TraceId") == ""})
    assert good.count() == 1 and bad.count() == 2


PREFIX, SUFFIX = catalog.INDEX_PREFIX, catalog.INDEX_SUFFIX


@pytest.mark.parametrize("span, resource, wanted", [
    ({}, {}, "base"), ({PREFIX: "p1."}, {}, "p1.base"), ({SUFFIX: ".s1"}, {PREFIX: "p2."}, "p2.base.s1"),
    ({PREFIX: "p1.", SUFFIX: ".s1"}, {PREFIX: "p2.", SUFFIX: ".s2"}, "p2.base.s2"),
])
def test_index_routing(spark, span, resource, wanted):
    rows = spans_of(spark, [{"SpanAttributes": span, "ResourceAttributes": resource}])
    assert catalog.route_by_index(rows, "base").first().index_name == wanted
    assert catalog.route_by_index(rows, "base", enabled=False).first().index_name == "base"
