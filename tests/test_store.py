"""Loads and calls of the store."""

import datetime as dt
import json

import pytest

from telesift.plans.log_search import LogQuery
from telesift.plans.trace_search import TraceQuery
from telesift.sources import otlp
from telesift.store import Store
from tests.helpers import any_value, attrs, messages_of, trace_message
from tests.test_ingest import METRICS

BASE = 1_704_067_200_000_000_000
HOUR = 3_600_000_000_000


def span(trace, number, at, **more):
    return {"traceId": f"{trace:032x}", "spanId": f"{number:016x}", "name": f"op{number}", "kind": 2,
            "startTimeUnixNano": str(BASE + at), "endTimeUnixNano": str(BASE + at + 1500), "attributes": attrs(user="7"), **more}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("store")), promote={"SpanAttributes": ["user"]})
    # A trace over midnight and over two loads.
    first = trace_message([span(1, 1, 23 * HOUR), span(2, 3, 1 * HOUR)], attrs(service_name="shop"))
    second = trace_message([span(1, 2, 25 * HOUR, parentSpanId=f"{1:016x}")], attrs(service_name="db"))
    made.load_traces(messages_of(spark, [first], "traces"), 0)
    for _ in range(2):
        made.load_traces(messages_of(spark, [second], "traces"), 1)
    logs = {"resourceLogs": [{"resource": {"attributes": attrs(service_name="shop")}, "scopeLogs": [{"logRecords": [
        {"timeUnixNano": str(BASE), "severityText": "ERROR", "body": any_value("an error"), "traceId": f"{1:032x}"},
        {"timeUnixNano": str(BASE + 1000), "severityText": "INFO", "body": any_value("fine")}]}]}]}
    made.load_logs(messages_of(spark, [logs], "logs"), 0)
    made.load_metrics(messages_of(spark, [METRICS], "metrics"), 0)
    return made


def test_a_load_run_again_replaces_itself(store):
    assert store.spans().count() == 3 and store.bounds().count() == 3
    assert "attr_SpanAttributes_user" in store.spans().columns


def test_trace_calls(store):
    assert sorted(r.SpanName for r in store.get_trace(f"{1:032x}").collect()) == ["op1", "op2"]
    query = TraceQuery(service_name="db", tags={"user": "7"}, start=dt.datetime(2024, 1, 2), end=dt.datetime(2024, 1, 3))
    found = store.search_traces(query).collect()
    # The first span is from the day before the searched range, and is part of the summary.
    assert [(r.trace_id, r.span_count, r.operation_name, r.duration) for r in found] == [(f"{1:032x}", 2, "op1", "1.5µs")]
    assert [p.service_name for p in found[0].process_map] == ["db", "shop"]
    assert store.search_recent_spans(TraceQuery(num_traces=1)).count() == 2
    assert store.get_services().count() == 2
    assert [r[0] for r in store.get_operations("db").collect()] == ["op2"]
    assert store.get_services(start=dt.datetime(2024, 1, 2)).count() == 1
    assert [r[0] for r in store.get_operations(end=dt.datetime(2024, 1, 1, 2)).collect()] == ["op3"]
    with pytest.raises(ValueError):
        store.get_trace("")


def test_rejected_records_are_kept_aside(store):
    rows = store.rejected().collect()
    assert [(r.signal, json.loads(r.what)["resourceMetrics"][0]["scopeMetrics"][0]["metrics"], r.reason) for r in rows] == [
        ("metrics", [{"name": "untyped"}], "metric type is unset or unsupported")]


def test_refused_records_can_be_loaded_again(spark, tmp_path):
    made = Store(spark, str(tmp_path / "s"))
    message = trace_message([span(1, 1, 0), span(1, 2, 0, startTimeUnixNano="-5")], attrs(service_name="shop", port=80), {"name": "lib", "version": "3"})
    assert made.load_traces(messages_of(spark, [message, "{broken"], "traces"), 0) == {"stored": 1, "refused": 2}
    refused = {r.reason: r.what for r in made.rejected().collect()}
    assert refused["message is not valid JSON"] == "{broken"
    mended = refused[otlp.BAD_NUMBER].replace('"-5"', f'"{BASE + 7}"')
    assert made.load_traces(messages_of(spark, [json.loads(mended)], "traces"), 1) == {"stored": 1, "refused": 0}
    rows = {r.SpanId[-1]: r for r in made.spans().collect()}
    assert (rows["2"].ServiceName, rows["2"].ResourceAttributes["port"], rows["2"].ScopeName, rows["2"].TimestampNs) == ("shop", "80", "lib", BASE + 7)
    assert rows["2"].SpanAttributes == rows["1"].SpanAttributes and made.bounds().count() == 2
    assert made.load_traces(messages_of(spark, [{}], "traces"), 2) == {"stored": 0, "refused": 0}
    assert made.apply_retention(1, dt.datetime(2030, 1, 1)) == {"spans": ["2024-01-01"], "bounds": ["2024-01-01"]}
    assert made.rejected().count() == 2


def test_log_and_metric_calls(store):
    assert [r.Body for r in store.search_logs(LogQuery(tokens=("error",))).collect()] == ["an error"]
    assert store.get_logs(f"{1:032x}").count() == 1
    assert sorted(r.Value for r in store.metric_points("gauge", "g", {"mast": "fore"}).collect()) == [-7.0, 0.0, 0.75]
    assert store.metric_points("sum", "g").count() == 0
