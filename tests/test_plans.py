"""What the physical plans must look like, whatever the data."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks.views import Views
from telesift.operators import attributes, bounds, documents, logs as log_ops, metrics, sampling, span_metrics, spans as span_ops
from telesift.plans import trace_search as ts
from telesift.sources import otlp, tables
from tests.helpers import spans_of

SF = "/root/testdata/sf0.001"
START, END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    views, folder = Views(spark, SF), tmp_path_factory.mktemp("tables")
    tables.write_spans(views.spans, f"{folder}/spans", promote={"SpanAttributes": ["k"], "ResourceAttributes": ["k"]})
    tables.write_logs(views.logs, f"{folder}/logs")
    tables.write_bounds(bounds.trace_bounds(views.spans), f"{folder}/bounds")
    return {name: tables.read_table(spark, f"{folder}/{name}") for name in ("spans", "logs", "bounds")}


def scans(text: str) -> list[str]:
    return [line for line in text.split("\n") if "FileScan" in line]


def test_time_ranges_prune_days(stored):
    for df in (log_ops.severity_series(stored["logs"], START), span_ops.error_spans(stored["spans"], "svc-error", START),
               ts.find_trace_ids(stored["spans"], ts.TraceQuery(start=START, end=END))):
        for scan in scans(plan(df)):
            assert "PartitionFilters: [isnotnull(day" in scan and ">= 2024-01-05" in scan


def test_only_needed_columns_are_read(stored):
    text = plan(ts.find_trace_ids(stored["spans"], ts.TraceQuery(service_name="a", start=START, end=END)))
    assert "ReadSchema: struct<Timestamp:timestamp,TraceId:string,ServiceName:string>" in text
    assert "EqualTo(ServiceName,a)" in text


def test_lookup_by_id_is_pushed_down(stored):
    assert "EqualTo(TraceId,x)" in plan(ts.get_trace(stored["spans"], "x"))
    pruned = plan(ts.get_trace_pruned(stored["spans"], stored["bounds"], "x"))
    assert "coalesce((day" in pruned.split("PartitionFilters: [", 1)[1] and "Subquery" in pruned


def test_promoted_attributes_are_pushed_down(stored):
    text = plan(span_ops.spans_with_attribute(stored["spans"], "svc-click", "k", "42"))
    assert "EqualTo(attr_SpanAttributes_k,42)" in text
    text = plan(span_ops.span_filter(stored["spans"], attributes={"k": "42"}))
    assert "EqualTo(attr_ResourceAttributes_k,42)" in text and "Or(" in text


def test_searched_traces_prune_days(stored):
    query = ts.TraceQuery(service_name="svc-click", start=START, end=END)
    for df in (ts.search_traces_by_matches(stored["spans"], query, stored["bounds"]),
               ts.search_spans_recent(stored["spans"], stored["bounds"], ts.TraceQuery(end=END))):
        spans_scans = [line for line in scans(plan(df)) if "SpanAttributes" in line or "SpanName" in line]
        assert spans_scans and all("PartitionFilters: [isnotnull(day" in line for line in spans_scans)
        assert any("Subquery" in line for line in spans_scans)


def test_bounds_are_pruned_by_either_end_of_a_range(stored):
    for query, sign in ((ts.TraceQuery(start=START), ">= 2024-01-05"), (ts.TraceQuery(end=END), "<= 2024-01-06")):
        text = plan(ts.search_spans_recent(stored["spans"], stored["bounds"], query))
        assert any(f"(day#" in line and sign in line for line in scans(text))


def test_no_cartesian_products_and_no_python(stored):
    views_spans, query = stored["spans"], ts.TraceQuery(start=START, end=END)
    made = [
        span_ops.root_spans(views_spans), span_ops.trace_summaries(views_spans), span_ops.services_latest(views_spans),
        span_metrics.service_graph(views_spans), span_metrics.span_metrics(views_spans),
        sampling.tail_sample(views_spans, sampling.TailPolicy(has_error=True)), ts.search_traces_by_matches(views_spans, query),
        documents.encode_span_documents(views_spans, dedot=True), documents.encode_jaeger_documents(views_spans),
        attributes.redact(views_spans, ["a"], ["b"]),
    ]
    for df in made:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Python" not in text and "ArrowEval" not in text


def test_flattening_needs_no_shuffle_and_no_python(spark, tmp_path):
    Views(spark, SF).trace_messages.write.text(f"{tmp_path}/m")
    read = lambda signal: otlp.read_otlp_json(spark, f"{tmp_path}/m", signal)
    for df in (otlp.flatten_spans(read("traces")), otlp.flatten_spans(read("traces"), fields=True), otlp.flatten_metrics(read("metrics")),
               *[otlp.judged(read(signal), signal) for signal in otlp.SIGNALS]):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text
        assert len(scans(text)) == 1


def test_summaries_scan_once(stored):
    text = plan(span_ops.trace_summaries(stored["spans"]))
    assert len(scans(text)) == 1 and "Window" not in text


def test_aggregations_combine_before_they_shuffle(stored):
    for df in (bounds.trace_bounds(stored["spans"]), span_ops.services_latest(stored["spans"]),
               span_metrics.span_metrics(stored["spans"]), span_metrics.service_graph(stored["spans"]),
               sampling.tail_verdicts(stored["spans"], sampling.TailPolicy(has_error=True))):
        assert "partial_" in plan(df)


def test_deltas_never_window_a_whole_series(spark):
    text = plan(metrics.cumulative_to_delta(Views(spark, SF).sum))
    windows = [line for line in text.split("\n") if " Window " in line]
    # One over points, per bucket; one over the last points of buckets.
    assert len(windows) == 2 and "_bucket" in windows[0] and "partial_max" in text


def test_no_search_forces_a_broadcast(stored):
    query = ts.TraceQuery(start=START, end=END)
    for df in (ts.multi_get_traces(stored["spans"], ["a"]), ts.search_traces_by_matches(stored["spans"], query, stored["bounds"]),
               ts.search_spans_recent(stored["spans"], stored["bounds"], query)):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_catalogues_of_a_time_range_prune_days(stored):
    for df in (span_ops.services_latest(stored["spans"], START, END), span_ops.services_top(stored["spans"], start=START),
               span_ops.operations(stored["spans"], start=START), span_ops.operations_top(stored["spans"], start=START, end=END)):
        for scan in scans(plan(df)):
            assert "PartitionFilters: [isnotnull(day" in scan and ">= 2024-01-05" in scan


def test_building_parts_runs_no_job(stored):
    context = stored["spans"].sparkSession.sparkContext
    context.setJobGroup("parts", "parts")
    sampling.group_by_trace(stored["spans"])
    span_ops.spans_to_resource_spans(stored["spans"])
    assert list(context.statusTracker().getJobIdsForGroup("parts")) == []


def test_log_filters_are_pushed_down(stored):
    text = plan(log_ops.logs_by_service(stored["logs"], "svc-view", limit=100))
    assert "EqualTo(ServiceName,svc-view)" in text and "TakeOrderedAndProject" in text
    assert "StringContains(Body,the)" in plan(log_ops.logs_has_token(stored["logs"], "the"))


def test_trace_ids_have_a_bloom_filter(stored):
    import duckdb

    files = stored["spans"].inputFiles()
    rows = duckdb.connect().execute(
        "SELECT path_in_schema, bloom_filter_offset FROM parquet_metadata(?)", [files[0].removeprefix("file://")]).fetchall()
    assert dict(rows)["TraceId"] is not None and dict(rows)["SpanName"] is None


def test_bloom_filters_are_as_large_as_the_ids_need(spark, tmp_path):
    import duckdb

    rows = spans_of(spark, [{"TraceId": f"{i:032x}"} for i in range(50)])
    tables.write_spans(rows.coalesce(1), str(tmp_path / "spans"))
    spans = tables.read_table(spark, str(tmp_path / "spans"))
    files = [name.removeprefix("file://") for name in spans.inputFiles()]
    assert sum(map(os.path.getsize, files)) < 50_000
    lengths = duckdb.connect().execute(
        "SELECT bloom_filter_length FROM parquet_metadata(?) WHERE path_in_schema = 'TraceId'", [files]).fetchall()
    assert all(0 < length < 10_000 for length, in lengths)
    assert [spans.filter(F.col("TraceId") == f"{i:032x}").count() for i in (0, 49, 50)] == [1, 1, 0]
