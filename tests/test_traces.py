"""Trace operators on small and on skewed tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from telesift.operators import attributes, bounds, catalog, sampling, span_metrics, spans as span_ops
from telesift.plans import trace_search as ts
from telesift.plans.log_search import LogQuery, search_logs
from telesift.sources import tables
from tests.helpers import spans_of

START, END = dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1)


def test_root_is_found_whatever_the_order(spark):
    rows = [{"SpanId": "child", "ParentSpanId": "parent", "TimestampNs": 1}, {"SpanId": "parent", "TimestampNs": 2}]
    assert span_ops.root_spans(spans_of(spark, rows)).first().SpanId == "parent"


def test_roots(spark):
    rows = [
        # Two roots: the earlier one counts; an orphan is a root too.
        {"TraceId": "two", "SpanId": "b", "TimestampNs": 5}, {"TraceId": "two", "SpanId": "a", "ParentSpanId": "gone", "TimestampNs": 4},
        # A tie in time is broken by the id.
        {"TraceId": "tie", "SpanId": "y", "TimestampNs": 5}, {"TraceId": "tie", "SpanId": "x", "TimestampNs": 5},
        # A cycle has no root.
        {"TraceId": "cycle", "SpanId": "p", "ParentSpanId": "q"}, {"TraceId": "cycle", "SpanId": "q", "ParentSpanId": "p"},
        # A parent in another trace does not count.
        {"TraceId": "other", "SpanId": "c", "ParentSpanId": "a"},
        {"TraceId": "", "SpanId": "none"},
    ]
    spans = spans_of(spark, rows)
    assert {r.TraceId: r.SpanId for r in span_ops.root_spans(spans).collect()} == {"two": "a", "tie": "x", "other": "c"}
    summaries = {r.trace_id: r for r in span_ops.trace_summaries(spans).collect()}
    assert set(summaries) == {"two", "tie", "cycle", "other"}
    cycle = summaries["cycle"]
    assert (cycle.span_count, cycle.operation_name, cycle.status, cycle.start_time, cycle.duration) == (2, "", 0, None, "")


def test_repeated_span_ids_count_each(spark):
    rows = [{"SpanId": "a"}, {"SpanId": "a"}, {"SpanId": "b", "ParentSpanId": "a"}]
    summary = span_ops.trace_summaries(spans_of(spark, rows)).first()
    assert summary.span_count == 3 and summary.operation_name == "op"


@pytest.mark.parametrize("code, kind, status", [
    ("OK", "CLIENT", 1), ("ERROR", "SERVER", 0), ("UNSET", "CLIENT", 0), ("UNSET", "SERVER", 1), ("UNSET", "INTERNAL", 1),
    ("UNSET", "PRODUCER", 0), ("", "SERVER", 0)])
def test_status(spark, code, kind, status):
    columns = F.lit(f"STATUS_CODE_{code}"), F.lit(f"SPAN_KIND_{kind}")
    assert spark.range(1).select(span_ops.trace_status(*columns)).first()[0] == status


def test_summary_processes(spark):
    rows = [
        {"ServiceName": "b", "ResourceAttributes": {"service.name": "b", "host": "late"}, "TimestampNs": 9},
        {"ServiceName": "b", "ResourceAttributes": {"service.name": "b", "host": "early"}, "TimestampNs": 3},
        {"ServiceName": "a", "ResourceAttributes": {"service.name": "a"}, "TimestampNs": 5},
        {"ServiceName": "", "ResourceAttributes": {"host": "none"}, "TimestampNs": 1},
    ]
    summary = span_ops.trace_summaries(spans_of(spark, rows)).first()
    assert [(p.service_name, p.tags) for p in summary.process_map] == [("a", {}), ("b", {"host": "early"})]
    assert summary.warnings == []


def test_hot_trace_and_hot_parent(spark):
    """A third of all spans in one trace, all below one parent; brute force by counting."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("TraceId"),
        F.col("id").cast("string").alias("SpanId"),
        F.when(F.col("id") == 0, "").when(F.col("id") % 3 == 0, "0").otherwise("").alias("ParentSpanId"),
        F.col("id").alias("TimestampNs"), F.lit("op").alias("SpanName"), F.lit("SPAN_KIND_SERVER").alias("SpanKind"),
        F.lit("STATUS_CODE_OK").alias("StatusCode"), F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("ServiceName"),
        F.lit(1).cast("bigint").alias("Duration"), F.expr("map('service.name', 's')").alias("ResourceAttributes"),
    )
    made = {r.trace_id: r for r in span_ops.trace_summaries(rows).collect()}
    assert len(made) == 1001 and made["hot"].span_count == 20_000 and len(made["hot"].process_map) == 5
    roots = {r.TraceId: r.SpanId for r in span_ops.root_spans(rows).collect()}
    assert roots["hot"] == "0" and roots["1"] == "1"
    parts = sampling.group_by_trace(rows, max_spans=1000).filter("TraceId = 'hot'")
    assert parts.agg(F.sum("span_count")).first()[0] == 20_000 and parts.agg(F.max("span_count")).first()[0] < 1300


def test_service_graph_of_a_hot_client(spark):
    """One client span with countless children, and a repeated client id, against a plain join."""
    rows = spark.range(30_000).select(
        F.lit("t").alias("TraceId"),
        F.when(F.col("id") < 2, "c").otherwise(F.col("id").cast("string")).alias("SpanId"),
        F.when(F.col("id") >= 2, "c").otherwise("").alias("ParentSpanId"),
        F.when(F.col("id") < 2, "SPAN_KIND_CLIENT").otherwise("SPAN_KIND_SERVER").alias("SpanKind"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("ServiceName"),
        F.when(F.col("id") % 7 == 0, "STATUS_CODE_ERROR").otherwise("STATUS_CODE_OK").alias("StatusCode"),
        (F.col("id") * 1000).alias("Duration"), F.expr("map()").cast("map<string,string>").alias("SpanAttributes"),
        F.expr("map('k8s.cluster.id', 'c1')").alias("ResourceAttributes"),
    )
    made = span_metrics.service_graph(rows)
    clients = rows.filter("SpanKind = 'SPAN_KIND_CLIENT'").alias("c")
    servers = rows.filter("SpanKind = 'SPAN_KIND_SERVER'").alias("s")
    pairs = servers.join(clients, F.expr("s.TraceId = c.TraceId AND s.ParentSpanId = c.SpanId")).groupBy(
        F.col("c.ServiceName").alias("client"), F.col("s.ServiceName").alias("server")
    ).agg(
        F.count("*").alias("calls"),
        F.expr("count_if(c.StatusCode = 'STATUS_CODE_ERROR' OR s.StatusCode = 'STATUS_CODE_ERROR')").alias("failed"),
        F.sum("c.Duration").alias("client_duration_ns"), F.sum("s.Duration").alias("server_duration_ns"),
    )
    columns = ["client", "server", "calls", "failed", "client_duration_ns", "server_duration_ns"]
    assert sorted(made.select(*columns).collect()) == sorted(pairs.select(*columns).collect())
    first = made.first()
    assert sum(first.server_bucket_counts) == first.calls and first["client_k8s.cluster.id"] == "c1"


def test_services_latest_keeps_ties(spark):
    rows = [
        {"ServiceName": "a", "ResourceAttributes": {"h": "1"}, "TimestampNs": 9},
        {"ServiceName": "a", "ResourceAttributes": {"h": "2", "g": "x"}, "TimestampNs": 9},
        {"ServiceName": "a", "ResourceAttributes": {"g": "x", "h": "2"}, "TimestampNs": 9},
        {"ServiceName": "a", "ResourceAttributes": {"h": "3"}, "TimestampNs": 8}]
    made = span_ops.services_latest(spans_of(spark, rows)).collect()
    assert sorted(r.ResourceAttributes["h"] for r in made) == ["1", "2"]


def test_operations(spark):
    spans = spans_of(spark, [
        {"SpanName": "a", "SpanKind": "SPAN_KIND_INTERNAL"}, {"SpanName": "b", "SpanKind": "SPAN_KIND_CLIENT"},
        {"SpanName": "b", "SpanKind": "SPAN_KIND_SERVER"}, {"SpanName": "c", "ServiceName": "other", "SpanKind": "SPAN_KIND_SERVER"}])
    assert sorted(r[0] for r in span_ops.operations(spans).collect()) == ["a", "b", "c"]
    assert [r[0] for r in span_ops.operations(spans, "svc", "SPAN_KIND_INTERNAL").collect()] == ["a"]
    assert [tuple(r) for r in span_ops.operations_top(spans).collect()] == [("b", 2), ("c", 1)]
    assert [tuple(r) for r in span_ops.services_top(spans, 1).collect()] == [("svc", 3)]


def test_search_needs_a_range(spark):
    spans = spans_of(spark, [{}])
    for query in (ts.TraceQuery(), ts.TraceQuery(start=START), ts.TraceQuery(start=END, end=START), ts.TraceQuery(start=START, end=START)):
        with pytest.raises(ValueError):
            ts.find_trace_ids(spans, query)
    with pytest.raises(ValueError):
        ts.get_trace(spans, "")


def test_one_span_must_match_all(spark):
    spans = spans_of(spark, [
        {"TraceId": "split", "SpanAttributes": {"a": "1"}}, {"TraceId": "split", "SpanAttributes": {"b": "2"}},
        {"TraceId": "one", "SpanAttributes": {"a": "1"}, "ResourceAttributes": {"b": "2"}}])
    query = ts.TraceQuery(tags={"a": "1", "b": "2"}, start=START, end=END)
    assert [r.TraceId for r in ts.find_trace_ids(spans, query).collect()] == ["one"]


def test_recent_search_limits_before_it_filters(spark):
    hour = 3_600_000_000_000
    base = 1_700_000_000_000_000_000
    spans = spans_of(spark, [
        {"TraceId": "old", "ServiceName": "x", "TimestampNs": base}, {"TraceId": "new", "ServiceName": "y", "TimestampNs": base + hour}])
    partial = bounds.trace_bounds(spans).unionAll(bounds.trace_bounds(spans))
    query = ts.TraceQuery(service_name="x", num_traces=1, start=START, end=END)
    assert ts.search_spans_recent(spans, partial, query).count() == 0
    assert ts.search_spans_recent(spans, partial, ts.TraceQuery(service_name="x")).count() == 1
    assert [r.TraceId for r in ts.find_trace_ids(spans, query).collect()] == ["old"]


def test_duration_bounds_are_total_and_inclusive(spark):
    spans = spans_of(spark, [{"TraceId": str(s), "Duration": s * 1_000_000_000} for s in (1, 2, 3)])
    query = ts.TraceQuery(start=START, end=END, duration_min=2_000_000_000)
    assert sorted(r.TraceId for r in ts.find_trace_ids(spans, query).collect()) == ["2", "3"]
    query = ts.TraceQuery(start=START, end=END, duration_max=2_000_000_000)
    assert sorted(r.TraceId for r in ts.find_trace_ids(spans, query).collect()) == ["1", "2"]


def test_multi_get(spark):
    spans = spans_of(spark, [{"TraceId": t, "SpanId": f"{t}{i}"} for t in ("a", "b", "") for i in range(3)])
    assert ts.multi_get_traces(spans, ["a", "", "zz"]).count() == 3
    assert ts.multi_get_traces(spans, ["a", "b"], max_rows=4).count() == 4
    with_bounds = ts.multi_get_traces(spans, ["a"], bounds=bounds.trace_bounds(spans))
    assert with_bounds.count() == 3


def test_exact_bounds(spark):
    spans = spans_of(spark, [{"TimestampNs": 10, "Duration": 100}, {"TimestampNs": 50, "Duration": 1}, {"TraceId": ""}])
    assert tuple(bounds.trace_bounds_exact(spans).first()) == ("t1", 10, 110)


def test_resource_spans_round_trip(spark):
    spans = spans_of(spark, [{"ResourceAttributes": {"a": str(i % 2)}} for i in range(10)])
    made = span_ops.spans_to_resource_spans(spans).collect()
    assert sorted((r.resource_id, len(r.Spans)) for r in made) == [("a:0", 5), ("a:1", 5)]
    assert made[0].Spans[0].StatusCode == "STATUS_CODE_UNSET"


def test_service_operations_leave_out_nameless(spark):
    spans = spans_of(spark, [{}, {}, {"SpanName": "other"}, {"ServiceName": "", "ResourceAttributes": {}}])
    made = catalog.service_operations(spans).collect()
    assert sorted((r.serviceName, r.operationName) for r in made) == [("svc", "op"), ("svc", "other")]
    assert spans.filter(catalog.has_no_service(spans)).count() == 1


def test_attribute_edits(spark):
    spans = spans_of(spark, [{"SpanAttributes": {"a": "1"}}])
    assert attributes.insert_attribute(spans, "a", "2").first().SpanAttributes == {"a": "1"}
    assert attributes.update_attribute(spans, "b", "2").first().SpanAttributes == {"a": "1"}
    assert attributes.upsert_attribute(spans, "b", 2).first().SpanAttributes == {"a": "1", "b": "2"}
    assert attributes.delete_attribute(spans, "a").first().SpanAttributes == {}
    moved = attributes.group_by_attrs(spans, ["a", "x"]).first()
    assert moved.SpanAttributes == {} and moved.ResourceAttributes == {"service.name": "svc", "a": "1"}
    renamed = attributes.upsert_resource_attribute(spans, "service.name", "new").first()
    assert renamed.ServiceName == "new" and renamed.ResourceAttributes["service.name"] == "new"


def test_redaction(spark):
    spans = spans_of(spark, [{"SpanAttributes": {"keep": "card 4111 and 42", "drop": "x", "plain": "ok"}}])
    row = attributes.redact(spans, ["keep", "plain"], ["[0-9]{4}", "[0-9]{2}"]).first()
    assert row.SpanAttributes == {"keep": "card **** and ****", "plain": "ok"}
    assert (row.redacted_keys, row.masked_values) == (1, 1)


def test_routes_and_filters_treat_unknown_as_false(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "i int, v string")
    assert [r.route for r in attributes.route(rows, [(F.col("v") == "x", "hit")], "rest").orderBy("i").collect()] == ["rest", "hit"]
    assert attributes.filter_signals(rows, F.col("v") == "x").count() == 1


def test_names_from_and_to_attributes(spark):
    spans = spans_of(spark, [{"SpanName": "/order/17/item/4", "SpanAttributes": {"svc": "a"}}, {"SpanName": "other"}])
    made = attributes.name_to_attributes(spans, "^/order/([0-9]+)/item/([0-9]+)$", ["order", "item"]).orderBy("SpanId").collect()
    assert made[0].SpanName == "/order/{order}/item/{item}" and made[0].SpanAttributes == {"svc": "a", "order": "17", "item": "4"}
    assert made[1].SpanName == "other" and made[1].SpanAttributes == {}
    assert [r.SpanName for r in attributes.rename_spans(spans, ["svc"]).orderBy("SpanId").collect()] == ["a", "other"]


def test_enrichment_keeps_rows_and_own_values(spark):
    spans = spans_of(spark, [{"ResourceAttributes": {"host": "h1", "zone": "own"}}, {"ResourceAttributes": {"host": "h9"}}, {"ResourceAttributes": {}}])
    hosts = spark.createDataFrame([("h1", "z1", "r1"), ("h1", "z1", "r1"), ("h2", "z2", None)], "host string, zone string, region string")
    made = attributes.enrich(spans, hosts, "host").orderBy("SpanId").collect()
    assert [r.ResourceAttributes for r in made] == [{"host": "h1", "zone": "own", "region": "r1"}, {"host": "h9"}, {}]


def test_sampling_is_the_same_for_every_signal(spark):
    ids = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("TraceId"))
    kept = sampling.probabilistic_sample(ids, 0.3, seed=5)
    again = sampling.probabilistic_sample(ids.withColumn("more", F.lit(1)), 0.3, seed=5).select("TraceId")
    assert kept.exceptAll(again).count() == 0 and 5700 < kept.count() < 6300
    assert sampling.probabilistic_sample(ids, 0.1, seed=5).join(kept, "TraceId", "left_anti").count() == 0
    assert sampling.probabilistic_sample(ids, 1.0).count() == 20_000 and sampling.probabilistic_sample(ids, 0.0).count() == 0


def test_tail_sampling_keeps_whole_traces(spark):
    spans = spans_of(spark, [
        {"TraceId": "bad", "StatusCode": "STATUS_CODE_ERROR"}, {"TraceId": "bad"}, {"TraceId": "fine"},
        {"TraceId": "long", "TimestampNs": 1}, {"TraceId": "long", "TimestampNs": 5_000, "Duration": 10},
        {"TraceId": "vip", "SpanAttributes": {"user": "7"}}, {"TraceId": "vip"}])

    def kept(**policy):
        return sorted(r.TraceId for r in sampling.tail_sample(spans, sampling.TailPolicy(**policy)).collect())

    assert kept(has_error=True) == ["bad", "bad"]
    assert kept(min_duration_ns=5_000) == ["long", "long"]
    assert kept(attributes={"user": "7"}) == ["vip", "vip"]
    assert kept(ratio=1.0) == sorted(r.TraceId for r in spans.collect())
    assert kept() == []


def test_log_search_without_conditions_is_the_newest(spark):
    logs = spark.range(5).select(
        F.timestamp_seconds(F.col("id")).alias("Timestamp"), (F.col("id") * 1_000_000_000).alias("TimestampNs"),
        F.col("id").cast("string").alias("SpanId"))
    assert [r.SpanId for r in search_logs(logs, LogQuery(limit=2)).collect()] == ["4", "3"]
    with pytest.raises(KeyError):
        from telesift.operators.logs import logs_json_number

        logs_json_number(logs, "$.x", "~", 1)


@pytest.mark.parametrize("name, pattern, keys, wanted, found", [
    ("1op-1-x1", r"^1op-(\d)-x1$", ["n"], "1op-{n}-x1", {"n": "1"}),
    ("/u/no/key/o", r"^/u/(\w+)/key/(\w)$", ["n", "o"], "/u/{n}/key/{o}", {"n": "no", "o": "o"}),
    ("see aa then aa", r"(a+) then (a+)", ["x", "y"], "see {x} then {y}", {"x": "aa", "y": "aa"}),
    ("[(7)]", r"[\[(]+(\d)(?:\))", ["n"], "[({n})]", {"n": "7"}),
    ("other", r"^/u/(\w+)$", ["n"], "other", {}),
])
def test_names_are_rebuilt_around_the_groups(spark, name, pattern, keys, wanted, found):
    row = attributes.name_to_attributes(spans_of(spark, [{"SpanName": name}]), pattern, keys).first()
    assert (row.SpanName, row.SpanAttributes) == (wanted, found)


@pytest.mark.parametrize("name, pattern, keys, wanted, found", [
    ("x1", r"^x(\d)|y(\d)$", ["a", "b"], "x{a}", {"a": "1"}),
    ("ay2", r"^x(\d)|y(\d)$", ["a", "b"], "ay{b}", {"b": "2"}),
    ("abc", r"^(\w)+$", ["last"], "ab{last}", {"last": "c"}),
    ("GET /u/17/x", r"/u/(?P<id>\d+)", None, "GET /u/{id}/x", {"id": "17"}),
    ("GET /u/17/x", r"^(?<verb>[A-Z]+) (?:/[^/]+)/(?P<id>\d+)", None, "{verb} /u/{id}/x", {"verb": "GET", "id": "17"}),
    ("a-a-b", r"(\w)-\1-([^)(\]]+)", ["x", "y"], "{x}-{x}-{y}".replace("-{x}-", "-a-"), {"x": "a", "y": "b"}),
    ("k=v;", r"((\w)=(\w));", ["pair", "k", "v"], "{pair};", {"pair": "k=v", "k": "k", "v": "v"}),
    ("line1\nline 2", r"line (\d)", ["n"], "line1\nline {n}", {"n": "2"}),
    ("nothing", r"(\d+)", ["n"], "nothing", {}),
])
def test_groups_keep_their_places(spark, name, pattern, keys, wanted, found):
    row = attributes.name_to_attributes(spans_of(spark, [{"SpanName": name}]), pattern, keys).first()
    assert (row.SpanName, row.SpanAttributes) == (wanted, found)


def test_only_days_that_traces_touch_are_read(spark, tmp_path):
    """One trace of 1970 and one of today: the files of the days between are not opened."""
    day = 86_400_000_000_000
    rows = [{"TraceId": t, "SpanId": t, "ServiceName": "s", "TimestampNs": n} for t, n in (("old", 0), ("between", 9_000 * day), ("new", 19_000 * day))]
    spans = spans_of(spark, rows)
    tables.write_spans(spans, str(tmp_path / "s"), batch_id=0)
    limits = bounds.trace_bounds(spans)
    stored = tables.read_table(spark, str(tmp_path / "s"))
    for folder in (tmp_path / "s").iterdir():
        if folder.name not in ("day=1970-01-01", "day=2022-01-08") and folder.is_dir():
            for file in folder.rglob("*.parquet"):
                file.write_bytes(b"broken")
    assert sorted(r.TraceId for r in ts.multi_get_traces(stored, ["old", "new"], bounds=limits).collect()) == ["new", "old"]
    with pytest.raises(Exception):
        ts.multi_get_traces(stored, ["old", "between"], bounds=limits).collect()


def test_nested_groups_are_refused(spark):
    for pattern, keys in ((r"((a)b)", ["x"]), (r"(a)(b)", ["x"])):
        with pytest.raises(ValueError):
            attributes.name_to_attributes(spans_of(spark, [{}]), pattern, keys)


def test_recent_search_takes_each_end_alone(spark, tmp_path):
    day = 86_400_000_000_000
    spans = spans_of(spark, [{"TraceId": f"t{d}", "SpanId": f"s{d}", "TimestampNs": 1_704_067_200_000_000_000 + d * day} for d in range(5)])
    tables.write_spans(spans, str(tmp_path / "s"))
    tables.write_bounds(bounds.trace_bounds(spans), str(tmp_path / "b"))
    stored, limits = tables.read_table(spark, str(tmp_path / "s")), tables.read_table(spark, str(tmp_path / "b"))

    def found(**how):
        return sorted(r.TraceId for r in ts.search_spans_recent(stored, limits, ts.TraceQuery(**how)).collect())

    assert found() == ["t0", "t1", "t2", "t3", "t4"]
    assert found(end=dt.datetime(2024, 1, 2)) == ["t0", "t1"]
    assert found(start=dt.datetime(2024, 1, 4)) == ["t3", "t4"]
    assert found(start=dt.datetime(2024, 1, 2), end=dt.datetime(2024, 1, 3), num_traces=1) == ["t2"]


def test_traces_without_bounds_or_start_are_found(spark, tmp_path):
    spans = spans_of(spark, [{"TraceId": "a", "SpanId": "1", "TimestampNs": 0}, {"TraceId": "a", "SpanId": "2"}, {"TraceId": "b", "SpanId": "3"}])
    tables.write_spans(spans, str(tmp_path / "s"))
    stored = tables.read_table(spark, str(tmp_path / "s"))
    limits = bounds.trace_bounds(spans.filter("TraceId = 'a'"))
    assert ts.get_trace_pruned(stored, limits, "a").count() == 2
    assert ts.get_trace_pruned(stored, limits, "b").count() == 1
    assert ts.multi_get_traces(stored, ["a"], bounds=limits).count() == 2
