"""Streams: equal to batch, restartable, replayable, bounded by watermarks."""

import datetime as dt
import json
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import all_queries
from checks.views import Views
from telesift.operators import bounds, catalog, sampling, span_metrics
from telesift.sources import otlp, tables
from telesift.streaming import assembly, derived, ingest
from tests.helpers import attrs, spans_of, trace_message
from tests.test_ingest import METRICS

SECOND = 1_000_000_000
BASE = 1_704_067_200 * SECOND


def write_lines(folder, name, messages):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)


def span(i, **more):
    return {"traceId": f"{i % 4 + 1:032x}", "spanId": f"{i + 1:016x}", "startTimeUnixNano": str(BASE + i * SECOND),
            "endTimeUnixNano": str(BASE + i * SECOND + 5), **more}


def test_ingest_goes_on_where_it_stopped_and_survives_a_replay(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "spans", "check"))

    def run():
        stream = ingest.message_stream(spark, source, files_per_batch=1)
        ingest.stream_ingest(stream, "traces", table, check).awaitTermination()
        return tables.read_table(spark, table)

    write_lines(source, "one", [trace_message([span(i) for i in range(10)], attrs(service_name="s"))])
    assert run().count() == 10
    write_lines(source, "two", [trace_message([span(i) for i in range(10, 15)]), "{broken"])
    write_lines(source, "three", [trace_message([span(20, startTimeUnixNano="18446744073709551615")])])
    assert run().count() == 15
    assert run().count() == 15
    # The last batch once more, as after a crash between its write and its commit.
    last = max(int(n) for n in os.listdir(f"{check}/commits") if n.isdigit())
    for name in (f"{check}/commits/{last}", f"{check}/commits/.{last}.crc"):
        if os.path.exists(name):
            os.remove(name)
    again = run()
    assert again.count() == 15 and again.select("SpanId").distinct().count() == 15
    refused = tables.read_rejected(spark, table).collect()
    assert sorted(r.reason for r in refused) == [otlp.BAD_NUMBER, "message is not valid JSON"]


def test_two_streams_and_a_load_share_a_table(spark, tmp_path):
    table, bounds_table = str(tmp_path / "spans"), str(tmp_path / "bounds")
    for k in range(2):
        source = str(tmp_path / f"in{k}")
        write_lines(source, "one", [trace_message([span(10 * k + i) for i in range(5)])])
        ingest.stream_ingest(
            ingest.message_stream(spark, source), "traces", table, str(tmp_path / f"check{k}"), bounds=bounds_table
        ).awaitTermination()
    tables.write_spans(spans_of(spark, [{"SpanId": "load"}]), table, batch_id=0)
    assert spark.read.parquet(table).count() == 11
    assert bounds.merge_trace_bounds(spark.read.parquet(bounds_table)).count() == 4
    tables.write_spans(spans_of(spark, [{"SpanId": "unnumbered"}]), table)
    assert spark.read.parquet(table).count() == 12
    assert tables.read_rejected(spark, table).count() == 0


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_batches_of_messages_are_bounded_and_leave_no_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "BATCH_BYTES", 1, raising=False)
    source, table, check = (str(tmp_path / n) for n in ("in", "spans", "check"))
    for k in range(3):
        write_lines(source, f"part{k}", [trace_message([span(10 * k + i) for i in range(5)])])
    before = shuffle_files(spark)
    ingest.stream_ingest(ingest.message_stream(spark, source), "traces", table, check).awaitTermination()
    left = shuffle_files(spark) - before
    stored = tables.read_table(spark, table)
    assert sorted(r["count"] for r in stored.groupBy("batch_id").count().collect()) == [5, 5, 5]
    assert stored.select("SpanId").distinct().count() == 15 and not left


def test_a_batch_of_few_partitions_is_dealt(spark, tmp_path):
    """A compressed file can't be split; all its messages are kept, equal ones too."""
    one = spark.range(0, 400, 1, 1).selectExpr("CAST(id % 100 AS STRING) AS value")
    one.write.option("compression", "gzip").text(str(tmp_path / "one"))
    batch = spark.read.text(str(tmp_path / "one"))
    dealt = ingest._dealt(batch)
    assert batch.rdd.getNumPartitions() == 1 and "Exchange" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.value for r in dealt.collect()) == sorted(r.value for r in batch.collect())
    many = batch.repartition(spark.sparkContext.defaultParallelism)
    assert ingest._dealt(many) is many


def test_two_streams_take_halves_of_the_same_messages(spark, monkeypatch):
    """Made twice, a message may come out otherwise, and be of both halves or of none."""
    fresh = F.udf(lambda: uuid.uuid4().hex, "string").asNondeterministic()
    text = ['{"resourceSpans":[{"resource":{"attributes":[{"key":"service.name","value":{"stringValue":"', F.col("id").cast("string"),
            '"}}]},"scopeSpans":[{"scope":{"name":"', fresh(), '"},"spans":[{"spanId":"1"}]}]}]}']
    messages = spark.range(40).select(F.concat(*[F.lit(t) if isinstance(t, str) else t for t in text]).alias("value"))
    monkeypatch.setattr(Views, "trace_messages", messages)
    made = all_queries()["two_streams_one_table"](spark, "/nowhere").collect()
    assert sorted((int(r.ServiceName), r.spans) for r in made) == [(i, 1) for i in range(40)]


def events_of(spark, folder, ids):
    rows = [(i, dt.datetime(2024, 1, 1, 0, i % 60), i % 9, ("view", "error", "purchase")[i % 3], i / 4, f'{{"k": {i}}}') for i in ids]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    df.write.parquet(f"{folder}/events.parquet")
    return Views(spark, str(folder))


def test_messages_are_made_by_one_shuffle_of_events_as_stored(spark, tmp_path):
    ids = [*range(300), 7, 7, 64]
    views = events_of(spark, tmp_path, ids)
    plan = views.trace_messages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Sort " not in plan
    made = views.trace_messages.collect()
    assert len(made) == 5
    spans = otlp.flatten_spans(otlp.parse_otlp_json(spark.read.text(views.written(views.trace_messages)), "value", "traces"))
    columns = ["SpanId", "TraceId", "ServiceName", "Duration", "TimestampNs"]
    assert sorted(map(tuple, spans.select(columns).collect())) == sorted(map(tuple, views.spans.select(columns).collect()))
    assert spans.count() == len(ids)


def test_batches_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """A table that is said to hold more events is ingested from more files, compressed, two a batch."""
    events_of(spark, tmp_path, range(2000))
    folders, read = [], ingest.message_stream
    monkeypatch.setattr(ingest, "message_stream", lambda s, folder, **how: folders.append(folder) or read(s, folder, **how))
    files = lambda: [name for name in os.listdir(folders[-1]) if name.startswith("part-")]
    for count, wanted in ((2000, 4), (6 * 2**20, 6)):
        monkeypatch.setattr(Views, "event_count", count, raising=False)
        made = all_queries()["stream_ingest"](spark, str(tmp_path))
        assert sum(r.spans for r in made.collect()) == 2000
        assert len(files()) == wanted and all(name.endswith(".gz") for name in files())
        assert {p.split("batch_id=")[1].split("/")[0] for p in made.inputFiles()} == {str(i) for i in range(wanted // 2)}


def test_ingest_of_logs_and_metrics(spark, tmp_path):
    logs = {"resourceLogs": [{"scopeLogs": [{"logRecords": [{"timeUnixNano": str(BASE), "severityText": "Info"}] * 3}]}]}
    for signal, message, table in (("logs", logs, "l"), ("metrics", METRICS, "m")):
        source = str(tmp_path / f"in-{signal}")
        write_lines(source, "one", [message])
        ingest.stream_ingest(
            ingest.message_stream(spark, source), signal, str(tmp_path / table), str(tmp_path / f"check-{signal}")
        ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "l")).count() == 3
    gauge = tables.read_metric_table(spark, str(tmp_path / "m"), "gauge")
    assert gauge.count() == 3 and "ValueAtQuantiles" not in gauge.columns and "Value" in gauge.columns
    assert tables.read_metric_table(spark, str(tmp_path / "m"), "summary").count() == 1
    assert [r.reason for r in tables.read_rejected(spark, str(tmp_path / "m")).collect()] == [otlp.BAD_KIND]
    with pytest.raises(ValueError):
        tables.metric_table_for("x", "counter")


def loads(spark, tmp_path, *batches):
    """A stream of spans that arrive as the given loads, and a way to make the next one arrive."""
    folder = str(tmp_path / "loads")
    frames = [spans_of(spark, rows) for rows in batches]
    schema = frames[0].schema

    def arrive(n):
        frames[n].coalesce(1).write.mode("append").parquet(folder)
        return spark.readStream.schema(schema).parquet(folder)

    return arrive


def test_bounds_of_a_trace_over_two_loads(spark, tmp_path):
    first = [{"TimestampNs": BASE + 5 * SECOND, "TraceId": "a"}, {"TimestampNs": BASE, "TraceId": ""}]
    second = [{"TimestampNs": BASE, "TraceId": "a"}, {"TimestampNs": BASE + 9 * SECOND, "TraceId": "a"}]
    arrive = loads(spark, tmp_path, first, second)
    table, check = str(tmp_path / "bounds"), str(tmp_path / "check")
    for n in range(2):
        ingest.stream_trace_bounds(arrive(n), table, check).awaitTermination()
    stored = spark.read.parquet(table)
    assert stored.count() == 2
    made = bounds.merge_trace_bounds(stored).first()
    assert (made.End - made.Start).total_seconds() == 9


def test_operations_are_written_once_per_ttl(spark, tmp_path):
    hour = 3600 * SECOND
    arrive = loads(
        spark, tmp_path, [{"SpanName": "a", "TimestampNs": BASE}, {"SpanName": "a", "TimestampNs": BASE + 1}],
        [{"SpanName": "a", "TimestampNs": BASE + hour}, {"SpanName": "b", "TimestampNs": BASE + hour}],
        [{"SpanName": "a", "TimestampNs": BASE + 13 * hour}, {"SpanName": "b", "TimestampNs": BASE + 12 * hour},
         {"ServiceName": "", "ResourceAttributes": {}, "TimestampNs": BASE}],
    )
    table, check = str(tmp_path / "operations"), str(tmp_path / "check")
    for n, wanted in enumerate([["a"], ["a", "b"], ["a", "a", "b"]]):
        ingest.stream_service_operations(arrive(n), table, check, ttl="12 hours").awaitTermination()
        stored = spark.read.parquet(table)
        assert sorted(r.operationName for r in stored.collect()) == wanted
    assert stored.filter("operationName = 'a'").select("id").distinct().count() == 1


def test_late_rows_go_aside(spark, tmp_path):
    arrive = loads(
        spark, tmp_path, [{"SpanId": "x", "TimestampNs": BASE + 100 * SECOND}],
        [{"SpanId": "late", "TimestampNs": BASE + 39 * SECOND}, {"SpanId": "just", "TimestampNs": BASE + 40 * SECOND}])
    path, check = str(tmp_path / "split"), str(tmp_path / "check")
    for n in range(2):
        ingest.stream_split_late(arrive(n), "Timestamp", "60 SECONDS", path, check).awaitTermination()
    assert sorted(r.SpanId for r in ingest.read_side(spark, path, "on_time").collect()) == ["just", "x"]
    assert [r.SpanId for r in ingest.read_side(spark, path, "late").collect()] == ["late"]


def test_late_rows_are_told_from_one_small_file(spark, tmp_path):
    """Batches long gone are not needed: their files may go."""
    times = [100, 10, 50, 200, 120]
    arrive = loads(spark, tmp_path, *[[{"SpanId": str(t), "TimestampNs": BASE + t * SECOND}] for t in times])
    path, check = str(tmp_path / "split"), str(tmp_path / "check")
    for n in range(len(times)):
        ingest.stream_split_late(arrive(n), "Timestamp", "60 SECONDS", path, check).awaitTermination()
        for old in range(n):
            for file in os.listdir(f"{path}/newest/batch_id={old}"):
                os.remove(f"{path}/newest/batch_id={old}/{file}")
    assert sorted(r.SpanId for r in ingest.read_side(spark, path, "late").collect()) == ["10", "120"]


def test_assembled_traces_equal_the_batch(spark, tmp_path):
    rows = [{"TraceId": f"t{i % 7}", "SpanId": f"{i:03}", "TimestampNs": BASE + i * SECOND} for i in range(200)]
    rows += [{"TraceId": "hot", "SpanId": f"h{i:04}", "TimestampNs": BASE + i * 1000} for i in range(1000)] + [{"TraceId": "", "SpanId": "x", "TimestampNs": BASE}]
    last = [{"TraceId": "z", "TimestampNs": BASE + 100_000 * SECOND}]
    arrive = loads(spark, tmp_path, rows[:100] + rows[200:], rows[100:200], last)
    table, check = str(tmp_path / "traces"), str(tmp_path / "check")
    for n in range(3):
        stream = assembly.assemble_traces_stream(arrive(n), gap_ms=30_000, delay="1 second", max_spans=60)
        derived.to_table(stream, table, check).awaitTermination()
    made = spark.read.parquet(table)
    spans = lambda df: sorted((r.TraceId, r.s.SpanId, r.s.TimestampNs) for r in df.selectExpr("TraceId", "explode(Spans) AS s").collect())
    assert spans(made) == spans(sampling.group_by_trace(spans_of(spark, rows)))
    parts = made.collect()
    assert max(r.span_count for r in parts) <= 60 and sorted(r.part for r in parts if r.TraceId == "hot") == list(range(17))
    assert all([s.TimestampNs for s in r.Spans] == sorted(s.TimestampNs for s in r.Spans) for r in parts)
    assert sorted(r.TraceId for r in parts if r["last"]) == ["hot"] + [f"t{i}" for i in range(7)]


def test_traces_of_a_bucket_are_assembled_together(spark, tmp_path):
    """Each by its own times and gaps, with all fields as they were; one message of state serves them all."""
    odd = {"SpanName": 'a "b", \\ c\n{}[]', "StatusCode": None, "ParentSpanId": "", "Duration": None}
    rows = [{"TraceId": f"t{i % 5}", "SpanId": f"{i:02}", "TimestampNs": BASE + i * SECOND, **(odd if i % 2 else {})} for i in range(40)]
    rows += [{"TraceId": "t0", "SpanId": "again", "TimestampNs": BASE + 2000 * SECOND}]
    nudge = [{"TraceId": "y", "SpanId": "y", "TimestampNs": BASE + 300 * SECOND}]
    last = [{"TraceId": "z", "SpanId": "z", "TimestampNs": BASE + 100_000 * SECOND}]
    arrive = loads(spark, tmp_path, rows[:20], rows[20:40], nudge, rows[40:], last)
    table, check = str(tmp_path / "traces"), str(tmp_path / "check")
    for n in range(5):
        stream = assembly.assemble_traces_stream(arrive(n), gap_ms=30_000, delay="20 seconds", buckets=1)
        derived.to_table(stream, table, check).awaitTermination()
    made = spark.read.parquet(table)
    fields = ["SpanId", "SpanName", "StatusCode", "ParentSpanId", "Duration"]
    found = made.selectExpr("TraceId", "explode(Spans) AS s").select("TraceId", *[f"s.{c}" for c in fields]).collect()
    given = [r for r in spans_of(spark, rows + nudge).select("TraceId", *fields).collect()]
    assert sorted(map(str, found)) == sorted(map(str, given))
    assert sorted((r.TraceId, r.span_count) for r in made.collect()) == sorted([*[(f"t{i}", 8) for i in range(5)], ("t0", 1), ("y", 1)])
    assert all(r["last"] and r.part == 0 for r in made.collect())


def test_state_of_a_bucket_is_one_value():
    calls = []

    class Handle:
        def getValueState(self, *_):
            return self

        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append("update")

        def registerTimer(self, at):
            calls.append("timer")

    class Times:
        getCurrentWatermarkInMs = staticmethod(lambda: 0)

    made = assembly._Assembly(30_000, 10_000)
    made.init(Handle())
    frame = pd.DataFrame({"TraceId": [f"t{i % 300}" for i in range(3000)], "TimestampNs": range(BASE, BASE + 3000), "SpanId": "s", "span": "{}"})
    assert list(made.handleInputRows((0,), iter([frame]), Times)) == [] and calls == ["get", "timer", "update"]


def test_unpaired_spans_come_out_on_expiry(spark, tmp_path):
    client = {"SpanKind": "SPAN_KIND_CLIENT", "ServiceName": "a", "TimestampNs": BASE}
    server = {"SpanKind": "SPAN_KIND_SERVER", "ServiceName": "b", "TimestampNs": BASE}
    rows = [{**client, "TraceId": "1", "SpanId": "c"}, *[{**server, "TraceId": "1", "ParentSpanId": "c", "SpanId": f"s{i}"} for i in range(5)],
            {**client, "TraceId": "2", "SpanId": "alone"}, {**server, "TraceId": "3", "ParentSpanId": "gone", "SpanId": "y"},
            {**server, "TraceId": "4", "SpanId": "root"}]
    later = [{**client, "TraceId": "9", "SpanId": "n", "TimestampNs": BASE + 1000 * SECOND}, {**server, "TraceId": "8", "SpanId": "m", "ParentSpanId": "l", "TimestampNs": BASE + 1000 * SECOND}]
    arrive = loads(spark, tmp_path, rows, later)
    table, check = str(tmp_path / "unpaired"), str(tmp_path / "check")
    for n in range(2):
        derived.to_table(derived.unpaired_spans_stream(arrive(n)), table, check).awaitTermination()
    assert sorted((r.side, r.TraceId, r.SpanId) for r in spark.read.parquet(table).collect()) == [("client", "2", "alone"), ("server", "3", "y")]


def test_span_metrics_windows_close_behind_the_watermark(spark, tmp_path):
    rows = [{"TimestampNs": BASE + s * SECOND, "Duration": s * 1_000_000} for s in (0, 30, 70)]
    arrive = loads(spark, tmp_path, rows, [{"TimestampNs": BASE + 100_000 * SECOND}], [{"TimestampNs": BASE}])
    table, check = str(tmp_path / "metrics"), str(tmp_path / "check")
    for n in range(3):
        stream = derived.span_metrics_stream(arrive(n), delay="10 seconds", bounds_ms=(10.0, 50.0))
        derived.to_table(stream, table, check).awaitTermination()
    made = spark.read.parquet(table).orderBy("window_start").collect()
    batch = span_metrics.span_metrics(spans_of(spark, rows), bounds_ms=(10.0, 50.0)).orderBy("window_start").collect()
    assert [tuple(r) for r in made] == [tuple(r) for r in batch]


def test_service_graph_pairs_expire(spark, tmp_path):
    client = {"SpanId": "c", "SpanKind": "SPAN_KIND_CLIENT", "ServiceName": "a"}
    server = {"ParentSpanId": "c", "SpanKind": "SPAN_KIND_SERVER", "ServiceName": "b"}
    rows = [
        {**client, "TraceId": "near", "TimestampNs": BASE}, {**server, "TraceId": "near", "SpanId": "x", "TimestampNs": BASE + SECOND},
        {**client, "TraceId": "far", "TimestampNs": BASE}, {**server, "TraceId": "far", "SpanId": "y", "TimestampNs": BASE + 2 * SECOND},
        {**client, "TraceId": "", "TimestampNs": BASE}, {**server, "TraceId": "", "SpanId": "z", "TimestampNs": BASE},
    ]
    arrive = loads(spark, tmp_path, rows)
    table = str(tmp_path / "pairs")
    stream = derived.service_graph_pairs_stream(arrive(0), ttl="1 second")
    derived.to_table(stream, table, str(tmp_path / "check")).awaitTermination()
    edges = derived.edges_of(spark.read.parquet(table)).collect()
    assert [(e.client, e.server, e.calls, e.failed) for e in edges] == [("a", "b", 1, 0)]


def test_traces_close_after_a_quiet_gap(spark, tmp_path):
    rows = [{"TraceId": "a", "TimestampNs": BASE + s * SECOND} for s in (0, 10, 100)]
    arrive = loads(spark, tmp_path, rows, [{"TraceId": "z", "TimestampNs": BASE + 100_000 * SECOND}])
    table, check = str(tmp_path / "traces"), str(tmp_path / "check")
    for n in range(2):
        derived.to_table(derived.group_by_trace_stream(arrive(n), gap="30 seconds", delay="1 second"), table, check).awaitTermination()
    made = sorted((r.TraceId, r.span_count, r.StartNs - BASE) for r in spark.read.parquet(table).collect())
    assert made == [("a", 1, 100 * SECOND), ("a", 2, 0)]
