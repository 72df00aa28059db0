"""Headline queries over stored tables: one JSON line.

The messages, spans and logs of the test folder are first written as tables; these writes and
the flattening are timed too. Every query then runs once to warm up and three times for the
median, into a sink that reads every row.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.views import Views  # noqa: E402
from telesift.operators import bounds, documents, logs as log_ops, metrics, sampling, span_metrics, spans as span_ops  # noqa: E402
from telesift.plans import trace_search as ts  # noqa: E402
from telesift.session import scratch_path  # noqa: E402
from telesift.sources import otlp, tables  # noqa: E402
from telesift.sources.loads import load_spans  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    views = Views(spark, SF_DIR)
    # The derived views once as plain files, so that no query times their making.
    raw = {}
    for name in ("spans", "logs", "doc_logs", "sum", "trace_messages", "log_messages"):
        raw[name] = scratch_path(spark, f"raw-{name}")
        rows = getattr(views, name)
        spread = rows.repartition(int(CPUS) * 2)
        if name.endswith("messages"):
            spread.write.text(raw[name])
        else:
            spread.write.parquet(raw[name])
    plain = {name: spark.read.parquet(path) for name, path in raw.items() if not name.endswith("messages")}
    spans_table, logs_table, bounds_table = (scratch_path(spark, n) for n in ("spans", "logs", "bounds"))
    seconds: dict[str, float] = {}

    def write_spans() -> None:
        tables.write_spans(plain["spans"], scratch_path(spark, "warm"), promote={"SpanAttributes": ["k"]})

    timed(write_spans)
    seconds["write_spans"] = timed(lambda: tables.write_spans(plain["spans"], spans_table, promote={"SpanAttributes": ["k"]}))
    seconds["write_logs"] = timed(lambda: tables.write_logs(plain["logs"], logs_table))
    tables.write_bounds(bounds.trace_bounds(plain["spans"]), bounds_table)
    # Messages to spans and bounds on disk, as Store.load_traces does it: parse, judge, write, once warm.
    for n in range(2):
        loaded = scratch_path(spark, "loaded")
        messages = otlp.read_otlp_json(spark, raw["trace_messages"], "traces")
        seconds["load_traces"] = timed(lambda: load_spans(messages, f"{loaded}/spans", f"{loaded}/bounds", {}, n))  # noqa: B023
    spans, logs, stored_bounds = (tables.read_table(spark, p) for p in (spans_table, logs_table, bounds_table))

    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
    search = ts.TraceQuery(service_name="svc-click", start=start, end=end)
    recent = ts.TraceQuery(service_name="svc-view", start=start, end=end, num_traces=200)
    trace_id = spans.filter("TraceId <> ''").select("TraceId").first()["TraceId"]
    queries = {
        "flatten_spans": lambda: otlp.flatten_spans(otlp.read_otlp_json(spark, raw["trace_messages"], "traces")),
        "flatten_logs": lambda: otlp.flatten_logs(otlp.read_otlp_json(spark, raw["log_messages"], "logs")),
        "get_trace_pruned": lambda: ts.get_trace_pruned(spans, stored_bounds, trace_id),
        "search_traces_by_matches": lambda: ts.search_traces_by_matches(spans, search, stored_bounds),
        "search_spans_recent": lambda: ts.search_spans_recent(spans, stored_bounds, recent),
        "trace_summaries": lambda: span_ops.trace_summaries(spans),
        "services_latest": lambda: span_ops.services_latest(spans),
        "operations_top": lambda: span_ops.operations_top(spans),
        "spans_with_attribute": lambda: span_ops.spans_with_attribute(spans, "svc-click", "k", "42", start, limit=None),
        "service_graph": lambda: span_metrics.service_graph(spans),
        "span_metrics": lambda: span_metrics.span_metrics(spans),
        "tail_sample": lambda: sampling.tail_sample(spans, sampling.TailPolicy(has_error=True)),
        "severity_series": lambda: log_ops.severity_series(logs, start),
        "logs_has_token": lambda: log_ops.logs_has_token(plain["doc_logs"], "the", limit=None),
        "logs_json_number": lambda: log_ops.logs_json_number(logs, "$.k", ">", 50, start, limit=None),
        "cumulative_to_delta": lambda: metrics.cumulative_to_delta(plain["sum"]),
        "encode_span_documents": lambda: documents.encode_span_documents(spans).select("document"),
    }
    for name, build in queries.items():
        drain(build())
        seconds[name] = statistics.median(timed(lambda: drain(build())) for _ in range(RUNS))
    span_rows, log_rows = plain["spans"].count(), plain["logs"].count()
    cores = int(CPUS)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows_per_second_per_core": {
            "flatten_spans": round(span_rows / seconds["flatten_spans"] / cores),
            "flatten_logs": round(log_rows / seconds["flatten_logs"] / cores),
            "load_traces": round(span_rows / seconds["load_traces"] / cores),
            "write_spans": round(span_rows / seconds["write_spans"] / cores),
            "write_logs": round(log_rows / seconds["write_logs"] / cores),
            "logs_has_token": round(plain["doc_logs"].count() / seconds["logs_has_token"] / cores),
            "severity_series": round(log_rows / seconds["severity_series"] / cores),
        },
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
