"""The tables of one folder with the calls of the query interface."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telesift.operators import logs as log_ops
from telesift.operators import metrics as metric_ops
from telesift.operators import spans as span_ops
from telesift.plans import trace_search as ts
from telesift.plans.log_search import LogQuery, search_logs
from telesift.session import configure
from telesift.sources import tables
from telesift.sources.loads import load_records, load_spans


class Store:
    """Loads messages into tables below a folder and answers from them.

    Every load has a number and writes only folders with that number, so that a load run again
    replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, promote: dict[str, list[str]] | None = None):
        self.spark = configure(spark)
        self.path = path.rstrip("/")
        self.promote = promote or {}

    def _at(self, table: str) -> str:
        return f"{self.path}/{table}"

    def _promoted(self, *columns: str) -> dict[str, list[str]]:
        return {c: keys for c, keys in self.promote.items() if c in columns}

    # -- loads --
    #
    # A load parses its messages once and writes what it stores and what it refuses in one job. It returns how many of each.

    def load_traces(self, messages: DataFrame, load: int) -> dict[str, int]:
        """Spans, and after them the partial bounds of their traces, from the spans as stored.

        A load that fails in between is to be run again under its number, like any other.
        """
        return load_spans(messages, self._at("spans"), self._at("bounds"), self._promoted("SpanAttributes", "ResourceAttributes"), load)

    def load_logs(self, messages: DataFrame, load: int) -> dict[str, int]:
        return load_records(messages, "logs", self._at("logs"), self._promoted("LogAttributes", "ResourceAttributes"), load)

    def load_metrics(self, messages: DataFrame, load: int) -> dict[str, int]:
        return load_records(messages, "metrics", self._at("metrics"), self._promoted("Attributes", "ResourceAttributes"), load)

    def apply_retention(self, days: int, now: dt.datetime) -> dict[str, list[str]]:
        """Delete the days wholly older than `days` from every table, and name them."""
        there = [t for t in ("spans", "bounds", "logs", "metrics") if tables.exists(self.spark, self._at(t))]
        return {t: tables.apply_retention(self.spark, self._at(t), days, now) for t in there}

    # -- tables --

    def spans(self) -> DataFrame:
        return tables.read_table(self.spark, self._at("spans"))

    def bounds(self) -> DataFrame:
        return tables.read_table(self.spark, self._at("bounds"))

    def logs(self) -> DataFrame:
        return tables.read_table(self.spark, self._at("logs"))

    def metrics(self, kind: str) -> DataFrame:
        return tables.read_metric_table(self.spark, self._at("metrics"), kind)

    def rejected(self) -> DataFrame:
        """What no table took, in messages that can be loaded again, with the reason, by signal."""
        none = self.spark.createDataFrame([], "what string, reason string, writer string, batch_id bigint, signal string")
        for signal, table in (("traces", "spans"), ("logs", "logs"), ("metrics", "metrics")):
            if tables.exists(self.spark, self._at(table)):
                none = none.unionByName(tables.read_rejected(self.spark, self._at(table)).withColumn("signal", F.lit(signal)))
        return none

    # -- calls --

    def get_trace(self, trace_id: str) -> DataFrame:
        """All spans of a trace, from the days it touches."""
        return ts.get_trace_pruned(self.spans(), self.bounds(), trace_id, limit=None)

    def search_traces(self, query: ts.TraceQuery) -> DataFrame:
        """Summaries of the traces with most matching spans."""
        return ts.search_traces_by_matches(self.spans(), query, self.bounds())

    def search_recent_spans(self, query: ts.TraceQuery) -> DataFrame:
        """Matching spans of the newest traces."""
        return ts.search_spans_recent(self.spans(), self.bounds(), query)

    def search_logs(self, query: LogQuery) -> DataFrame:
        return search_logs(self.logs(), query)

    def get_logs(self, trace_id: str, slack: str = "1 DAY") -> DataFrame:
        """Records of a trace from the days it touches and those within `slack` of them."""
        bounds = self.bounds() if tables.exists(self.spark, self._at("bounds")) else None
        return log_ops.logs_for_trace(self.logs(), trace_id, bounds, slack)

    def get_services(self, start=None, end=None) -> DataFrame:
        """Per service its newest resource attributes; with a time range only its days are read."""
        return span_ops.services_latest(self.spans(), start, end)

    def get_operations(self, service: str | None = None, kind: str | None = None, start=None, end=None) -> DataFrame:
        return span_ops.operations(self.spans(), service, kind, start, end)

    def metric_points(
        self, kind: str, name: str, attributes: dict[str, str] | None = None, limit: int | None = None
    ) -> DataFrame:
        return metric_ops.metric_points(self.metrics(kind), name, attributes, limit)
