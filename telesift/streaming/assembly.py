"""Operators with state of their own: traces put together, and operations announced once per time to live.

State is kept in RocksDB, key by key; what a key holds is bounded here, and timers or a time to live remove it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from telesift.functions import ids
from telesift.operators import catalog

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIELDS = {
    "TimestampNs": "bigint", "SpanId": "string", "ParentSpanId": "string", "SpanName": "string", "SpanKind": "string",
    "ServiceName": "string", "Duration": "bigint", "StatusCode": "string",
}
_SPANS = f"array<struct<{', '.join(f'{n}: {k}' for n, k in _FIELDS.items())}>>"
#: Spans go through Python as texts, which only Spark writes and reads.
_TRACE = "TraceId string, part int, last boolean, span_count int, spans string"
_TRACE_NAMES = ["TraceId", "part", "last", "span_count", "spans"]
#: Buckets of traces that wait together: enough that one's traces are little to rewrite, and that many traces share a message.
BUCKETS = 1 << 14


def _by_time(span: tuple) -> tuple:
    return span[0], span[1] or ""


def _with_state(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class _Assembly(StatefulProcessor):
    """Spans (time, id, text) of the traces of one bucket, each until it has been quiet for a gap; of a trace at most `most` wait.

    Every call on state, and every frame, is a message to Spark and back; so a bucket's traces are read, written and woken at once.
    """

    def __init__(self, gap_ms: int, most: int):
        self.gap_ns, self.most = gap_ms * 1_000_000, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", "timer bigint, traces binary")

    def _waiting(self) -> tuple[int | None, dict[str, tuple[int, int, bytes]]]:
        """(the timer; of each trace its part, when to look at it again, and its packed spans)."""
        held = self.state.get()
        return (None, {}) if held is None else (held[0], pickle.loads(held[1]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timer, waiting = self._waiting()
        yield from self._frames(self._taken(waiting, rows, timerValues.getCurrentWatermarkInMs()))
        self._keep(timer, waiting)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, waiting = self._waiting()
        yield from self._frames(self._woken(waiting, timerValues.getCurrentWatermarkInMs()))
        # Spark deletes the timer that expired.
        self._keep(None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer, waiting)

    def _taken(self, waiting: dict, rows: Iterator[pd.DataFrame], watermark_ms: int) -> Iterator[tuple]:
        """Add spans to their traces; what these give."""
        parts: dict[str, int] = {}
        spans: dict[str, list[tuple]] = {}
        for frame in rows:
            ids = frame["TraceId"].tolist()
            for trace in set(ids):
                if trace not in spans:
                    parts[trace], _, packed = waiting.get(trace, (0, 0, None))
                    spans[trace] = pickle.loads(packed) if packed else []
            for trace, *span in zip(ids, *(frame[name].tolist() for name in ("TimestampNs", "SpanId", "span"))):
                spans[trace].append(tuple(span))
            for trace in set(ids):
                # A giant trace goes out in parts while it lasts.
                if len(spans[trace]) >= self.most:
                    spans[trace].sort(key=_by_time)
                    while len(spans[trace]) >= self.most:
                        yield trace, parts[trace], False, spans[trace][: self.most]
                        spans[trace], parts[trace] = spans[trace][self.most :], parts[trace] + 1
        for trace in spans:
            yield from self._close(waiting, trace, spans[trace], parts[trace], watermark_ms)

    def _woken(self, waiting: dict, watermark_ms: int) -> Iterator[tuple]:
        for trace, (part, wake, packed) in list(waiting.items()):
            if wake <= watermark_ms:
                yield from self._close(waiting, trace, pickle.loads(packed), part, watermark_ms)

    def _close(self, waiting: dict, trace: str, spans: list[tuple], part: int, watermark_ms: int) -> Iterator[tuple]:
        """Emit the runs of spans that are quiet by now, keep the rest, and wake up when the first of those may be."""
        spans.sort(key=_by_time)
        cut = 0
        for i in range(1, len(spans) + 1):
            if i == len(spans) or spans[i][0] - spans[i - 1][0] >= self.gap_ns:
                if spans[i - 1][0] + self.gap_ns > watermark_ms * 1_000_000:
                    break
                yield trace, part, True, spans[cut:i]
                cut, part = i, 0
        rest = spans[cut:]
        if not rest:
            # Parts of a trace that went out already say that more may come.
            if part:
                yield trace, part, True, []
            waiting.pop(trace, None)
            return
        end = next((rest[i - 1][0] for i in range(1, len(rest)) if rest[i][0] - rest[i - 1][0] >= self.gap_ns), rest[-1][0])
        waiting[trace] = part, (end + self.gap_ns) // 1_000_000 + 1, pickle.dumps(rest)

    def _keep(self, timer: int | None, waiting: dict) -> None:
        wake = min((wake for _, wake, _ in waiting.values()), default=None)
        if timer != wake:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wake is not None:
                self.handle.registerTimer(wake)
        if waiting:
            self.state.update((wake, pickle.dumps(waiting)))
        else:
            self.state.clear()

    def _frames(self, found: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        """What traces give, in frames of few more than `most` spans."""
        rows, held = [], 0
        for trace, part, last, spans in found:
            rows.append((trace, part, last, len(spans), f"[{','.join(s[2] for s in spans)}]"))
            held += len(spans)
            if held >= self.most:
                yield pd.DataFrame(rows, columns=_TRACE_NAMES)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=_TRACE_NAMES)

    def close(self) -> None:
        pass


def assemble_traces_stream(
    spans: DataFrame, gap_ms: int = 30_000, delay: str = "10 minutes", max_spans: int = 10_000, buckets: int = BUCKETS
) -> DataFrame:
    """(TraceId, part, last, span_count, Spans): a trace's spans in order, once none came for the gap.

    A trace with more than `max_spans` spans that aren't quiet yet goes out in parts of that many while it lasts; `last` marks
    the one after which it was quiet. No more than that many wait for a trace, whatever its size. Traces share state by
    buckets of their ids: a batch reads and writes those of the buckets that it has spans for. Their number is fixed once a stream runs.
    """
    _with_state(spans)
    span = F.to_json(F.struct(*[F.col(name).cast(kind).alias(name) for name, kind in _FIELDS.items()]))
    bucket = F.pmod(F.xxhash64("TraceId"), F.lit(buckets)).cast("int").alias("bucket")
    rows = spans.filter(F.col("TraceId") != "").select(bucket, "TraceId", "Timestamp", "TimestampNs", "SpanId", span.alias("span"))
    keyed = rows.withWatermark("Timestamp", delay).groupBy("bucket")
    made = keyed.transformWithStateInPandas(_Assembly(gap_ms, max_spans), _TRACE, "append", "eventTime")
    return made.select("TraceId", "part", "last", "span_count", F.from_json("spans", _SPANS).alias("Spans"))


class _Announced(StatefulProcessor):
    """A pair's first row, and again one that is `ttl` or more after the last that came out."""

    def __init__(self, ttl_ms: int, forget: bool):
        self.ttl_ms, self.forget = ttl_ms, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        # What hasn't been written for twice the time is forgotten by the store; it would be written again anyway.
        self.written = handle.getValueState("written", "at bigint", ttlDurationMs=2 * self.ttl_ms if self.forget else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(frame["at"].max()) for frame in rows)
        if not self.written.exists() or newest >= self.written.get()[0] + self.ttl_ms * 1000:
            self.written.update((newest,))
            yield pd.DataFrame({"serviceName": [key[0]], "operationName": [key[1]], "at": [newest]})

    def close(self) -> None:
        pass


def _newest_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per pair of a batch of rows, before anything is shuffled."""
    for batch in batches:
        yield batch.groupby(["serviceName", "operationName"], as_index=False, dropna=False).max()


def service_operations_stream(spans: DataFrame, ttl_ms: int = 12 * 3_600_000, forget: bool = True) -> DataFrame:
    """(id, serviceName, operationName, Timestamp): each pair when it first comes, and again when it was last written `ttl_ms` ago.

    Rows of a pair are combined in the tasks that read them, so that a hot service is a few rows a task; per pair one time is
    state. No row is too late, as nothing waits for a watermark. With `forget` the store drops pairs by the clock; such a query
    never comes to an end by itself, so runs over the present input only must do without and keep a time for every pair.
    """
    _with_state(spans)
    pairs = spans.filter(~catalog.has_no_service(spans)).select(
        F.col("ServiceName").alias("serviceName"), F.col("SpanName").alias("operationName"), F.unix_micros("Timestamp").alias("at")
    )
    combined = pairs.mapInPandas(_newest_of_batch, pairs.schema).groupBy("serviceName", "operationName")
    made = combined.transformWithStateInPandas(
        _Announced(ttl_ms, forget), "serviceName string, operationName string, at bigint", "append", "processingTime" if forget else "none"
    )
    return made.select(
        ids.service_operation_id(F.col("serviceName"), F.col("operationName")).alias("id"), "serviceName", "operationName",
        F.timestamp_micros("at").alias("Timestamp"),
    )
