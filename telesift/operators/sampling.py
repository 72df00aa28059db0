"""Trace-wise operators: sampling whole traces and gathering their spans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.operators.spans import in_parts
from telesift.sources.tables import attribute_equals


def _hash32(trace_id: Column, seed: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), trace_id)), 1, 8), 16, 10).cast("bigint")


def sampled(trace_id: Column, ratio: float, seed: int = 0) -> Column:
    """Whether a trace id is within the ratio; the same for every signal and run."""
    return _hash32(trace_id, seed) < int(ratio * 2**32)


def probabilistic_sample(df: DataFrame, ratio: float, seed: int = 0) -> DataFrame:
    return df.filter(sampled(F.col("TraceId"), ratio, seed))


@dataclass(frozen=True)
class TailPolicy:
    """A trace is kept if any given condition holds for it."""

    has_error: bool = False
    min_duration_ns: int | None = None
    attributes: dict[str, str] = field(default_factory=dict)
    ratio: float = 0.0
    seed: int = 0


def tail_verdicts(spans: DataFrame, policy: TailPolicy) -> DataFrame:
    """The trace ids a policy keeps. The duration is from the first start to the last end."""
    end = F.col("TimestampNs") + F.col("Duration")
    matched = F.lit(False)
    for key, value in policy.attributes.items():
        matched = matched | attribute_equals(spans, ["SpanAttributes", "ResourceAttributes"], key, value)
    facts = (
        spans.filter(F.col("TraceId") != "")
        .groupBy("TraceId")
        .agg(
            F.bool_or(F.col("StatusCode") == "STATUS_CODE_ERROR").alias("error"),
            (F.max(end) - F.min("TimestampNs")).alias("duration"),
            F.bool_or(F.coalesce(matched, F.lit(False))).alias("matched"),
        )
    )
    keep = F.col("matched")
    if policy.has_error:
        keep = keep | F.col("error")
    if policy.min_duration_ns is not None:
        keep = keep | (F.col("duration") >= policy.min_duration_ns)
    if policy.ratio > 0:
        keep = keep | sampled(F.col("TraceId"), policy.ratio, policy.seed)
    return facts.filter(keep).select("TraceId")


def tail_sample(spans: DataFrame, policy: TailPolicy) -> DataFrame:
    """All spans of the traces a policy keeps.

    Verdicts combine on the map side; a hot trace on the other side of the semi join is
    split by adaptive execution.
    """
    return spans.join(tail_verdicts(spans, policy), "TraceId", "left_semi")


def group_by_trace(spans: DataFrame, max_spans: int = 10_000) -> DataFrame:
    """The spans of a trace in one row, in order; a trace above `max_spans` in several parts."""
    parts = in_parts(spans.filter(F.col("TraceId") != ""), ["TraceId"], ["SpanId", "TimestampNs"], max_spans)
    span = F.struct(
        "TimestampNs", "SpanId", "ParentSpanId", "SpanName", "SpanKind", "ServiceName", "Duration", "StatusCode"
    )
    return (
        parts.groupBy("TraceId", "part", "parts")
        .agg(F.sort_array(F.collect_list(span)).alias("Spans"))
        .withColumn("span_count", F.size("Spans"))
    )
