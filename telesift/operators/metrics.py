"""Metric points and operators that derive metrics from metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from telesift.functions import maps, times
from telesift.operators.spans import first_rows
from telesift.sources.tables import attribute_equals

# Cumulative aggregation temporality, delta temporality.
DELTA = 1
CUMULATIVE = 2


def metric_points(
    table: DataFrame, name: str, attributes: dict[str, str] | None = None, limit: int | None = None
) -> DataFrame:
    """Points of one metric, of the series that carry all given attributes."""
    rows = table.filter(F.col("MetricName") == name)
    for key, value in (attributes or {}).items():
        rows = rows.filter(attribute_equals(rows, ["Attributes"], key, value))
    return first_rows(rows, limit, "TimeUnixNs", maps.attributes_id(F.col("Attributes")))


#: What tells series of one metric apart, besides the ids of their attributes and resources.
IDENTITY = ("MetricName", "MetricUnit", "ScopeName", "ScopeVersion")


def _identity(points: DataFrame, *but: str) -> list[str]:
    return [c for c in IDENTITY if c in points.columns and c not in but]


def _series(points: DataFrame) -> DataFrame:
    return points.withColumns(
        {
            "attributes_id": maps.attributes_id(F.col("Attributes")),
            "resource_id": maps.attributes_id(F.col("ResourceAttributes")),
        }
    )


def with_previous(
    rows: DataFrame, keys: list[str], at: str, values: list[str], bucket: int, tie: str | None = None
) -> DataFrame:
    """Adds `previous`, the struct (at, values) of the row before in the group, NULL for the first.

    A lag() over the whole group would sort one hot group in a single task. Instead rows are
    windowed per (group, bucket of `at`); the last row of each bucket, found on the map side,
    is carried into the group's next bucket that has rows.
    """
    order = [at] + ([tie] if tie else [])
    state = F.struct(*order, *[v for v in values if v not in order])
    bucketed = rows.withColumn("_bucket", times.floor_div(F.col(at), bucket))
    last = bucketed.groupBy(*keys, "_bucket").agg(F.max(state).alias("_last"))
    by_bucket = W.partitionBy(*keys).orderBy("_bucket")
    carried = (
        last.select(*keys, "_bucket", F.lag("_last").over(by_bucket).alias("_state"))
        .filter(F.col("_state").isNotNull())
        .withColumn("_carried", F.lit(True))
    )
    own = bucketed.withColumns({"_state": state, "_carried": F.lit(False)})
    both = own.unionByName(carried, allowMissingColumns=True)
    in_bucket = W.partitionBy(*keys, "_bucket").orderBy(F.col("_carried").desc(), "_state")
    return (
        both.withColumn("previous", F.lag("_state").over(in_bucket))
        .filter(~F.col("_carried"))
        .drop("_bucket", "_state", "_carried")
    )


def cumulative_to_delta(points: DataFrame, bucket_ns: int = 600 * times.NS_PER_SECOND) -> DataFrame:
    """Monotonic cumulative sums to deltas per series; all other points pass unchanged.

    A value below its predecessor, or one counted from a later start than the predecessor's, is a reset and counts
    whole; the first point of a series, which has nothing to compare with, gives none. The delta starts where the last
    point ended.
    """
    monotonic = (F.col("AggTemp") == CUMULATIVE) & F.col("IsMonotonic")
    keys = [*_identity(points), "attributes_id", "resource_id"]
    rows = with_previous(
        _series(points.filter(monotonic)), keys, "TimeUnixNs", ["TimeUnixNs", "Value", "StartTimeUnixNs"], bucket_ns, tie="Value"
    )
    before = F.col("previous.Value")
    restarted = (F.col("Value") < before) | (F.col("StartTimeUnixNs") > F.col("previous.StartTimeUnixNs"))
    deltas = rows.filter(F.col("previous").isNotNull()).withColumns(
        {
            "Value": F.when(restarted, F.col("Value")).otherwise(F.col("Value") - before),
            "StartTimeUnixNs": F.col("previous.TimeUnixNs"),
            "StartTimeUnix": times.ns_to_timestamp(F.col("previous.TimeUnixNs")),
            "AggTemp": F.lit(DELTA),
        }
    )
    others = points.filter(~F.coalesce(monotonic, F.lit(False)))
    return deltas.select(*points.columns).unionByName(others)


def delta_to_rate(points: DataFrame) -> DataFrame:
    """Delta sums to rates per second, `Rate`; an interval of no length has none."""
    seconds = (F.col("TimeUnixNs") - F.col("StartTimeUnixNs")) / F.lit(times.NS_PER_SECOND)
    return points.filter(F.col("AggTemp") == DELTA).withColumn(
        "Rate", F.when(seconds > 0, F.col("Value") / seconds)
    )


def _combine(operation: str, a: Column, b: Column) -> Column:
    nonzero = F.when(b != 0, b)
    return {
        "add": lambda: a + b,
        "subtract": lambda: a - b,
        "multiply": lambda: a * b,
        "divide": lambda: a / nonzero,
        "percent": lambda: a / nonzero * 100,
    }[operation]()


def derive_metric(points: DataFrame, name: str, first: str, second: str, operation: str) -> DataFrame:
    """A new metric from two, per time, attributes, resource and scope that both have.

    One combining aggregation instead of a join. Points of one metric that repeat a key are added up: they are parts of
    what was measured then.
    """
    value = {n: F.sum(F.when(F.col("MetricName") == n, F.col("Value"))) for n in (first, second)}
    scope = _identity(points, "MetricName", "MetricUnit")
    paired = (
        _series(points.filter(F.col("MetricName").isin(first, second)))
        .groupBy("TimeUnixNs", "attributes_id", "resource_id", *scope)
        .agg(
            value[first].alias("a"),
            value[second].alias("b"),
            F.any_value("Attributes").alias("Attributes"),
            F.any_value("ResourceAttributes").alias("ResourceAttributes"),
        )
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    )
    return paired.select(
        F.lit(name).alias("MetricName"),
        "ResourceAttributes",
        *scope,
        "Attributes",
        "TimeUnixNs",
        times.ns_to_timestamp(F.col("TimeUnixNs")).alias("TimeUnix"),
        _combine(operation, F.col("a"), F.col("b")).alias("Value"),
    )


def scale_metric(points: DataFrame, name: str, source: str, factor: float) -> DataFrame:
    """A new metric that is another times a factor."""
    return points.filter(F.col("MetricName") == source).withColumns(
        {"MetricName": F.lit(name), "Value": F.col("Value") * F.lit(factor)}
    )


def transform_metrics(
    points: DataFrame, rename: dict[str, str] | None = None, keep_labels: list[str] | None = None, agg: str = "sum"
) -> DataFrame:
    """Rename metrics; with `keep_labels`, aggregate the other labels away per time, resource and scope."""
    if rename:
        names = F.create_map(*[F.lit(part) for pair in rename.items() for part in pair])
        points = points.withColumn("MetricName", F.coalesce(names[F.col("MetricName")], "MetricName"))
    if keep_labels is None:
        return points
    how = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}[agg]
    kept = points.withColumn("Attributes", maps.only_keys(F.col("Attributes"), keep_labels))
    return kept.groupBy(*_identity(points), "TimeUnixNs", "ResourceAttributes", "Attributes").agg(how("Value").alias("Value"))
