"""Operators on metric points."""

import random

import pytest
from pyspark.sql import functions as F

from telesift.functions import times
from telesift.operators import metrics
from telesift.schema import METRICS


def sums(spark, rows: list[tuple]):
    """Cumulative sums from (series, ns, value), and optionally temporality and monotony."""
    data = [(*r, 2, True)[:5] if len(r) == 3 else r for r in rows]
    df = spark.createDataFrame(data, "series string, ns bigint, v double, temp int, mono boolean")
    given = {
        "MetricName": F.lit("m"), "Attributes": F.create_map(F.lit("s"), F.col("series")), "ResourceAttributes": F.expr("map('host', 'h')"),
        "TimeUnixNs": F.col("ns"), "TimeUnix": times.ns_to_timestamp(F.col("ns")), "Value": F.col("v"),
        "AggTemp": F.col("temp"), "IsMonotonic": F.col("mono"),
    }
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in METRICS["sum"].fields])


def deltas(df, **how):
    rows = metrics.cumulative_to_delta(df, **how).collect()
    return sorted((r.Attributes["s"], r.StartTimeUnixNs, r.TimeUnixNs, r.Value, r.AggTemp) for r in rows)


def test_deltas_and_resets(spark):
    df = sums(spark, [("a", 10, 5.0), ("a", 20, 8.0), ("a", 30, 2.0), ("a", 40, 2.0), ("b", 15, 100.0)])
    assert deltas(df) == [("a", 10, 20, 3.0, 1), ("a", 20, 30, 2.0, 1), ("a", 30, 40, 0.0, 1)]


def test_other_sums_pass_unchanged(spark):
    df = sums(spark, [("g", 1, 5.0, 2, False), ("g", 2, 3.0, 2, False), ("d", 1, 7.0, 1, True), ("n", 1, 1.0, None, None)])
    assert sorted(r.Value for r in metrics.cumulative_to_delta(df).collect()) == [1.0, 3.0, 5.0, 7.0]


@pytest.mark.parametrize("bucket", [1, 7, 50, 10_000])
def test_deltas_do_not_depend_on_the_bucket(spark, bucket):
    """A third of all points in one series, gaps over many buckets; brute force per series."""
    rng = random.Random(3)
    rows = []
    for name, count in {"hot": 600, **{f"s{i}": 24 for i in range(50)}}.items():
        moments = rng.sample(range(5_000), count)
        rows += [(name, ns, float(rng.randrange(100))) for ns in moments]
    wanted = []
    for name in {r[0] for r in rows}:
        own = sorted((ns, v) for n, ns, v in rows if n == name)
        for (before_ns, before), (ns, v) in zip(own, own[1:]):
            wanted.append((name, before_ns, ns, v if v < before else v - before, 1))
    assert deltas(sums(spark, rows), bucket_ns=bucket) == sorted(wanted)


def test_points_at_the_same_time_are_ordered_by_value(spark):
    df = sums(spark, [("a", 10, 5.0), ("a", 10, 9.0), ("a", 20, 10.0)])
    assert deltas(df) == [("a", 10, 10, 4.0, 1), ("a", 10, 20, 1.0, 1)]


def test_rates(spark):
    df = sums(spark, [("a", 0, 1.0), ("a", 2 * times.NS_PER_SECOND, 11.0), ("a", 2 * times.NS_PER_SECOND, 12.0)])
    made = metrics.delta_to_rate(metrics.cumulative_to_delta(df)).orderBy("TimeUnixNs", "Value").collect()
    assert [r.Rate for r in made] == [None, 5.0]


def test_derived_metrics(spark):
    a = sums(spark, [("x", 1, 10.0), ("x", 2, 20.0), ("x", 2, 15.0), ("y", 1, 1.0)])
    b = sums(spark, [("x", 1, 4.0), ("x", 2, 0.0), ("z", 1, 9.0)]).withColumn("MetricName", F.lit("n"))
    both = a.unionByName(b)

    def made(operation):
        rows = metrics.derive_metric(both, "new", "m", "n", operation).orderBy("TimeUnixNs").collect()
        assert all(r.Attributes == {"s": "x"} and r.MetricName == "new" for r in rows)
        return [r.Value for r in rows]

    assert made("add") == [14.0, 35.0] and made("subtract") == [6.0, 35.0] and made("multiply") == [40.0, 0.0]
    assert made("divide") == [2.5, None] and made("percent") == [250.0, None]
    with pytest.raises(KeyError):
        made("modulo")
    assert sorted(r.Value for r in metrics.scale_metric(a, "k", "m", 0.5).collect()) == [0.5, 5.0, 7.5, 10.0]


def test_transformed_metrics(spark):
    df = sums(spark, [("x", 1, 10.0), ("y", 1, 20.0), ("x", 2, 1.0)])
    swapped = metrics.transform_metrics(df, {"m": "n", "n": "m"})
    assert {r.MetricName for r in swapped.collect()} == {"n"}
    for how, wanted in (("sum", 30.0), ("mean", 15.0), ("min", 10.0), ("max", 20.0)):
        made = metrics.transform_metrics(df, None, [], how).orderBy("TimeUnixNs").collect()
        assert [r.Value for r in made] == [wanted, 1.0] and made[0].Attributes == {}
    assert metrics.transform_metrics(df, None, ["s"]).count() == 3


def test_points_by_series(spark):
    df = sums(spark, [("x", 2, 1.0), ("x", 1, 2.0), ("y", 1, 3.0)])
    assert [r.Value for r in metrics.metric_points(df, "m", limit=2).collect()] == [2.0, 3.0]
    assert sorted(r.Value for r in metrics.metric_points(df, "m", {"s": "x"}).collect()) == [1.0, 2.0]
    assert metrics.metric_points(df, "n").count() == 0


def identified(df, **columns):
    return df.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def test_scopes_and_units_are_series_of_their_own(spark):
    df = sums(spark, [("a", 10, 1.0), ("a", 20, 2.0), ("b", 10, 100.0), ("b", 20, 200.0)])
    df = identified(df, ScopeName="Attributes['s']", Attributes="map('s', 'same')")
    assert deltas(df) == [("same", 10, 20, 1.0, 1), ("same", 10, 20, 100.0, 1)]
    units = identified(df, MetricUnit="ScopeName", ScopeName="'x'")
    assert deltas(units) == deltas(df)


def test_a_later_start_is_a_restart(spark):
    df = sums(spark, [("a", 10, 10.0), ("a", 20, 12.0), ("a", 30, 13.0)])
    df = identified(df, StartTimeUnixNs="CASE WHEN TimeUnixNs = 10 THEN 1L ELSE 15L END")
    assert deltas(df) == [("a", 10, 20, 12.0, 1), ("a", 20, 30, 1.0, 1)]


def test_derived_metrics_keep_scopes_apart_and_add_repeats(spark):
    df = sums(spark, [("a", 10, 1.0), ("a", 10, 2.0), ("b", 10, 5.0)])
    df = identified(df, ScopeName="Attributes['s']", Attributes="map('s', 'same')")
    other = df.withColumns({"MetricName": F.lit("n"), "Value": F.lit(1.0)}).dropDuplicates(["ScopeName"])
    made = metrics.derive_metric(df.unionByName(other), "r", "m", "n", "divide").collect()
    assert sorted((r.ScopeName, r.Value) for r in made) == [("a", 3.0), ("b", 5.0)]


def test_labels_are_aggregated_within_resource_and_scope(spark):
    df = sums(spark, [("a", 10, 1.0), ("b", 10, 2.0), ("c", 10, 5.0)])
    df = identified(df, ResourceAttributes="map('host', if(Attributes['s'] = 'c', 'h2', 'h1'))")
    made = metrics.transform_metrics(df, keep_labels=[]).collect()
    assert sorted((r.ResourceAttributes["host"], r.Value) for r in made) == [("h1", 3.0), ("h2", 5.0)]
