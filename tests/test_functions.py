"""Scalar functions."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telesift.functions import ids, maps, names, text, times


def values(spark, items, kind, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("x"))).collect()]


def test_double_text(spark):
    given_values = [0.0, -0.0, 1.0, 1.5, -2.25, 100.0, 1e7, 123456789.125, 1e20, 1e21, 1.5e22, 1e-6, 1.25e-5, 1e-7, 2.5e-9, 0.1]
    wanted = ["0", "0", "1", "1.5", "-2.25", "100", "10000000", "123456789.125", "100000000000000000000", "1e+21", "1.5e+22",
              "0.000001", "0.0000125", "1e-7", "2.5e-9", "0.1"]
    assert values(spark, given_values, "double", lambda x: F.expr(text.double_text_sql("x"))) == wanted
    odd = values(spark, [math.nan, math.inf, -math.inf, None], "double", lambda x: F.expr(text.double_text_sql("x")))
    assert odd == ["NaN", "+Inf", "-Inf", None]


def test_number_value(spark):
    rows = spark.createDataFrame([("10", None), (None, 20.0), (None, None), ("x", None)], "i string, d double")
    assert [r[0] for r in rows.select(text.number_value(F.col("i"), F.col("d"))).collect()] == [10.0, 20.0, 0.0, 0.0]


def test_ids(spark):
    raw = [b"\x01\x02", b"\x00\x00", b"", None]
    assert values(spark, [None if r is None else bytearray(r) for r in raw], "binary", ids.hex_id) == ["0102", "", "", ""]
    assert values(spark, ["AB01", "0000", None], "string", ids.normal_id) == ["ab01", "", ""]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50))
def test_u64_round_trip(spark, numbers):
    from decimal import Decimal

    numbers = numbers + [0, 1, 2**63, 2**64 - 1]
    back = values(spark, [Decimal(n) for n in numbers], "decimal(20,0)", lambda x: ids.span_id_to_u64(ids.u64_to_span_id(x)))
    assert back == [Decimal(n) for n in numbers]


def test_trace_id_halves(spark):
    # High and low halves with known bytes.
    pair = spark.sql("select 66049 as h, 257 as l")
    assert pair.select(ids.u64_pair_to_trace_id(F.col("h"), F.col("l"))).first()[0] == "00000000000102010000000000000101"


def test_names(spark):
    assert values(spark, ["0", "2", "5", "6", None, "SPAN_KIND_CLIENT"], "string", names.span_kind_name) == [
        "SPAN_KIND_UNSPECIFIED", "SPAN_KIND_SERVER", "SPAN_KIND_CONSUMER", "", "SPAN_KIND_UNSPECIFIED", "SPAN_KIND_CLIENT"]
    assert values(spark, [0, 1, 2, 3], "int", names.status_code_name) == [
        "STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR", ""]
    assert values(spark, ["STATUS_CODE_ERROR", "", None], "string", names.status_code_number) == [2, 0, 0]
    assert values(spark, [99, 100, 398, 399, 500], "int", names.status_from_http) == [
        "STATUS_CODE_ERROR", "STATUS_CODE_UNSET", "STATUS_CODE_UNSET", "STATUS_CODE_ERROR", "STATUS_CODE_ERROR"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**62), 2**62), min_size=1, max_size=20))
def test_times(spark, ns):
    ns = [*ns, 0, 1, -1]
    epoch = dt.datetime(1970, 1, 1)
    wanted = [(epoch + dt.timedelta(seconds=n // 10**9)).strftime("%4Y-%m-%dT%H:%M:%S") + f".{n % 10**9:09d}Z" for n in ns]
    texts = values(spark, ns, "bigint", times.format_ns)
    assert texts == wanted
    assert values(spark, texts, "string", times.parse_ns) == ns


def test_times_of_other_texts(spark):
    second = int(dt.datetime(2031, 8, 17, 22, 41, 9, tzinfo=dt.timezone.utc).timestamp()) * 10**9
    assert values(spark, ["2031-08-17T22:41:09.25Z", "2031-08-17T22:41:09Z", "nonsense"], "string", times.parse_ns) == [second + 250_000_000, second, None]


@pytest.mark.parametrize("ns, wanted", [
    (0, "0s"), (1, "1ns"), (1500, "1.5µs"), (215_000_000, "215ms"), (1_500_000_000, "1.5s"), (123_000_000_000, "2m3s"),
    (3_600_000_000_000, "1h0m0s"), (40_500_007, "40.500007ms"), (-2_000_000_000, "-2s"), (90_061_000_000_001, "25h1m1.000000001s"),
])
def test_format_duration(spark, ns, wanted):
    assert spark.range(1).select(times.format_duration(F.lit(ns))).first()[0] == wanted


def test_maps(spark):
    row = spark.sql("select map('b', '2', 'a', '1') as m, map('a', '9') as n, cast(null as map<string,string>) as z")
    assert row.select(maps.attributes_id(F.col("m"))).first()[0] == "a:1;b:2"
    assert row.select(maps.merge_maps(F.col("m"), F.col("z"), F.col("n"))).first()[0] == {"b": "2", "a": "9"}
    assert row.select(maps.first_attribute("a", F.col("n"), F.col("m"))).first()[0] == "9"
    assert row.select(maps.first_attribute("x", F.col("n"), F.col("m"))).first()[0] is None
    assert row.select(maps.attribute(F.col("m"), "x")).first()[0] == ""


def test_tokens(spark):
    bodies = ["an error here", "errors", "error_code", "x-error", "Error", "épreuve", "éerror", "error\nnext", "error"]
    found = values(spark, bodies, "string", lambda x: text.has_token(x, "error"))
    assert found == [True, False, True, True, False, False, False, True, True]
    with pytest.raises(ValueError):
        text.has_token(F.lit("x"), "two words")


def test_text(spark):
    assert values(spark, ["a\r\nb\n"], "string", text.strip_control) == ["ab"]
    tricky = ['plain', 'quo"te', 'back\\slash', 'tab\t', 'ü', '[x]', '', None]
    import json

    assert values(spark, tricky, "string", text.json_string) == [
        None if t is None else json.dumps(t, ensure_ascii=False) for t in tricky]
    bodies = ['{"bytes": 12}', '{"bytes": "x"}', "no json", '{"other": 1}', '{"bytes": "7.5"}']
    assert values(spark, bodies, "string", lambda x: text.json_number(x, "$.bytes")) == [12.0, 0.0, 0.0, 0.0, 7.5]


def test_fnv_known_values(spark):
    # Published test vectors of the 64-bit hash.
    rows = spark.createDataFrame([("", ""), ("a", ""), ("foo", "bar"), ("", "foobar")], "s string, o string")
    made = [r[0] for r in rows.select(ids.service_operation_id(F.col("s"), F.col("o"))).collect()]
    assert made == ["cbf29ce484222325", "af63dc4c8601ec8c", "85944171f73967e8", "85944171f73967e8"]


def test_moments_are_utc_on_any_machine(spark, monkeypatch):
    import datetime as dt
    import time

    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        noon = dt.datetime(2024, 1, 1, 12)
        forms = [noon, noon.replace(tzinfo=dt.timezone.utc), "2024-01-01 12:00:00", F.lit("2024-01-01 12:00:00")]
        made = [spark.range(1).select(F.unix_seconds(times.moment(f))).first()[0] for f in forms]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert made == [1704110400] * 4
