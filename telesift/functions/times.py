"""Nanosecond times and durations. The session time zone must be UTC (see session.configure)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

NS_PER_SECOND = 1_000_000_000


def floor_div(value: Column, by: int) -> Column:
    """Integer division rounding down, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def moment(value) -> Column:
    """A time given as a Column, a datetime or a text; a datetime without a zone is UTC, whatever the machine's is."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value).cast("timestamp")


def timestamp_to_ns(ts: Column) -> Column:
    return F.unix_micros(ts) * 1000


def ns_to_timestamp(ns: Column) -> Column:
    return F.timestamp_micros(floor_div(ns, 1000))


def format_ns(ns: Column) -> Column:
    """UTC text with nine fraction digits, `yyyy-MM-ddTHH:mm:ss.nnnnnnnnnZ`."""
    whole = F.date_format(F.timestamp_seconds(floor_div(ns, NS_PER_SECOND)), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.lpad(F.pmod(ns, F.lit(NS_PER_SECOND)).cast("string"), 9, "0")
    return F.concat(whole, F.lit("."), fraction, F.lit("Z"))


def parse_ns(text: Column) -> Column:
    """Nanoseconds of a UTC time text with up to nine fraction digits; NULL where it is none."""
    parts = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?Z$"
    whole = F.try_to_timestamp(F.regexp_extract(text, parts, 1), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    fraction = F.rpad(F.regexp_extract(text, parts, 2), 9, "0").cast("bigint")
    return F.unix_seconds(whole) * NS_PER_SECOND + fraction


def interval_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned interval a timestamp falls in."""
    return F.timestamp_seconds(floor_div(F.unix_seconds(ts), seconds) * seconds)


def _with_fraction(whole: Column, rest: Column, digits: int) -> Column:
    fraction = F.rtrim(F.lpad(rest.cast("string"), digits, "0"), F.lit("0"))
    return F.concat(whole.cast("string"), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)))


def format_duration(ns: Column) -> Column:
    """Duration text such as `0s`, `1.5µs`, `215ms`, `1.5s`, `2m3s`, `1h0m0s`."""
    size = F.abs(ns)
    seconds = floor_div(size, NS_PER_SECOND)
    minutes = floor_div(seconds, 60)
    hours = floor_div(minutes, 60)
    second_part = F.concat(
        _with_fraction(F.pmod(seconds, F.lit(60)), F.pmod(size, F.lit(NS_PER_SECOND)), 9), F.lit("s")
    )
    minute_part = F.concat(F.pmod(minutes, F.lit(60)).cast("string"), F.lit("m"), second_part)
    text = (
        F.when(size == 0, F.lit("0s"))
        .when(size < 1000, F.concat(size.cast("string"), F.lit("ns")))
        .when(size < 1_000_000, F.concat(_with_fraction(floor_div(size, 1000), F.pmod(size, F.lit(1000)), 3), F.lit("µs")))
        .when(
            size < NS_PER_SECOND,
            F.concat(_with_fraction(floor_div(size, 1_000_000), F.pmod(size, F.lit(1_000_000)), 6), F.lit("ms")),
        )
        .when(minutes == 0, second_part)
        .when(hours == 0, minute_part)
        .otherwise(F.concat(hours.cast("string"), F.lit("h"), minute_part))
    )
    return F.when(ns < 0, F.concat(F.lit("-"), text)).otherwise(text)
