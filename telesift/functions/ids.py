"""Trace and span ids."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TRACE_ID_CHARS = 32
SPAN_ID_CHARS = 16


def _blank_if_zero(text: Column) -> Column:
    return F.when(F.translate(text, "0", "") == "", F.lit("")).otherwise(text)


def hex_id(raw: Column) -> Column:
    """Binary id as lower-case hex; empty or all-zero gives ''."""
    return _blank_if_zero(F.lower(F.coalesce(F.hex(raw), F.lit(""))))


def normal_id(text: Column) -> Column:
    """Hex text id in lower case; missing or all-zero gives ''."""
    return _blank_if_zero(F.lower(F.coalesce(text, F.lit(""))))


def _u64(hex16: Column) -> Column:
    return F.conv(hex16, 16, 10).cast("decimal(20,0)")


def _hex16(number: Column) -> Column:
    return F.lpad(F.lower(F.conv(number.cast("decimal(20,0)").cast("string"), 10, 16)), 16, "0")


def trace_id_to_u64_pair(trace_id: Column) -> Column:
    """Hex trace id as struct(high, low) of unsigned 64-bit numbers, big-endian."""
    padded = F.lpad(trace_id, TRACE_ID_CHARS, "0")
    return F.struct(
        _u64(F.substring(padded, 1, 16)).alias("high"), _u64(F.substring(padded, 17, 16)).alias("low")
    )


def u64_pair_to_trace_id(high: Column, low: Column) -> Column:
    return F.concat(_hex16(high), _hex16(low))


def span_id_to_u64(span_id: Column) -> Column:
    return _u64(F.lpad(span_id, SPAN_ID_CHARS, "0"))


def u64_to_span_id(number: Column) -> Column:
    return _hex16(number)


# Fixed values of the 64-bit FNV-1a hash.
FNV_OFFSET = 14695981039346656037
FNV_PRIME = 1099511628211


def _fnv1a_hex():
    """The hash as an Arrow UDF; it is made here, whole, so that executors need no module of ours."""

    def digest(value: str) -> str:
        state = FNV_OFFSET
        for byte in value.encode("utf-8"):
            state = ((state ^ byte) * FNV_PRIME) & 0xFFFFFFFFFFFFFFFF
        return format(state, "x")

    def digests(values: pd.Series) -> pd.Series:
        return values.map(digest, na_action="ignore")

    return F.pandas_udf(digests, StringType())


def service_operation_id(service: Column, operation: Column) -> Column:
    """FNV-1a 64 of service and operation, in hex without padding. An Arrow UDF: use on distinct pairs."""
    return _fnv1a_hex()(F.concat(service, operation))
