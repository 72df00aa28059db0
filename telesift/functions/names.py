"""Names of span kinds and status codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Protocol numbers in order.
SPAN_KINDS = (
    "SPAN_KIND_UNSPECIFIED",
    "SPAN_KIND_INTERNAL",
    "SPAN_KIND_SERVER",
    "SPAN_KIND_CLIENT",
    "SPAN_KIND_PRODUCER",
    "SPAN_KIND_CONSUMER",
)
STATUS_CODES = ("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR")


def _name(code: Column, names: tuple[str, ...]) -> Column:
    pairs = [F.lit(part) for number, name in enumerate(names) for part in (str(number), name)]
    text = F.coalesce(code.cast("string"), F.lit("0"))
    by_number = F.create_map(*pairs)[text]
    return F.when(text.isin(*names), text).otherwise(F.coalesce(by_number, F.lit("")))


def span_kind_name(code: Column) -> Column:
    """Kind number (or its name) as name; missing is UNSPECIFIED, unknown is ''."""
    return _name(code, SPAN_KINDS)


def status_code_name(code: Column) -> Column:
    """Status number (or its name) as name; missing is UNSET, unknown is ''."""
    return _name(code, STATUS_CODES)


def status_code_number(name: Column) -> Column:
    """Inverse of status_code_name; an unknown name is 0."""
    found = F.array_position(F.array(*map(F.lit, STATUS_CODES)), name)
    return F.greatest(F.coalesce(found, F.lit(0)) - 1, F.lit(0)).cast("int")


def status_from_http(code: Column) -> Column:
    """HTTP status to span status: 100 up to and without 399 is UNSET, all else ERROR."""
    return F.when((code >= 100) & (code < 399), STATUS_CODES[0]).otherwise(STATUS_CODES[2])
