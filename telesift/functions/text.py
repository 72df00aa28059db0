"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what ends a token, all ASCII characters but letters and digits.
_SEPARATOR = r"[\x00-\x7F&&[^A-Za-z0-9]]"


def strip_control(text: Column) -> Column:
    """Text without carriage returns and line feeds."""
    return F.translate(text, "\r\n", "")


def has_token(text: Column, token: str) -> Column:
    """Whether a whole, case-sensitive token occurs; `contains` first, as it is far cheaper."""
    if not token or not re.fullmatch(r"[A-Za-z0-9]+|[^\x00-\x7F]+|(?:[A-Za-z0-9]|[^\x00-\x7F])+", token):
        raise ValueError("a token is one or more letters or digits without ASCII separators")
    pattern = f"(?:^|{_SEPARATOR}){token}(?:$|{_SEPARATOR})"
    return text.contains(token) & text.rlike(f"(?s){pattern}")


# Fixed value: the characters that JSON strings escape.
_ESCAPED = r'[\x00-\x1F"\\]'


def json_string(text: Column) -> Column:
    """A string as a JSON string literal; the JSON writer is only called where there is something to escape."""
    quoted = F.btrim(F.to_json(F.array(text)), F.lit("[]"))
    return F.when(text.rlike(_ESCAPED), quoted).when(text.isNotNull(), F.concat(F.lit('"'), text, F.lit('"')))


def json_number(body: Column, path: str) -> Column:
    """Number at a JSON path; missing or not a number counts as 0."""
    return F.coalesce(F.get_json_object(body, path).try_cast("double"), F.lit(0.0))


def double_text_sql(value: str) -> str:
    """SQL for the shortest decimal text of a double: `0`, `1.5`, exponents only below 1e-6 and from 1e21 on."""
    java, size = f"CAST({value} AS STRING)", f"abs({value})"
    exponent = f"substring_index({java}, 'E', -1)"
    scientific = (
        f"concat(regexp_replace(substring_index({java}, 'E', 1), '[.]0$', ''), 'e',"
        f" if(startswith({exponent}, '-'), '', '+'), {exponent})"
    )
    return f"""CASE WHEN {value} IS NULL THEN NULL WHEN isnan({value}) THEN 'NaN'
        WHEN {size} = double('Infinity') THEN if({value} > 0, '+Inf', '-Inf') WHEN {value} = 0 THEN '0'
        WHEN {size} >= 1e21 OR {size} < 1e-6 THEN {scientific}
        WHEN {value} % 1 = 0 THEN CAST(try_cast({java} AS DECIMAL(38,0)) AS STRING)
        ELSE rtrim('0', CAST(try_cast({java} AS DECIMAL(38,22)) AS STRING)) END"""


def json_string_sql(value: str) -> str:
    """SQL for json_string."""
    quoted = f"btrim(to_json(array({value})), '[]')"
    return f"""CASE WHEN {value} RLIKE r'{_ESCAPED}' THEN {quoted} WHEN {value} IS NOT NULL THEN concat('"', {value}, '"') END"""


def number_value(int_text: Column, double: Column) -> Column:
    """A point's value as double: the double, else the integer cast, else 0.0."""
    return F.coalesce(double, int_text.try_cast("double"), F.lit(0.0))
