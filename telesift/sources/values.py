"""Attribute values: text forms, typed JSON, and VARIANT.

Messages are parsed with every scalar as text, so that one odd value doesn't spoil its message; arrays and maps stay raw JSON.
Whatever their depth, these are turned into plain JSON by folding over their tokens with a stack. Everything is a built-in
expression; values without arrays or maps never reach the fold.

The functions take a column as SQL text and are SQL text inside: the expressions are large, and the parser builds them far faster
than one call per node would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telesift.functions import text

# The fields of a value in the message format, and the type names they stand for.
TYPES = {
    "stringValue": "string", "boolValue": "bool", "intValue": "int64", "doubleValue": "float64", "bytesValue": "binary",
    "arrayValue": "array", "kvlistValue": "map",
}
VALUE = f"STRUCT<{', '.join(f'{name}: STRING' for name in TYPES)}>"
KVS = f"ARRAY<STRUCT<key: STRING, value: {VALUE}>>"
#: Typed attributes: the value as JSON, and its type's name.
FIELDS = "ARRAY<STRUCT<key: STRING, json: STRING, type: STRING>>"

_MEMBERS = "ARRAY<STRUCT<key: STRING, json: STRING>>"
# Field names come with their colon; commas and brackets say nothing that braces and names don't.
_TOKENS = r"""r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?+|[{}]|[^\s{}\[\]:,"]++'"""


def _frame(field: str, key: str, json: str, items: str) -> str:
    return f"named_struct('field', {field}, 'key', {key}, 'json', {json}, 'items', {items})"


def _unquoted(token: str) -> str:
    inner = f"substring({token}, 2, length({token}) - 2)"
    return f"""CASE WHEN NOT startswith({token}, '"') THEN {token} WHEN contains({token}, '\\\\') THEN from_json(concat('[', {token}, ']'), 'array<string>')[0] ELSE {inner} END"""


def _quoted(token: str) -> str:
    # A literal without escapes is written as it came.
    return f"""CASE WHEN startswith({token}, '"') AND NOT contains({token}, '\\\\') THEN {token} ELSE {text.json_string_sql(f'({_unquoted(token)})')} END"""


def _object(items: str) -> str:
    """Members by key, the last of equal ones."""
    entries = f"sort_array(map_entries(map_from_entries(transform({items}, e -> struct(coalesce(e.key, '') AS key, e.json AS value)))))"
    return f"concat('{{', array_join(transform({entries}, e -> concat({text.json_string_sql('e.key')}, ':', e.value)), ','), '}}')"


# Numbers whose text is what double_text_sql makes of them, but for a `.0` behind whole ones.
_FRACTION, _WHOLE = r"-?(?:0|[1-9]\d{0,5})\.\d{0,5}[1-9]", r"(?:-?[1-9]\d{0,14}|0)"
_NUMBERS = rf"""intValue":"?-?\d+"?|boolValue":"?(?:true|false)"?|doubleValue":"?(?:{_FRACTION}|{_WHOLE}(?:\.0)?)"?"""
# Containers written plainly, as most are: lists of lists and scalars whose texts have no brackets, maps of scalars.
_PLAIN_LIST = (
    r"""r'^\{"values":\[(?:,|\{"arrayValue":\{"values":\[|\]\}\}|\{"(?:stringValue|bytesValue)":"[^"\\\[\]{}]*+"\}|\{"(?:"""
    + _NUMBERS + r""")\})*+\]\}\z'"""
)
_PLAIN_MAP = (
    r"""r'^\{"values":\[(?:\{"key":"[^"\\]*+","value":\{"(?:(?:stringValue|bytesValue)":"[^"\\]*+"|""" + _NUMBERS + r""")\}\},?+)*+\]\}\z'"""
)
_SCALAR = r"""\{"(?:(?:stringValue|bytesValue)":("[^"]*+")|(?:intValue|boolValue|doubleValue)":"?([-.0-9a-z]+?)(?:\.0)?"?)\}"""


def _plain_list(raw: str) -> str:
    bare = f"""regexp_replace({raw}, r'{_SCALAR}', '$1$2')"""
    lists = f"""replace(replace({bare}, '{{"arrayValue":{{"values":[', '['), ']}}}}', ']')"""
    return f"""rtrim('}}', substring({lists}, 11))"""


def _plain_map(raw: str) -> str:
    found = lambda group: f"""regexp_extract_all({raw}, r'\\{{"key":"([^"]*+)","value":{_SCALAR}\\}}', {group})"""
    value = f"zip_with({found(2)}, {found(3)}, (a, b) -> concat(a, b))"
    return _object(f"zip_with({found(1)}, {value}, (k, j) -> struct(k AS key, j AS json))")


def plain_json(raw: str, is_map: str) -> str:
    """An array or a map of the message format as plain JSON text, to any depth.

    Containers that are plainly written are rewritten as text; all others are folded.
    A frame of the stack is an object that is open: the field whose value comes next, and what is known of its own value: a key
    and JSON of an item, or the items of a list. The first frame stands for the value that holds the container.
    """
    none, no_items = "CAST(NULL AS STRING)", f"CAST(array() AS {_MEMBERS})"
    top, below = "stack[0]", "get(stack, 1)"
    first = _frame(f"if({is_map}, 'kvlistValue', 'arrayValue')", none, none, no_items)
    fresh = _frame("''", none, none, no_items)
    value = f"coalesce({top}.json, 'null')"
    closed = _frame(
        f"{below}.field", f"{below}.key",
        f"""CASE {below}.field WHEN 'value' THEN {value}
            WHEN 'arrayValue' THEN concat('[', array_join({top}.items.json, ','), ']')
            WHEN 'kvlistValue' THEN {_object(f'{top}.items')} ELSE {below}.json END""",
        f"if({below}.field = 'values', concat({below}.items, array(named_struct('key', {top}.key, 'json', {value}))), {below}.items)",
    )
    named = _frame("btrim(t, ': \"\\t\\n\\r')", f"{top}.key", f"{top}.json", f"{top}.items")
    double = f"{text.double_text_sql('d')}"
    read = _frame(
        f"{top}.field",
        f"if({top}.field = 'key' AND t <> 'null', {_unquoted('t')}, {top}.key)",
        f"""CASE WHEN t = 'null' THEN {top}.json
            WHEN {top}.field IN ('stringValue', 'bytesValue') THEN {_quoted('t')}
            WHEN {top}.field IN ('intValue', 'boolValue') THEN btrim(t, '"')
            WHEN {top}.field = 'doubleValue' THEN coalesce(transform(array(try_cast(btrim(t, '"') AS DOUBLE)), d -> {double})[0], {top}.json)
            ELSE {top}.json END""",
        f"if({top}.field = 'values', concat({top}.items, array(named_struct('key', {none}, 'json', 'null'))), {top}.items)",
    )
    rest = "slice(stack, 2, size(stack))"
    step = f"""CASE WHEN t = '{{' THEN concat(array({fresh}), stack)
        WHEN t = '}}' THEN concat(array({closed}), slice(stack, 3, size(stack)))
        WHEN endswith(t, ':') THEN concat(array({named}), {rest}) ELSE concat(array({read}), {rest}) END"""
    folded = f"aggregate(regexp_extract_all({raw}, {_TOKENS}, 0), array({first}), (stack, t) -> {step}, stack -> stack[0].json)"
    written = f"""CASE WHEN NOT ({is_map}) AND {raw} RLIKE {_PLAIN_LIST} THEN {_plain_list(raw)}
        WHEN {is_map} AND {raw} RLIKE {_PLAIN_MAP} THEN {_plain_map(raw)} ELSE {folded} END"""
    return f"if({raw} IS NULL, NULL, coalesce({written}, if({is_map}, '{{}}', '[]')))"


def _nested(value: str) -> str:
    return plain_json(f"coalesce({value}.arrayValue, {value}.kvlistValue)", f"{value}.arrayValue IS NULL")


def _double(value: str) -> str:
    written = f"transform(array(try_cast({value}.doubleValue AS DOUBLE)), d -> {text.double_text_sql('d')})[0]"
    return rf"CASE WHEN {value}.doubleValue RLIKE r'^{_FRACTION}\z' THEN {value}.doubleValue ELSE {written} END"


def json_sql(value: str) -> str:
    """A value as plain JSON."""
    return f"""coalesce({text.json_string_sql(f'{value}.stringValue')}, {value}.boolValue, {value}.intValue, {_double(value)},
        {text.json_string_sql(f'{value}.bytesValue')}, {_nested(value)}, 'null')"""


def text_sql(value: str) -> str:
    """String form of a value; arrays and maps as JSON, no value as ''."""
    return f"""coalesce({value}.stringValue, {value}.boolValue, {value}.intValue, {_double(value)}, {value}.bytesValue,
        {_nested(value)}, '')"""


def type_sql(value: str) -> str:
    """Name of a value's type; NULL for none."""
    cases = " ".join(f"WHEN {value}.{name} IS NOT NULL THEN '{kind}'" for name, kind in TYPES.items())
    return f"CASE {cases} END"


def map_sql(kvs: str) -> str:
    pairs = f"transform({kvs}, a -> struct(a.key AS key, {text_sql('a.value')} AS value))"
    return f"coalesce(map_from_entries({pairs}), CAST(map() AS MAP<STRING,STRING>))"


def fields_sql(kvs: str) -> str:
    typed = f"transform({kvs}, a -> struct(a.key AS key, {json_sql('a.value')} AS json, {type_sql('a.value')} AS type))"
    return f"coalesce({typed}, CAST(array() AS {FIELDS}))"


def value_text(value: str) -> Column:
    """String form of any attribute value; arrays and maps as JSON, an empty value as ''."""
    return F.expr(text_sql(value))


def attributes_to_map(kvs: str) -> Column:
    """Attribute list to map; of equal keys the last wins, no list gives an empty map."""
    return F.expr(map_sql(kvs))


def attributes_to_fields(kvs: str) -> Column:
    """Attribute list to (key, JSON value, type) fields; for documents."""
    return F.expr(fields_sql(kvs))


def fields_to_variant(fields: str) -> Column:
    """Typed attributes as one VARIANT object, for variant_get and schema_of_variant; of equal keys the last wins.

    Numbers that JSON lacks (NaN, infinities) are text in it.
    """
    plain = f"transform({fields}, f -> struct(f.key AS key, if(f.json IN ('NaN', '+Inf', '-Inf'), concat('\"', f.json, '\"'), f.json) AS json))"
    return F.expr(f"try_parse_json({_object(plain)})")
