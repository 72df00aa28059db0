"""Spans and log records as JSON documents.

While it is built, a document is an array of fields, struct(key, json): a dotted key and the
JSON text of its value. A NULL value means there is nothing to write. Everything is a built-in
expression except flatten_nested, which walks values of unknown depth in Arrow batches.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from telesift.functions import maps, names, text, times

FIELDS = "array<struct<key:string,json:string>>"
_EMPTY_VALUES = ("[]", "{}")


def field(key, json_text: Column) -> Column:
    name = key if isinstance(key, Column) else F.lit(key)
    return F.struct(name.alias("key"), json_text.alias("json"))


def string_value(value: Column) -> Column:
    """A string for a fixed field: an empty one is left out."""
    return F.when(value != "", text.json_string(value))


def number_value(value: Column) -> Column:
    """A number; NaN and infinities, which JSON lacks, become null."""
    as_text = value.cast("string")
    return F.when(as_text.isin("NaN", "Infinity", "-Infinity"), F.lit("null")).otherwise(as_text)


def time_value(ns: Column) -> Column:
    return text.json_string(times.format_ns(ns))


def flatten_attributes(prefix: str | Column, attrs: Column) -> Column:
    """A string map as fields below a prefix; no prefix leaves the keys as they are."""
    path = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.transform(
        F.map_entries(F.coalesce(attrs, maps.empty_map())),
        lambda e: field(F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit("."), e["key"])),
                        text.json_string(e["value"])),
    )


# ---- values of unknown depth ------------------------------------------------------------------


_FLAT = StructType([StructField("keys", ArrayType(StringType())), StructField("jsons", ArrayType(StringType()))])


def _flatten_json():
    """Objects to flat keys and values as an Arrow UDF; made whole here, so that executors need no module of ours."""

    def pairs(path, value):
        for key, item in value.items():
            below = f"{path}.{key}" if path else key
            if isinstance(item, dict):
                yield from pairs(below, item)
            elif item is not None:
                yield below, item

    def in_array(item):
        """An object inside an array: flat, deduplicated, and nested again."""
        if isinstance(item, list):
            return [in_array(i) for i in item]
        if not isinstance(item, dict):
            return item
        flat = dict(sorted(dict(pairs("", item)).items()))
        parents = {key[:i] for key in flat for i, char in enumerate(key) if char == "."}
        result = {}
        for key, value in flat.items():
            name = f"{key}.value" if key in parents else key
            if name != key and name in flat:
                continue
            *levels, leaf = name.split(".")
            level = result
            for step in levels:
                level = level.setdefault(step, {})
            level[leaf] = in_array(value)
        return result or None

    def flatten(objects: pd.Series) -> pd.DataFrame:
        rows = [list(pairs("", json.loads(raw))) if raw else [] for raw in objects]
        texts = [[json.dumps(in_array(v), ensure_ascii=False, separators=(",", ":")) for _, v in row] for row in rows]
        return pd.DataFrame({"keys": [[k for k, _ in row] for row in rows], "jsons": texts})

    return F.pandas_udf(flatten, _FLAT)


def flatten_nested(prefix: str, object_text: Column) -> Column:
    """A JSON object of any depth as fields with dotted keys; nulls are dropped. An Arrow UDF."""
    flat = _flatten_json()(object_text)
    path = f"{prefix}." if prefix else ""
    return F.transform(
        F.arrays_zip(flat["keys"], flat["jsons"]),
        lambda z: field(F.concat(F.lit(path), z["keys"]), z["jsons"]),
    )


def _typed_fields(prefix: str, fields: Column) -> Column:
    """(key, JSON) attributes, nested ones included, as fields below a prefix."""
    present = F.filter(fields, lambda f: f["json"].isNotNull() & (f["json"] != "null"))
    members = F.transform(present, lambda f: F.concat(text.json_string(f["key"]), F.lit(":"), f["json"]))
    return flatten_nested(prefix, F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")))


# ---- whole documents --------------------------------------------------------------------------


def event_fields(events: Column, key: str = "Events") -> Column:
    """Span events as `Events.<name>.time` and `Events.<name>.<attribute>`."""
    per_event = F.transform(
        events,
        lambda e: F.concat(
            F.array(field(F.concat(F.lit(f"{key}."), e["Name"], F.lit(".time")), time_value(e["TimestampNs"]))),
            flatten_attributes(F.concat(F.lit(f"{key}."), e["Name"]), e["Attributes"]),
        ),
    )
    return F.coalesce(F.flatten(per_event), F.array().cast(FIELDS))


def _sorted_map(attrs: Column) -> Column:
    return F.map_from_entries(F.sort_array(F.map_entries(attrs)))


def links_text(links: Column) -> Column:
    """Span links as JSON text: a list of attribute, spanID, traceID."""
    return F.to_json(
        F.transform(
            links,
            lambda l: F.struct(
                _sorted_map(l["Attributes"]).alias("attribute"),
                l["SpanId"].alias("spanID"),
                l["TraceId"].alias("traceID"),
            ),
        )
    )


def sort_fields(fields: Column) -> Column:
    """Fields in key order; the order of equal keys stays."""
    numbered = F.transform(fields, lambda f, i: F.struct(f["key"].alias("key"), i.alias("at"), f["json"].alias("json")))
    return F.transform(F.sort_array(numbered), lambda f: field(f["key"], f["json"]))


# Below every character that keys have, so that a key sorts right before those it is the parent of.
_LOW = "\x01"


def _once(value: Column, then) -> Column:
    """What `then` makes of a value that it uses more than once.

    The value is a lambda's argument, as steps that are columns are put into each other again, and into lambdas, where Spark
    gathers Arrow UDFs.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def with_deduplicated(df: DataFrame, column: str) -> DataFrame:
    """Fields of a column sorted by key, one per key, the last wins.

    A field that is also the parent of others is renamed to `<key>.value`, unless there is
    such a field already.
    """
    entries = F.transform(F.col(column), lambda f: F.struct(f["key"], F.struct(f["json"].alias("json"))))

    def family_of(last: Column) -> Column:
        return F.sort_array(F.transform(
            F.map_entries(last),
            lambda e: F.struct(F.translate(e["key"], ".", _LOW).alias("rank"), e["key"].alias("key"), e["value"]["json"].alias("json")),
        ))

    def kept(last: Column, family: Column) -> Column:
        def renamed(f: Column, i: Column) -> Column:
            is_parent = F.coalesce(F.get(family, i + 1)["rank"].startswith(F.concat(f["rank"], F.lit(_LOW))), F.lit(False))
            lifted = F.concat(f["key"], F.lit(".value"))
            name = F.when(~is_parent, f["key"]).when(~F.map_contains_key(last, lifted), lifted)
            return field(name, f["json"])

        return F.sort_array(F.filter(F.transform(family, renamed), lambda f: f["key"].isNotNull()))

    return df.withColumn(column, _once(F.map_from_entries(entries), lambda last: _once(family_of(last), lambda family: kept(last, family))))


def _written(fields: Column) -> Column:
    return F.filter(fields, lambda f: f["json"].isNotNull() & ~f["json"].isin(*_EMPTY_VALUES))


def flat_json(fields: Column) -> Column:
    """Fields as one flat JSON object; empty values are left out."""
    members = F.transform(_written(fields), lambda f: F.concat(text.json_string(f["key"]), F.lit(":"), f["json"]))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def with_nested_json(df: DataFrame, column: str, into: str) -> DataFrame:
    """Sorted fields of a column as a JSON object with dotted keys nested.

    Keys below one prefix are neighbours in key order, so each field only has to close the
    levels it does not share with the one before it, and open its own.
    """
    def unquoted(key: Column) -> Column:
        literal = text.json_string(key)
        return F.substr(literal, F.lit(2), F.length(literal) - 2)

    escaped = F.transform(_written(F.col(column)), lambda f: F.struct(unquoted(f["key"]).alias("key"), f["json"].alias("json")))
    paths_of = lambda fields: F.transform(
        fields,
        lambda f: F.struct(
            f["key"].alias("key"),
            f["json"].alias("json"),
            F.split(f["key"], r"\.").alias("steps"),
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size(F.split(f["key"], r"\.")) - 1), lambda n: n > 0),
                lambda n: F.concat(F.call_function("substring_index", f["key"], F.lit("."), n), F.lit(".")),
            ).alias("parents"),
        ),
    )

    def whole(paths: Column) -> Column:
        def member(f: Column, i: Column) -> Column:
            before = F.get(paths, i - 1)
            common = F.size(F.filter(f["parents"], lambda p: F.startswith(before["key"], p)))

            def written(shared: Column) -> Column:
                closed = F.concat(F.repeat(F.lit("}"), F.size(before["parents"]) - shared), F.lit(","))
                own = F.slice(f["steps"], shared + 1, F.size(f["parents"]) - shared)
                opened = F.when(F.size(own) > 0, F.concat(F.lit('"'), F.array_join(own, '":{"'), F.lit('":{'))).otherwise("")
                start = F.when(i == 0, F.lit("")).otherwise(closed)
                return F.concat(start, opened, F.lit('"'), F.element_at(f["steps"], -1), F.lit('":'), f["json"])

            return _once(common, written)

        ending = F.repeat(F.lit("}"), F.greatest(F.size(F.get(paths, F.size(paths) - 1)["parents"]), F.lit(0)))
        body = F.array_join(F.transform(paths, member), "")
        return F.concat(F.lit("{"), body, F.coalesce(ending, F.lit("")), F.lit("}"))

    return df.withColumn(into, _once(paths_of(escaped), whole))


def _encode(df: DataFrame, fields: Column, dedup: bool, dedot: bool) -> DataFrame:
    df = df.withColumn("_fields", fields)
    if dedup:
        df = with_deduplicated(df, "_fields")
    elif dedot:
        df = df.withColumn("_fields", sort_fields(F.col("_fields")))
    if dedot:
        df = with_nested_json(df, "_fields", "document")
    else:
        df = df.withColumn("document", flat_json(F.col("_fields")))
    return df.drop("_fields")


def _attribute_fields(df: DataFrame, prefix: str, typed: str, plain: str) -> Column:
    return _typed_fields(prefix, F.col(typed)) if typed in df.columns else flatten_attributes(prefix, F.col(plain))


def encode_span_documents(spans: DataFrame, dedup: bool = True, dedot: bool = False) -> DataFrame:
    """Adds `document`, the JSON document of each span."""
    fixed = F.array(
        field("@timestamp", time_value(F.col("TimestampNs"))),
        field("EndTimestamp", time_value(F.col("TimestampNs") + F.col("Duration"))),
        field("TraceId", string_value(F.col("TraceId"))),
        field("SpanId", string_value(F.col("SpanId"))),
        field("ParentSpanId", string_value(F.col("ParentSpanId"))),
        field("Name", string_value(F.col("SpanName"))),
        field("Kind", string_value(F.col("SpanKind"))),
        field("TraceStatus", names.status_code_number(F.col("StatusCode")).cast("string")),
        field("Link", string_value(links_text(F.col("Links")))),
    )
    fields = F.concat(
        fixed,
        _attribute_fields(spans, "Attributes", "SpanFields", "SpanAttributes"),
        _attribute_fields(spans, "Resource", "ResourceFields", "ResourceAttributes"),
        event_fields(F.col("Events")),
    )
    return _encode(spans, fields, dedup, dedot)


def _body_fields(logs: DataFrame) -> Column:
    """The body: a map as `Body.<key>` fields, other values with their type; plain text where types weren't kept."""
    if "BodyField" not in logs.columns:
        return F.array(field("Body", string_value(F.col("Body"))))
    body = F.col("BodyField")
    plain = F.array(field("Body", F.when(body["type"].isNotNull(), body["json"])))
    # Only maps pass through the flattening of values of unknown depth.
    nested = flatten_nested("Body", F.when(body["type"] == "map", body["json"]))
    return F.when(body["type"] == "map", nested).otherwise(plain)


def encode_log_documents(logs: DataFrame, dedup: bool = True, dedot: bool = False) -> DataFrame:
    """Adds `document`, the JSON document of each log record."""
    fixed = F.array(
        field("@timestamp", time_value(F.col("TimestampNs"))),
        field("TraceId", string_value(F.col("TraceId"))),
        field("SpanId", string_value(F.col("SpanId"))),
        field("TraceFlags", F.col("TraceFlags").cast("string")),
        field("SeverityText", string_value(F.col("SeverityText"))),
        field("SeverityNumber", F.col("SeverityNumber").cast("string")),
    )
    fields = F.concat(
        fixed,
        _body_fields(logs),
        _attribute_fields(logs, "Attributes", "LogFields", "LogAttributes"),
        _attribute_fields(logs, "Resource", "ResourceFields", "ResourceAttributes"),
    )
    return _encode(logs, fields, dedup, dedot)


# Fixed value: process name of a resource without one.
NO_SERVICE = "OTLPResourceNoServiceName"


_TAGS = "array<struct<key:string,type:string,value:string>>"


def _tags(attrs: Column, fields: Column | None = None) -> Column:
    """Attributes as tags. Types come from typed fields where there are some: bytes are hexadecimal then, lists and maps JSON text."""
    if fields is None:
        return F.transform(F.map_entries(attrs), lambda e: F.struct(e["key"].alias("key"), F.lit("string").alias("type"), e["value"].alias("value")))
    bytes_of = lambda e: F.coalesce(F.lower(F.hex(F.try_to_binary(e["value"], F.lit("base64")))), e["value"])

    def tag(e: Column, kind: Column) -> Column:
        known = F.when(kind.isin("bool", "int64", "float64", "binary"), kind).otherwise("string")
        return F.struct(e["key"].alias("key"), known.alias("type"), F.when(kind == "binary", bytes_of(e)).otherwise(e["value"]).alias("value"))

    types = F.map_from_entries(F.transform(fields, lambda f: F.struct(f["key"], f["type"])))
    listed = lambda types: F.transform(F.map_entries(attrs), lambda e: _once(types[e["key"]], lambda kind: tag(e, kind)))
    return _once(types, listed)


def _tag(key: str, value: Column, kind: str = "string") -> Column:
    """A list with one tag, empty where there is no value."""
    tag = F.struct(F.lit(key).alias("key"), F.lit(kind).alias("type"), value.alias("value"))
    return F.when(F.coalesce(value, F.lit("")) != "", F.array(tag)).otherwise(F.array().cast(_TAGS))


def _reference(kind: str, trace_id: Column, span_id: Column) -> Column:
    return F.struct(F.lit(kind).alias("refType"), trace_id.alias("traceID"), span_id.alias("spanID"))


def encode_jaeger_documents(spans: DataFrame) -> DataFrame:
    """Adds `document`, the span in the document form of Jaeger: times in microseconds, tags and logs as lists.

    Tags have the types of the attributes where the spans were flattened with their typed fields, else all are strings.
    """
    typed = lambda name: F.col(name) if name in spans.columns else None
    no_references = F.array().cast("array<struct<refType:string,traceID:string,spanID:string>>")
    parent = F.when(
        F.col("ParentSpanId") != "",
        F.array(_reference("CHILD_OF", F.col("TraceId"), F.col("ParentSpanId"))),
    ).otherwise(no_references)
    followed = F.transform("Links", lambda l: _reference("FOLLOWS_FROM", l["TraceId"], l["SpanId"]))
    kind = F.lower(F.regexp_replace("SpanKind", "^SPAN_KIND_(UNSPECIFIED)?", ""))
    code = F.regexp_replace("StatusCode", "^STATUS_CODE_(UNSET)?", "")
    tags = F.concat(
        _tags(F.col("SpanAttributes"), typed("SpanFields")),
        _tag("otel.library.name", F.col("ScopeName")),
        _tag("otel.library.version", F.col("ScopeVersion")),
        _tag("span.kind", kind),
        _tag("otel.status_code", code),
        _tag("error", F.when(code == "ERROR", F.lit("true")), "bool"),
        _tag("otel.status_description", F.col("StatusMessage")),
        _tag("w3c.tracestate", F.col("TraceState")),
    )
    of_event = lambda i: None if typed("EventFields") is None else F.get("EventFields", i)
    logs = F.transform(
        "Events",
        lambda e, i: F.struct(
            times.floor_div(e["TimestampNs"], 1000).alias("timestamp"),
            F.concat(_tag("event", e["Name"]), _tags(e["Attributes"], of_event(i))).alias("fields"),
        ),
    )
    resource = F.col("ResourceAttributes")
    process = F.struct(
        F.coalesce(resource["service.name"], F.lit(NO_SERVICE)).alias("serviceName"),
        _tags(maps.without_keys(resource, ["service.name"]), typed("ResourceFields")).alias("tags"),
    )
    start_us = times.floor_div(F.col("TimestampNs"), 1000)
    document = F.struct(
        F.col("TraceId").alias("traceID"),
        F.col("SpanId").alias("spanID"),
        F.when(F.col("ParentSpanId") != "", F.col("ParentSpanId")).alias("parentSpanID"),
        F.col("SpanName").alias("operationName"),
        F.concat(parent, followed).alias("references"),
        F.lit(0).alias("flags"),
        start_us.alias("startTime"),
        times.floor_div(start_us, 1000).alias("startTimeMillis"),
        times.floor_div(F.col("Duration"), 1000).alias("duration"),
        tags.alias("tags"),
        logs.alias("logs"),
        process.alias("process"),
    )
    return spans.withColumn("document", F.to_json(document))
