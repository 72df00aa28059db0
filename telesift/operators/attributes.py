"""Edits of attribute maps, row by row; nothing here shuffles except an enrichment's join."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.functions import maps


def _entry(key: str, value) -> Column:
    literal = value if isinstance(value, Column) else F.lit(str(value))
    return F.create_map(F.lit(key), literal)


def insert_attribute(df: DataFrame, key: str, value, column: str = "SpanAttributes") -> DataFrame:
    """Set an attribute only where it is absent."""
    attrs = F.col(column)
    return df.withColumn(column, maps.merge_maps(_entry(key, value), attrs))


def update_attribute(df: DataFrame, key: str, value, column: str = "SpanAttributes") -> DataFrame:
    """Set an attribute only where it is present."""
    attrs = F.col(column)
    changed = maps.merge_maps(attrs, _entry(key, value))
    return df.withColumn(column, F.when(F.map_contains_key(attrs, key), changed).otherwise(attrs))


def upsert_attribute(df: DataFrame, key: str, value, column: str = "SpanAttributes") -> DataFrame:
    return df.withColumn(column, maps.merge_maps(F.col(column), _entry(key, value)))


def delete_attribute(df: DataFrame, key: str, column: str = "SpanAttributes") -> DataFrame:
    return df.withColumn(column, maps.without_keys(F.col(column), [key]))


def upsert_resource_attribute(df: DataFrame, key: str, value) -> DataFrame:
    """Set a resource attribute; ServiceName follows `service.name`."""
    df = upsert_attribute(df, key, value, "ResourceAttributes")
    if key == "service.name" and "ServiceName" in df.columns:
        df = df.withColumn("ServiceName", maps.attribute(F.col("ResourceAttributes"), key))
    return df


def group_by_attrs(df: DataFrame, keys: list[str], column: str = "SpanAttributes") -> DataFrame:
    """Move the named attributes from the record up to its resource."""
    moved = maps.only_keys(F.col(column), keys)
    df = df.withColumns(
        {
            "ResourceAttributes": maps.merge_maps(F.col("ResourceAttributes"), moved),
            column: maps.without_keys(F.col(column), keys),
        }
    )
    if "service.name" in keys and "ServiceName" in df.columns:
        df = df.withColumn("ServiceName", maps.attribute(F.col("ResourceAttributes"), "service.name"))
    return df


def filter_signals(df: DataFrame, drop_if: Column) -> DataFrame:
    """Rows for which the condition does not hold; unknown counts as not."""
    return df.filter(~F.coalesce(drop_if, F.lit(False)))


# Fixed value: what a blocked match is replaced with.
MASK = "****"


def redact(
    df: DataFrame, allowed_keys: list[str], blocked_patterns: list[str], column: str = "SpanAttributes"
) -> DataFrame:
    """Drop the keys not allowed, mask matches of blocked patterns in the values, count both."""
    attrs = F.col(column)
    kept = maps.only_keys(attrs, allowed_keys)
    masked = F.transform_values(kept, lambda _, v: _mask(v, blocked_patterns))
    hits = F.map_filter(kept, lambda _, v: _any_match(v, blocked_patterns))
    return df.withColumns(
        {
            column: masked,
            "redacted_keys": (F.size(attrs) - F.size(kept)).cast("int"),
            "masked_values": F.size(hits),
        }
    )


def _mask(value: Column, patterns: list[str]) -> Column:
    for pattern in patterns:
        value = F.regexp_replace(value, pattern, MASK)
    return value


def _any_match(value: Column, patterns: list[str]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | value.rlike(pattern)
    return found


def route(df: DataFrame, rules: list[tuple[Column, str]], default: str) -> DataFrame:
    """Adds `route`, the target of the first rule that holds; write partitioned by it."""
    matched = [F.when(F.coalesce(condition, F.lit(False)), F.lit(target)) for condition, target in rules]
    return df.withColumn("route", F.coalesce(*matched, F.lit(default)))


def rename_spans(spans: DataFrame, from_attributes: list[str], separator: str = "") -> DataFrame:
    """Name spans by the values of attributes, where a span has all of them."""
    values = [F.col("SpanAttributes")[key] for key in from_attributes]
    complete = values[0].isNotNull()
    for value in values[1:]:
        complete = complete & value.isNotNull()
    return spans.withColumn("SpanName", F.when(complete, F.concat_ws(separator, *values)).otherwise(F.col("SpanName")))


_REST = r"[\s\S]*"


def _located(pattern: str) -> tuple[str, list[int], list[str | None]]:
    """A pattern whose groups also tell where they end, the new numbers of its own groups, and their names.

    After each group a lookahead takes all that follows. That holds in alternatives and repetitions, where the last turn counts,
    as for the group itself.
    """
    out, numbers, names, open_, at, count, in_class = [], [], [], [], 0, 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            reference = re.match(r"\\([1-9]\d?)", pattern[at:])
            if reference and not in_class:
                out.append(("reference", int(reference[1])))
                at += len(reference[0])
                continue
            out.append(pattern[at : at + 2])
            at += 2
            continue
        if in_class:
            in_class += (c == "[") - (c == "]")
        elif c == "[":
            in_class = 1
            # A bracket right at the start of a class is one of its characters.
            first = re.match(r"\[\^?\]", pattern[at:])
            if first:
                out.append(first[0])
                at += len(first[0])
                continue
        elif c == "(":
            named = re.match(r"\(\?P?<([A-Za-z]\w*)>", pattern[at:])
            if named or pattern[at + 1 : at + 2] != "?":
                count += 1
                numbers.append(count)
                names.append(named[1] if named else None)
                open_.append(True)
                out.append("(?:(")
                at += len(named[0]) if named else 1
                continue
            open_.append(False)
        elif c == ")" and open_.pop():
            count += 1
            out.append(("end", None))
            at += 1
            continue
        out.append(c)
        at += 1
    text = "".join(f")(?=({_REST})))" if piece == ("end", None) else f"\\{numbers[piece[1] - 1]}" if isinstance(piece, tuple) else piece for piece in out)
    return text, numbers, names


def _ends(pattern: str) -> dict[int, int]:
    """The number of the group after each group of _located, which holds what follows it: groups close inside out."""
    ends, open_, count, at = {}, [], 0, 0
    for found in re.finditer(r"\\.|\[(?:\\.|[^\]])*\]|\((?!\?)|\((?=\?)|\)", pattern):
        piece = found[0]
        if piece == "(":
            capturing = pattern[found.end() : found.end() + 1] != "?"
            count += capturing
            open_.append(count if capturing else 0)
        elif piece == ")":
            ends[open_.pop()] = count + 1
    return ends


def name_to_attributes(spans: DataFrame, pattern: str, keys: list[str] | None = None) -> DataFrame:
    """Take attributes from the groups of a pattern in the span name, and put `{key}` in their place.

    Each group needs a key, or a name that is its key, as in `(?P<key>...)`. All else of the name stays as it is. Groups that took
    no part, or matched nothing, change nothing; of a group within a group only the outer one gives way in the name.
    """
    located, numbers, names = _located(pattern)
    keys = list(keys) if keys is not None else names
    if len(keys) != len(numbers) or None in keys:
        raise ValueError("the pattern must have one group for each key, or a name for each group")
    name, ends = F.col("SpanName"), _ends(located)
    take = lambda number: F.regexp_extract(name, located, number)
    end = lambda number: F.length(name) - F.length(take(ends[number]))
    groups = F.array(*[
        F.struct((end(n) - F.length(take(n))).alias("start"), end(n).alias("end"), F.lit(key).alias("key"), take(n).alias("value"))
        for n, key in zip(numbers, keys)
    ])
    rows = spans.withColumn("_groups", F.when(name.rlike(pattern_of(pattern)), F.filter(groups, lambda g: g["value"] != "")))
    # From left to right: what is before a group, then its key; groups inside the last one are passed over.
    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    step = lambda done, g: F.when(g["start"] < done["at"], done).otherwise(
        F.struct(F.concat(done["text"], F.substring(name, done["at"] + 1, g["start"] - done["at"]), F.lit("{"), g["key"], F.lit("}")).alias("text"), g["end"].alias("at"))
    )
    outer_first = F.array_sort(F.col("_groups"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    renamed = F.aggregate(outer_first, begin, step, lambda done: F.concat(done["text"], F.substring(name, done["at"] + 1, F.length(name))))
    found = F.map_from_entries(F.transform("_groups", lambda g: F.struct(g["key"], g["value"])))
    attributes = F.col("SpanAttributes")
    return rows.withColumns({
        "SpanAttributes": F.when(F.col("_groups").isNotNull(), maps.merge_maps(attributes, found)).otherwise(attributes),
        "SpanName": F.when(F.col("_groups").isNotNull(), renamed).otherwise(name),
    }).drop("_groups")


def pattern_of(pattern: str) -> str:
    """A pattern with its groups named as Java's are."""
    return pattern.replace("(?P<", "(?<")


def enrich(df: DataFrame, dimension: DataFrame, key: str, column: str = "ResourceAttributes") -> DataFrame:
    """Add the columns of a dimension table as attributes, matched on the attribute `key`.

    The dimension has a column named `key`; of its rows with the same key one is used. No
    broadcast is forced: Spark does that by the table's size, and splits a skewed join else.
    """
    added = [c for c in dimension.columns if c != key]
    pairs = [part for c in added for part in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    attrs = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    looked_up = dimension.select(F.col(f"`{key}`").cast("string").alias("_key"), attrs.alias("_attrs"))
    looked_up = looked_up.groupBy("_key").agg(F.min_by("_attrs", F.to_json("_attrs")).alias("_attrs"))
    joined = df.withColumn("_key", F.col(column)[key]).join(looked_up, "_key", "left")
    return joined.withColumn(column, maps.merge_maps(F.col("_attrs"), F.col(column))).select(*df.columns)
