"""Attribute maps (MAP<STRING,STRING>)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(EMPTY_MAP)


def attribute(attrs: Column, key: str) -> Column:
    """Value under a key; a missing key reads as ''."""
    return F.coalesce(attrs[key], F.lit(""))


def first_attribute(key: str, *maps: Column) -> Column:
    """Value from the first map that has the key, else NULL."""
    return F.coalesce(*[F.when(F.map_contains_key(m, key), m[key]) for m in maps])


def attributes_id(attrs: Column) -> Column:
    """Order-free text key of a map: sorted `k:v` joined by `;`."""
    pairs = F.transform(F.map_entries(attrs), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return F.array_join(F.sort_array(pairs), ";")


def merge_maps(*maps: Column) -> Column:
    """Union of maps; a later one wins (needs the LAST_WIN map policy of session.configure)."""
    return F.map_concat(*[F.coalesce(m, empty_map()) for m in maps])


def without_keys(attrs: Column, keys: list[str]) -> Column:
    return F.map_filter(attrs, lambda k, _: ~k.isin(*keys))


def only_keys(attrs: Column, keys: list[str]) -> Column:
    return F.map_filter(attrs, lambda k, _: k.isin(*keys))


def as_text(value: Column) -> Column:
    """A nested column as JSON text, for display."""
    return F.to_json(value)
