"""Edits of JSON objects that keep keys nobody knows about.

An object is opened as a map of variants, changed key by key and written back,
so unknown keys and value types survive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def open_object(text: Column) -> Column:
    return F.from_json(text, "map<string,variant>")


def member(obj: Column, key: str) -> Column:
    """Value of a key as a variant; null where the key is absent."""
    return F.try_element_at(obj, F.lit(key))


def as_object(value: Column) -> Column:
    """A variant opened as a map of variants; null for anything but an object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def text_member(value: Column, path: str) -> Column:
    """Text at a path of a variant; null for a missing path or a JSON null."""
    return F.try_variant_get(value, path, "string")


def without(obj: Column, *keys: str) -> Column:
    return F.map_filter(obj, lambda k, _: ~k.isin(*keys))


def with_member(obj: Column, key: str, value: Column) -> Column:
    """Set one key to a text (null becomes a JSON null), replacing an older value."""
    literal = F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))
    return F.map_concat(without(obj, key), F.create_map(F.lit(key), literal))


def has_keys(text: Column, *keys: str) -> Column:
    """Whether all the keys are present at the top level, whatever their values."""
    present = F.json_object_keys(text)
    found = [F.array_contains(present, key) for key in keys]
    out = found[0]
    for more in found[1:]:
        out = out & more
    return F.coalesce(out, F.lit(False))


def canonical(text: Column) -> Column:
    """Same JSON value, keys sorted: two equal documents give equal texts."""
    return F.to_json(F.parse_json(text))


def full_json(value: Column) -> Column:
    """JSON text that keeps keys with null values."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def with_provenance(text: Column, source: Column, module: str) -> Column:
    """Set the keys `source` and `module`; a null document counts as an empty one."""
    obj = F.coalesce(open_object(text), F.create_map().cast("map<string,variant>"))
    return F.to_json(with_member(with_member(obj, "source", source), "module", F.lit(module)))
