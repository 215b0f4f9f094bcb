"""Metadata as VARIANT: scalars and lists keep their kinds, and a value of another kind than asked for is null, not an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(json: Column) -> Column:
    """A JSON text as a variant; null where it isn't JSON."""
    return F.try_parse_json(json)


def _at(key: str) -> str:
    mark = '"' if "'" in key else "'"
    if mark in key:
        raise ValueError(f"a key with both kinds of quotation marks has no path: {key}")
    return f"$[{mark}{key}{mark}]"


def kind(meta: Column, key: str) -> Column:
    """array, object, scalar or null (also for JSON's null, and where there is no such key or no row)."""
    said = F.schema_of_variant(F.try_variant_get(meta, _at(key), "variant"))
    return F.when(said.startswith("ARRAY"), "array").when(said.startswith("OBJECT"), "object").when(said != "VOID", "scalar")


def scalar(meta: Column, key: str) -> Column:
    """A scalar as text; null for lists, objects and what isn't there."""
    return F.when(kind(meta, key) == "scalar", F.try_variant_get(meta, _at(key), "string"))


def listed(meta: Column, key: str) -> Column:
    """A list's scalars as texts, in order; null for anything but a list."""
    return F.when(kind(meta, key) == "array", F.try_variant_get(meta, _at(key), "array<string>"))


def length(meta: Column, key: str) -> Column:
    """How long a list is; null for anything but a list."""
    return F.when(kind(meta, key) == "array", F.size(F.try_variant_get(meta, _at(key), "array<variant>")))


def whole(meta: Column, key: str, default: int = -1) -> Column:
    """A whole number, given as a number or a text of digits; default for anything else."""
    text = scalar(meta, key)
    return F.coalesce(F.when(text.rlike(r"^\d+$"), text.try_cast("int")), F.lit(default))


def row(meta: Column, scalars: list[str], lists: list[str]) -> list[Column]:
    """All of a row's values under their keys; every one null where there is no metadata."""
    return [*[scalar(meta, k).alias(k) for k in scalars], *[listed(meta, k).alias(k) for k in lists]]


def merged(old: Column, new: Column, removed: tuple[str, ...] = ()) -> Column:
    """Keys of new in place of old's, removed ones gone, the rest kept; lists and objects as they are. What is no object counts as empty."""
    none = F.create_map().cast("map<string,variant>")
    a, b = (F.coalesce(F.try_variant_get(v, "$", "map<string,variant>"), none) for v in (old, new))
    both = F.map_concat(F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k)), b)
    return F.to_variant_object(F.map_filter(both, lambda k, _: ~k.isin(*removed)) if removed else both)
