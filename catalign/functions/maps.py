"""Specification maps: overlay, defaults, removal, difference."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

def sql_text(value: str | None) -> str:
    """SQL literal of a text."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(values: Mapping[str, str]) -> Column:
    """Constant map, written as one SQL literal so that building a plan stays quick."""
    if not values:
        return F.expr("CAST(map() AS MAP<STRING, STRING>)")
    return F.expr("map(" + ", ".join(sql_text(x) for pair in values.items() for x in pair) + ")")


def known_map(**values: Column) -> Column:
    """Map of the given columns without null values."""
    pairs = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def overlay(base: Column, *later: Column) -> Column:
    """Merge maps without null values, later ones win; needs no session setting for double keys."""
    for top in later:
        base = F.map_zip_with(base, top, lambda _k, old, new: F.coalesce(new, old))
    return base


def with_defaults(specs: Column, defaults: Column) -> Column:
    """Add the defaults whose key is absent."""
    return F.map_zip_with(specs, defaults, lambda _k, own, default: F.coalesce(own, default))


def without(specs: Column, *keys: str) -> Column:
    return F.map_filter(specs, lambda k, _: ~k.isin(*keys))


def when_map(condition: Column, values: Mapping[str, str]) -> Column:
    return F.when(condition, literal_map(values)).otherwise(literal_map({}))


def first_map(arms: list[tuple[Column, Mapping[str, str]]]) -> Column:
    """The map of the first true condition, else an empty one."""
    chain = F.when(arms[0][0], literal_map(arms[0][1]))
    for condition, values in arms[1:]:
        chain = chain.when(condition, literal_map(values))
    return chain.otherwise(literal_map({}))


def difference(inherited: Column, custom: Column) -> Column:
    """What ``custom`` changes or adds: new values, and for changed keys a mark and the old value."""
    changed = F.map_filter(custom, lambda k, v: F.map_contains_key(inherited, k) & (F.element_at(inherited, k) != v))
    added = F.map_filter(custom, lambda k, _: ~F.map_contains_key(inherited, k))
    marks = F.transform_values(
        F.transform_keys(changed, lambda k, _: F.concat(k, F.lit("_customized"))), lambda _k, _v: F.lit("true"))
    old = F.map_from_entries(F.transform(F.map_keys(changed), lambda k: F.struct(
        F.concat(k, F.lit("_original")), F.element_at(inherited, k))))
    return overlay(changed, added, marks, old)


def map_text(specs: Column) -> Column:
    """``key=value`` pairs in key order, joined with ``; ``."""
    pairs = F.transform(F.map_entries(specs), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), "; ")


def any_key(specs: Column, part: str) -> Column:
    return F.exists(F.map_keys(specs), lambda k: k.contains(part))
