"""One row per key: best match, last write, first seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.functions.text import let


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each key in ``order``.

    Spark turns the rank filter into a group limit that runs before the shuffle, so a key that
    holds a large part of the rows sends only ``n`` rows per input partition.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def best_match(df: DataFrame, keys: Sequence[str], score: str, position: Sequence[str | Column]) -> DataFrame:
    """Highest score per key; the earliest position wins a tie; non-positive scores never win."""
    return top_per_key(df.filter(F.col(score) > 0), keys, [F.col(score).desc(), *position])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write per key, as an insert-or-replace sequence leaves it."""
    return top_per_key(df, keys, [F.col(c).desc() for c in order])


def spread_nulls(key: Column, *row: str) -> Column:
    """A join key whose nulls are spread over many values that match nothing.

    In an outer join all null keys would meet in one partition.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*row), F.lit(1009)).cast("string")))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Merge ``new`` into ``old``, a table with one row per key: new rows win, and later new rows beat earlier ones.

    Old rows are only checked against the new keys; they are neither ranked nor sorted.
    """
    return delete_keys(old, new, keys).unionByName(keep_last(new, keys, order))


def delete_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def dedup_first(df: DataFrame, group: Sequence[str], value: str, position: str, normal: Column, times: str | None = None) -> DataFrame:
    """Ordered dedup inside a group: the first spelling of each normal form stays; ``times`` names a column for its count."""
    counts = [F.count("*").alias(times)] if times else []
    return (df.withColumn("_normal", normal)
            .groupBy(*group, "_normal")
            .agg(F.min_by(value, position).alias(value), F.min(position).alias(position), *counts)
            .drop("_normal"))


def rank_option_rows(options: DataFrame, keys: Sequence[str | Column], confidence: str, position: str) -> DataFrame:
    """Options in long form: best confidence per key at the place of its first detection."""
    return options.groupBy(*keys).agg(F.max(confidence).alias(confidence), F.min(position).alias(position))


def dedup_array(items: Column, normal) -> Column:
    """Ordered dedup of an array column under ``normal`` (Column -> Column), first kept."""
    placed = F.transform(items, lambda v, i: F.struct(v.alias("v"), i.alias("i"), normal(v).alias("k")))

    def firsts(rows: Column) -> Column:
        return let(F.transform(rows, lambda s: s["k"]), lambda keys: F.transform(
            F.filter(rows, lambda s: F.array_position(keys, s["k"]) == s["i"] + 1), lambda s: s["v"]))

    return let(placed, firsts)
