"""Reads with optional filters, text search, paging and gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.functions.text import filled


def equal_filters(df: DataFrame, **values: object) -> DataFrame:
    """Rows equal to every given value; ``None`` means no filter."""
    for column, value in values.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence[object] | None, limit: int) -> DataFrame:
    """The next ``limit`` rows in ascending ``keys`` order after the last keys seen, or the first ones.

    The bound is a filter on the keys, so a deep page costs no more than the first; ``page`` reads all rows before it.
    """
    if last is not None:
        beyond = F.lit(False)
        for i in range(len(keys)):
            same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], last[:i])]
            beyond = beyond | reduce(lambda a, b: a & b, [*same, F.col(keys[i]) > F.lit(last[i])])
        df = df.filter(beyond)
    return df.orderBy(*keys).limit(limit)


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page in a total order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def product_search(df: DataFrame, confidence: str, key: str, *, price: str = "price", min_price: float = 0,
                   max_price: float = 0, min_confidence: float = 0.0, page_no: int = 1, size: int = 50,
                   **equal: object) -> DataFrame:
    """Filtered products by falling confidence; a zero price bound means none."""
    df = equal_filters(df, **equal)
    if min_price:
        df = df.filter(F.col(price) >= min_price)
    if max_price:
        df = df.filter(F.col(price) <= max_price)
    df = df.filter(F.col(confidence) >= min_confidence)
    return page(df, [F.col(confidence).desc(), F.col(key)], size, (page_no - 1) * size)


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    """Case-insensitive containment; ``_`` and ``%`` in ``part`` stay wildcards."""
    return df.filter(F.col(column).ilike(f"%{part}%"))


def word_search(df: DataFrame, columns: Sequence[str], terms: str) -> DataFrame:
    """Rows whose words include every word of ``terms`` (no stemming)."""
    words = F.split(F.lower(F.concat_ws(" ", *columns)), "[^\\p{L}\\p{N}]+")
    asked = [w for w in "".join(c.lower() if c.isalnum() else " " for c in terms).split()]
    return df.filter(reduce(lambda a, b: a & b, [F.array_contains(words, w) for w in asked], F.lit(True)))


def quality_gate(confidence: Column, status: Column, required: Sequence[Column], finished: Column, options_text: Column,
                 options_done: Column, threshold: float = 0.95) -> Column:
    """Fit for publishing: confident, passed, essentials present, finished, options processed when named."""
    checks = [confidence >= threshold, status == "passed", *required, finished, ~filled(options_text) | options_done]
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in checks])


def live(df: DataFrame, deleted_at: str) -> DataFrame:
    return df.filter(F.col(deleted_at).isNull())


def useful(df: DataFrame, fields: Sequence[str] = tuple(fixed.USEFUL_FIELDS)) -> DataFrame:
    return df.filter(F.coalesce(*[F.nullif(F.col(f), F.lit("")) for f in fields]).isNotNull())


def with_options_text(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.trim(F.col(column)) != "")
