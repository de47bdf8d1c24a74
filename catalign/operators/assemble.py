"""From table cells and price-list rows to whole product records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.functions import fixed, text
from catalign.functions.prices import price_digits
from catalign.session import written

HEAD_ROWS = 12


def _clean(value: Column) -> Column:
    value = F.trim(value)
    return F.when(text.filled(value) & (value != "nan"), value)


def _headers(cells: DataFrame, keys: Sequence[str], within: int, names: Sequence[str], is_header, fields) -> DataFrame:
    """Header row of each table and the column of each field, read from the table's first rows only.

    ``is_header(joined text)`` finds the row; ``fields(row cells, next row cells)`` names the columns.
    Of several columns with one field the last counts.
    """
    first = cells.filter(F.col("row_no") < HEAD_ROWS).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("row_no", "cells"))).alias("_rows"))
    hits = F.filter("_rows", lambda r: (r["row_no"] < within) & is_header(F.array_join(F.filter(
        r["cells"], lambda c: c.isNotNull()), " ")))

    def places(columns: Column) -> Column:
        return F.struct(*[F.when(F.array_contains(columns, n), F.size(columns) - F.array_position(F.reverse(columns), n))
                          .cast("int").alias(n) for n in names])

    def read(head: Column) -> Column:
        following = F.get(F.filter("_rows", lambda r: r["row_no"] == head["row_no"] + 1), F.lit(0))["cells"]
        columns = text.let(following, lambda below: fields(head["cells"], below))
        return F.struct(head["row_no"].alias("head"), text.let(columns, places).alias("at"))

    found = first.select(*keys, text.let(F.get(hits, F.lit(0)), read).alias("_h"))
    return found.select(*keys, F.col("_h.head").alias("_head"), F.col("_h.at").alias("_at")).filter(F.col("_head").isNotNull())


def raw_records(cells: DataFrame, keys: Sequence[str] = ("doc", "table_no")) -> DataFrame:
    """One record per data row below a two-row header (``Malli`` and ``Paketti`` in the first ten rows).

    ``cells(doc, table_no, page, row_no, cells array)``; tables without header and empty rows give nothing.
    """
    def fields(head: Column, following: Column) -> Column:
        def label(cell: Column, i: Column) -> Column:
            below = F.get(following, i)
            both = F.concat_ws(" ", F.when(cell != "nan", cell), F.when(below != "nan", below))
            return text.let(F.trim(both), lambda t: F.coalesce(text.header_field(t, fixed.TABLE_HEADERS), F.lit("")))
        return F.transform(head, label)

    names = [name for _, name in fixed.TABLE_HEADERS]
    heads = _headers(cells, keys, 10, names, lambda t: t.contains("Malli") & t.contains("Paketti"), fields)
    rows = cells.join(heads, list(keys)).filter(F.col("row_no") >= F.col("_head") + 2)
    rows = rows.select(*keys, "page", "row_no", *[_clean(F.get("cells", F.col(f"_at.{n}"))).alias(n) for n in names])
    present = F.coalesce(*names).isNotNull()
    normal = {f"normalized_{n}": text.field_text(F.col(n)) for n in ("malli", "paketti", "moottori", "telamatto", "mittaristo")}
    return rows.filter(present).withColumns({**normal, "price_value": price_digits(F.col("price"))})


def keyword_records(cells: DataFrame, keys: Sequence[str] = ("doc", "table_no"), min_keywords: int = 3) -> DataFrame:
    """One record per row below a header with at least ``min_keywords`` known words; rows without code drop."""
    def is_header(row: Column) -> Column:
        return text.let(text.squeeze(F.lower(row)), lambda t: text.keyword_hits(t, fixed.HEADER_KEYWORDS)) >= min_keywords

    def fields(head: Column, _following: Column) -> Column:
        return F.transform(head, lambda c: F.coalesce(text.header_field(F.lower(F.trim(c)), fixed.KEYWORD_HEADERS), F.lit("")))

    names = [name for _, name in fixed.KEYWORD_HEADERS]
    heads = _headers(cells, keys, 5, names, is_header, fields)
    rows = cells.join(heads, list(keys)).filter(F.col("row_no") > F.col("_head"))
    rows = rows.select(*keys, "page", "row_no", *[
        F.when(F.col(f"_at.{n}").isNotNull(), F.coalesce(F.trim(F.get("cells", F.col(f"_at.{n}"))), F.lit(""))).alias(n) for n in names])
    return rows.filter(text.filled(F.col("model_code")))


def number_products(rows: DataFrame, doc: str = "doc", page: str = "page", row: str = "row_no", code: str = "model_code") -> DataFrame:
    """Number of the product a row belongs to: starts counted in page and row order, 0 before the first.

    A segmented scan: rows are sorted by range once and written; starts are counted inside each partition of the sort, and what a document
    has in the partitions before comes from one row per partition. So a hot document is spread over partitions like any other rows.
    """
    start = F.length(F.trim(F.coalesce(F.col(code), F.lit("")))) == 4
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = rows.withColumn("is_start", start).repartitionByRange(parts, doc, page, row).sortWithinPartitions(doc, page, row)
    placed = written(line.withColumn("_at", F.monotonically_increasing_id()), "rows").withColumn("_part", F.shiftrightunsigned("_at", 33))
    carried = _carried_starts(placed, doc)
    inside = Window.partitionBy("_part", doc).orderBy("_at")
    counted = placed.withColumn("_own", F.sum(F.col("is_start").cast("long")).over(inside)).join(F.broadcast(carried), "_part", "left")
    before = F.when(F.col(doc).eqNullSafe(F.col("_carried.doc")), F.col("_carried.n")).otherwise(F.lit(0))
    return counted.withColumn("product_no", F.col("_own") + before).drop("_at", "_part", "_own", "_carried")


def _carried_starts(placed: DataFrame, doc: str) -> DataFrame:
    """``_part, _carried``: how many starts the first document of each partition has in the partitions before; a row per partition."""
    each = placed.groupBy("_part", doc).agg(F.sum(F.col("is_start").cast("long")).alias("n"), F.min("_at").alias("at"))
    edge = F.struct(F.col(doc).alias("doc"), "n")
    # as many rows as the sort has partitions
    edges = each.groupBy("_part").agg(F.min_by(edge, "at").alias("first"), F.max_by(edge, "at").alias("last")).orderBy("_part").collect()
    found, running = [], (None, 0)
    for e in edges:
        first, last = e["first"], e["last"]
        carry = running[1] if running[0] == first["doc"] and found else 0
        found.append((e["_part"], (first["doc"], carry)))
        running = (last["doc"], last["n"] + (carry if last["doc"] == first["doc"] else 0))
    kind = placed.schema[doc].dataType.simpleString()
    return placed.sparkSession.createDataFrame(found, f"_part long, _carried struct<doc:{kind},n:long>")


def fold_text(values: Column) -> Column:
    """Join texts in order: empty ones are skipped, a text equal to all before it is not repeated."""
    def step(current: Column, value: Column) -> Column:
        new = F.trim(F.coalesce(value, F.lit("")))
        skip = (new == "") | (new == "nan") | (current == new)
        return F.when(skip, current).when(current == "", new).otherwise(F.concat(current, F.lit(" "), new))
    return F.aggregate(values, F.lit(""), step)


def merge_continuations(rows: DataFrame, doc: str = "doc", page: str = "page", row: str = "row_no", code: str = "model_code",
                        fields: Sequence[str] = tuple(fixed.MERGED_FIELDS), useful: Sequence[str] = tuple(fixed.USEFUL_FIELDS),
                        headings: Sequence[str] = tuple(fixed.CATEGORY_ROWS), keep: Sequence[str] = ()) -> DataFrame:
    """Fold continuation rows into the product row above them.

    A four-letter code starts a product. Other rows merge when they have a code that is no category
    heading, or any useful field. What one product collects is exactly the text of its result.
    """
    numbered = number_products(rows, doc, page, row, code).filter(F.col("product_no") > 0)
    own = F.trim(F.coalesce(F.col(code), F.lit("")))
    has_data = F.coalesce(*[F.nullif(F.col(f), F.lit("")) for f in useful]).isNotNull()
    merged = numbered.filter(F.col("is_start") | ((own != "") & ~own.isin(*headings)) | has_data)
    packed = merged.groupBy(doc, "product_no").agg(
        F.array_sort(F.collect_list(F.struct(page, row, *fields))).alias("_rows"),
        F.max(F.when(F.col("is_start"), own)).alias(code),
        *[F.max(F.when(F.col("is_start"), F.col(c))).alias(c) for c in keep])
    folded = [fold_text(_field_of("_rows", f)).alias(f) for f in fields]
    return packed.select(doc, "product_no", code, *folded, *keep, F.size("_rows").alias("merged_rows"))


def _field_of(rows: str, field: str) -> Column:
    return F.transform(rows, lambda r: r[field])
