"""Ordered scans that no single key can overload.

A plain running window puts a whole key into one task. These scans cut each key into blocks of
positions, scan the blocks, scan the block totals the same way, and add the two. A window partition
then holds at most ``fan`` rows of a key, and the last level one row per ``fan ** depth`` positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.session import shared_dir

FAN = 65536


def exclusive_scan(df: DataFrame, part: Sequence[str], pos: str, value: str, out: str, how: str = "sum",
                   fan: int = FAN, depth: int = 1) -> DataFrame:
    """Add ``out``: the sum (or last non-null) of ``value`` over earlier positions of the same key.

    ``df`` has one row per key and integer position.
    """
    fold = F.sum if how == "sum" else (lambda c: F.last(c, ignorenulls=True))
    if depth == 0:
        window = Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        before = fold(F.col(value)).over(window)
        return df.withColumn(out, F.coalesce(before, F.lit(0)) if how == "sum" else before)
    block, total, carried = f"_{pos}_block", f"_{value}_total", f"_{out}_carried"
    placed = df.withColumn(block, F.floor(F.col(pos) / fan))
    summary = F.sum(value) if how == "sum" else F.max_by(value, F.when(F.col(value).isNotNull(), F.col(pos)))
    parents = placed.groupBy(*part, block).agg(summary.alias(total))
    parents = exclusive_scan(parents, part, block, total, carried, how, fan, depth - 1).drop(total)
    window = Window.partitionBy(*part, block).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(parents, [*part, block], "left")
    inner = fold(F.col(value)).over(window)
    if how == "sum":
        result = F.coalesce(inner, F.lit(0)) + F.coalesce(F.col(carried), F.lit(0))
    else:
        result = F.coalesce(inner, F.col(carried))
    return joined.withColumn(out, result).drop(block, carried)


def exclusive_sum(df: DataFrame, part: Sequence[str], order: Sequence[str], value: Column, out: str, fan: int = FAN,
                  depth: int = 1) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a key, in the order of integer columns that together are unique.

    The last column is cut into blocks; totals of each leading column are scanned the same way, so neither
    a hot key nor a hot leading value (one document, one page, one conversation) fills a task.
    """
    *head, last = order
    block, before, lead, total = f"_{last}_block", f"_{last}_before", "_lead_before", "_block_total"
    scope = [*part, *head]
    placed = df.withColumns({"_value": value.cast("long"), block: F.floor(F.col(last) / fan)})
    counts = placed.groupBy(*scope, block).agg(F.sum("_value").alias(total))
    blocks = exclusive_scan(counts, scope, block, total, before, "sum", fan, depth).drop(total)
    window = Window.partitionBy(*scope, block).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("_value").over(window), F.lit(0))
    joined = (placed.join(blocks, [*scope, block], "left")
              .withColumn(out, inner + F.coalesce(F.col(before), F.lit(0))).drop(block, before))
    while head:
        *rest, last = head
        sums = placed.groupBy(*part, *head).agg(F.sum("_value").alias(total))
        totals = exclusive_scan(sums, [*part, *rest], last, total, lead, "sum", fan, depth).drop(total)
        joined = (joined.join(totals, [*part, *head], "left")
                  .withColumn(out, F.col(out) + F.coalesce(F.col(lead), F.lit(0))).drop(lead))
        head = rest
    return joined.drop("_value")


def ordinal(df: DataFrame, order: Sequence[str], out: str, part: Sequence[str] = (), fan: int = FAN,
            depth: int = 1) -> DataFrame:
    """Zero-based row number over integer columns that together are unique.

    Without a key the rows are sorted by range once and written to the shared folder with their place in
    their partition; row numbers are that place plus the rows of the partitions before, one number each.
    """
    if part:
        return exclusive_sum(df, part, order, F.lit(1), out, fan, depth)
    spark = df.sparkSession
    path = shared_dir(spark, "ordinal")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_part", F.shiftrightunsigned("_id", 33))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per partition of the sort
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_before") + place).select(*df.columns, out)


def batches(df: DataFrame, order: Sequence[str], size: int, out: str = "batch_no") -> DataFrame:
    """Number rows in order and cut them into batches of ``size``."""
    return ordinal(df, order, "_ordinal").withColumn(out, F.floor(F.col("_ordinal") / size)).drop("_ordinal")


def previous_value(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str, out: str,
                   block: Column) -> DataFrame:
    """``lag(value)`` of a key, with every key cut into the same blocks.

    ``block`` is an integer that never falls along ``order``, fine enough for a block of one key to fit a task
    (the minute of a time, say).
    """
    placed = df.withColumn("_block", block)
    marker = F.struct(*order)
    lasts = placed.groupBy(*part, "_block").agg(F.max_by(F.struct(F.col(value).alias("v")), marker).alias("_last"))
    lasts = exclusive_scan(lasts, part, "_block", "_last", "_carried", "last").drop("_last")
    window = Window.partitionBy(*part, "_block").orderBy(*order)
    inner = F.lag(F.struct(F.col(value).alias("v"))).over(window)
    return (placed.join(lasts, [*part, "_block"], "left")
            .withColumn(out, F.coalesce(inner, F.col("_carried"))["v"]).drop("_block", "_carried"))
