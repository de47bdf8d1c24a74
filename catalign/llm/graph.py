"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalign.llm import common


def _stars(edges: DataFrame, small: bool, path: str, rows: int) -> DataFrame:
    """One step: neighbours are hung on the smallest node near them. Both sides of the join come from shuffles, so hubs are split.

    The smallest nodes are written to `path`. Neither they nor the edges are more than `rows` times two.
    """
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = common.saved(common.gathered(near.groupBy("u").agg(F.min("v").alias("m")), 2 * rows), "lowest", path).select(F.col("u"), F.least("u", "m").alias("m"))
    found = near.join(lowest, "u")
    if small:
        hung = found.select(F.col("v").alias("a"), F.col("m").alias("b")).union(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        hung = found.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return common.gathered(hung.filter("a <> b").distinct(), 2 * rows)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Nothing is collected: each round writes its edges to the shared folder over those of the round before, and compares two sums with it. Few edges
    go to few tasks and files, however many partitions the session has.
    """
    at = {name: common.fresh_path(edges.sparkSession, name) for name in ("links", "large", "lowest")}
    links = common.saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", at["links"])
    rows = links.count()
    before = None
    for _ in range(most_rounds):
        large = common.saved(_stars(links, False, at["lowest"], rows), "large", at["large"])
        links = common.saved(_stars(large, True, at["lowest"], rows), "links", at["links"])
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise ValueError("components did not settle")
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
