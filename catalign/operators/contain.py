"""Which texts contain which names, by an equi-join on letter parts.

Every name is found by one anchor: of its parts of PART letters the one that fewest names share (a shorter name is its own anchor). Texts
are taken apart into the parts of the lengths that occur, each part once, and joined to the anchors; what meets is checked once. No text
meets a name whose anchor it does not hold, and the list of names may be of any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions.text import let

PART = 4


def parts(text: Column, n: int) -> Column:
    """The distinct parts of n letters, in one pass over the letters."""
    def cut(letters: Column) -> Column:
        starts = F.when(F.size(letters) >= n, F.sequence(F.lit(0), F.size(letters) - n))
        return F.array_distinct(F.transform(starts, lambda i: F.concat(*[F.get(letters, i + k) for k in range(n)])))

    return F.coalesce(let(F.split(text, ""), cut), F.array().cast("array<string>"))


def anchors(names: DataFrame, name: str) -> DataFrame:
    """``name, part``: the anchor of every distinct name; null names have none."""
    distinct = names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct()
    text = F.col("name")
    each = distinct.select("name", F.explode(F.when(F.length(text) >= PART, parts(text, PART)).otherwise(F.array(text))).alias("part"))
    counted = each.join(each.groupBy("part").agg(F.count("*").alias("n")), "part")
    return counted.groupBy("name").agg(F.min_by("part", F.struct("n", "part")).alias("part"))


def contained(texts: DataFrame, keys: Sequence[str], text: str, names: DataFrame, name: str, holds=None) -> DataFrame:
    """``keys, name`` of every text and distinct name it contains (an empty name is in every text; nulls match nothing).

    ``texts`` is unique on ``keys``. Where the text is no key it does not travel with its parts but is fetched for the check. ``holds(text, name)``
    replaces the check for names of another kind: then ``names`` needs a column ``part``, its anchor.
    """
    found = names.select(F.col(name).alias("name"), "part").distinct() if holds is not None else anchors(names, name)
    # lengths of anchors, PART + 1 values at most: looked up where long texts would have many parts that no anchor asks for
    lengths = range(PART + 1) if text in keys else sorted(r[0] for r in found.select(F.length("part")).distinct().collect())
    cut = [F.array(F.lit("")) if n == 0 else parts(F.col(text), n) for n in lengths] or [F.array().cast("array<string>")]
    rows = texts.filter(F.col(text).isNotNull()).select(*keys, F.explode(F.concat(*cut)).alias("part"))
    met = rows.join(found, "part").select(*keys, "name")
    if text not in keys:
        met = met.join(texts.select(*keys, text), list(keys))
    check = F.col(text).contains(F.col("name")) if holds is None else holds(F.col(text), F.col("name"))
    return met.filter(check).select(*keys, "name")


def literal_run(pattern: Column) -> Column:
    """The longest run of letters between the wildcards of a pattern."""
    return F.array_max(F.transform(F.split(pattern, "[_%]+"), lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"]


def with_run_anchor(names: DataFrame, name: str) -> DataFrame:
    """``name, part`` of names that are patterns: the anchor of each one's longest run of letters."""
    runs = names.select(F.col(name).alias("pattern"), literal_run(F.col(name)).alias("run")).distinct()
    found = anchors(runs, "run").withColumnRenamed("name", "run")
    return runs.join(found, "run").select(F.col("pattern").alias("name"), "part")
