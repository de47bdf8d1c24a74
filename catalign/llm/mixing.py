"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: how often the mix should repeat it. Of all rates that meet each source's token target, entropy
balancing takes those nearest to the even rate in relative entropy (weighted by tokens), with no rate above `most` copies.
The convex dual has one multiplier per source; a document's rate is exp(multiplier), cut at `most`. As every constraint is on
one source, the dual separates: a Newton step moves each source's multiplier by its own tilted tokens, which are its token sum over all
documents, added up once in Spark, times its rate; the solution is the logarithm of target over size. Multipliers and totals are a table keyed by
source and nothing is collected. Rates then become whole copies: inside each block of a source, from the longest document
to the shortest, the rounding error in tokens is carried on, so a source misses its target by about its shortest documents.

Defined results: null text has size 0 and no tokens to take; a null source is a source of its own, last in order; sources of size 0 have
target 0; ties are ordered by doc_id, then text hash; rows that repeat
doc_id, text and source get the same number of copies; an empty table gives no rows; the same
rows give the same mix on every run, however they are dealt out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalign.llm import common

# Fixed value: a word is a run of anything but these.
WORDS = r"[^\x20\x09-\x0D]+"
#: Documents of one block of a source, about: one rounding task holds so many sizes.
BLOCK_ROWS = 1024
MOST_COPIES = 3
WEIGHTS = (1, 2, 3)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with `size`, their number of words."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long"))


def source_totals(rows: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, n_docs and weight, weights repeating over the sources by code point, null last."""
    totals = rows.groupBy(F.col(source).alias("source")).agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n_docs"))
    schema = totals.schema.add("position", "long", False)
    ordered = totals.orderBy(F.col("source").isNull(), F.col("source"))
    numbered = totals.sparkSession.createDataFrame(ordered.rdd.zipWithIndex().map(lambda r: (*r[0], r[1])), schema)
    return numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int")).cast("double"))


def with_targets(totals: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Add `target`: weights share all tokens; a source stops at `most` times its size and the excess is shared out again."""
    frame = totals.withColumn("cap", F.col("source_size") * float(most)).withColumn("full", F.col("source_size") == 0)
    while True:
        sums = frame.agg(F.sum("source_size").alias("all"), F.sum(F.when(F.col("full"), F.col("cap"))).alias("held"),
                         F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open"), F.count(F.when(F.col("full"), 1)).alias("n")).first()
        unit = ((sums["all"] or 0) - (sums["held"] or 0.0)) / sums["open"] if sums["open"] else 0.0
        frame = frame.withColumn("full", F.col("full") | (F.col("weight") * unit > F.col("cap")))
        if frame.filter("full").count() == sums["n"]:
            return frame.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * unit)).drop("cap", "full", "position")
        frame = common.saved(frame, "shares")


def multipliers(sources: DataFrame, most: int = MOST_COPIES, tolerance: float = 1e-9) -> DataFrame:
    """Add `multiplier` by Newton steps on the dual.

    The dual of a source is tokens * exp(m) - m * target: its slope is tilted tokens minus target and its curvature the tilted tokens.
    The token sums it needs come from all documents and stay distributed; a job takes several steps before it looks at the misses.
    """
    cap = math.log(most)
    state = common.saved(sources.withColumn("multiplier", F.lit(0.0)), "dual")
    for _ in range(20):
        for _ in range(6):
            tilted = F.col("source_size") * F.exp("multiplier")
            move = F.when(tilted > 0, (tilted - F.col("target")) / tilted).otherwise(0.0)
            damped = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), move))
            state = state.withColumn("multiplier", F.least(F.col("multiplier") - damped, F.lit(cap)))
        state = common.saved(state, "dual")
        miss = F.abs(F.col("source_size") * F.exp("multiplier") - F.col("target")) / F.greatest("target", F.lit(1.0))
        if (state.filter("source_size > 0").agg(F.max(miss)).first()[0] or 0.0) < tolerance:
            return state
    raise ValueError("the dual did not converge")


def balanced(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", most: int = MOST_COPIES) -> DataFrame:
    """One row for each (doc_id, text, source): text_hash, rows (how often the row occurs), size, source_size, target, copies, taken."""
    rows = sized(docs, text).select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"), "size")
    units = common.saved(rows.groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("rows")), "sizes")
    totals = common.saved(source_totals(units, "source"), "sources")
    rates = multipliers(with_targets(totals, most), most).select(
        F.col("source").alias("_source"), "source_size", "target", "multiplier", "n_docs")
    known = units.join(common.small_side(rates), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    blocks = known.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_hash"), F.ceil(F.col("n_docs") / BLOCK_ROWS)))

    def round_block(table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy() * table.column("rows").to_numpy()
        ids, hashes = table.column("doc_id").to_pandas().fillna(-1).to_numpy(), table.column("text_hash").to_numpy()
        rate = min(float(most), math.exp(table.column("multiplier")[0].as_py()))
        low, high = math.floor(rate + 1e-9), math.ceil(rate - 1e-9)
        copies, carry = np.zeros(len(size), np.int64), 0.0
        for i in np.lexsort((hashes, ids, -size)):
            if size[i] == 0:
                copies[i] = min(most, math.floor(rate + 0.5))
                continue
            want = rate * size[i] + carry
            copies[i] = min(high, max(low, math.floor(want / size[i] + 0.5)))
            carry = want - copies[i] * size[i]
        return table.drop_columns(["multiplier", "n_docs", "block"]).append_column("copies", pa.array(copies))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema if f.name not in ("multiplier", "n_docs", "block"))
    rounded = blocks.groupBy("source", "block").applyInArrow(round_block, schema + ", copies long")
    return rounded.withColumn("taken", F.col("copies") * F.col("size"))


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    units = balanced(docs).withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return units.select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The mix itself: every document as often as its copies say, with `copy` from 1; documents with no copy are left out.

    A column named `copy` in the input is replaced; all others pass through untouched, whatever their names."""
    chosen = balanced(docs, source, text, doc_id).filter("copies > 0").select("doc_id", "source", "text_hash", "copies")
    asked = common.packed(docs, docs[doc_id].alias("d"), docs[source].alias("s"), F.xxhash64(docs[text]).alias("h"))
    found = asked.join(chosen, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")) & F.col("s").eqNullSafe(F.col("source")))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "copy"]
    return found.select(*kept, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
