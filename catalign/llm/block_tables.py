"""Weighted SimHash fingerprints and permuted block tables, with Spark expressions only.

Terms are adjacent pairs of lower-cased words (runs between white space; a lone word is its own term); a term that occurs c times weighs as
many as c has binary digits. The XXH64 hash of a term votes with its weight for or against each bit of WORDS * 64; a bit is set if more than half of
the weight is for it. Votes are added in packed counters that are carried on before they can overflow.

`near_fingerprints` finds every fingerprint within `radius` bits of a query: two such fingerprints agree on one of any radius + 1 blocks that the
bits are parted into, so the first tables hold each fingerprint once for each block, keyed by it. Keys that more than HOT fingerprints share are
keyed on: their rows go to further tables by another way of parting all bits, LEVELS times at most, which loses nothing; a pair is taken
from the first table of each level in which it agrees, so once. Distances are counted on whole fingerprints.

`spliced` pairs each document with the next one by descending doc_id (after the last: the first). Ranges of doc_id, with bounds from a sample
that steer cost only, are ordered inside windows; a doc_id that holds several ranges is parted further by the hash of its text and its equal rows travel
as one with a count. The first and the last row of each range meet in a table of one row per range.

Defined results: null text is empty; an empty or blank text has fingerprint zero and is like any other; rows of equal doc_id follow one another
by the hash of their text, then the text; null doc_ids come last; a table of one row is followed by itself; an empty table gives no
rows; a very long text costs memory in proportion to its words in one row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.llm import common

WORDS = 2
BITS = 64 * WORDS
RADIUS = 3
HOT, LEVELS = 256, 3
#: Ranges of doc_id: about so many rows each, at least eight for each shuffle partition, and a bound on their number.
RANGE_ROWS, MOST_RANGES, SAMPLED = 20_000, 1 << 16, 20
NIBBLES, BYTES = 0x1111111111111111, 0x0F0F0F0F0F0F0F0F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def terms(text: Column) -> Column:
    """array<struct<h, n>>: distinct term hashes and how often each occurs."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def pairs(h: Column) -> Column:
        n = F.size(h) - 1
        return F.when(n < 1, h).otherwise(F.zip_with(F.slice(h, 1, F.greatest(n, F.lit(0))), F.slice(h, 2, F.greatest(n, F.lit(0))),
                                                     lambda a, b: F.xxhash64(a, b)))

    def runs(found: Column) -> Column:
        starts = F.filter(F.transform(found, lambda h, i: F.when((i == 0) | (F.get(found, i - 1) != h), i)), lambda i: i.isNotNull())
        return let(starts, lambda at: F.transform(at, lambda s, j: F.struct(
            F.get(found, s).alias("h"), (F.coalesce(F.get(at, j + 1), F.size(found)) - s).alias("n"))))

    return let(F.array_sort(let(F.transform(words, lambda w: F.xxhash64(w)), pairs)), runs)


def _word(hashes: Column) -> Column:
    """The majority of the hashes, bit by bit: counters of four bits over 7 hashes, of eight bits over 18 of these (the sign bit stays free), then one for each bit."""
    zeros = lambda n: F.array_repeat(F.lit(0).cast("long"), n)
    begins = lambda of, step: F.sequence(F.lit(1), F.greatest(F.size(of), F.lit(1)), F.lit(step))

    def fours(part: Column) -> Column:
        return F.aggregate(part, zeros(4), lambda acc, h: F.array(*[acc[i] + _shifted(h, i).bitwiseAND(F.lit(NIBBLES)) for i in range(4)]))

    def eights(part: Column) -> Column:
        return F.aggregate(part, zeros(8), lambda acc, four: F.array(*[acc[i] + _shifted(four[i % 4], i // 4 * 4).bitwiseAND(F.lit(BYTES)) for i in range(8)]))

    def add(counts: Column, eight: Column) -> Column:
        return F.zip_with(counts, F.sequence(F.lit(0), F.lit(63)), lambda c, b: c + F.call_function(
            "shiftrightunsigned", F.get(eight, b % 8), (b / 8).cast("int") * 8).bitwiseAND(F.lit(255)))

    packed = F.transform(begins(hashes, 7), lambda at: fours(F.slice(hashes, at, F.lit(7))))
    counts = let(packed, lambda p: F.aggregate(begins(p, 18), zeros(64), lambda acc, at: let(eights(F.slice(p, at, F.lit(18))), lambda eight: add(acc, eight))))
    bits = F.transform(counts, lambda c, b: F.when(2 * c > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _shifted(value: Column, by: int) -> Column:
    return F.shiftrightunsigned(value, by) if by else value


def fingerprint(text: Column) -> Column:
    """The fingerprint as array<long>, WORDS entries, lowest bits first."""
    votes = F.flatten(F.transform(terms(text), lambda t: F.array_repeat(t["h"], F.length(F.bin(t["n"])))))
    rehashed = lambda h, k: F.transform(h, lambda x: F.xxhash64(x, F.lit(k))) if k else h
    return let(votes, lambda h: F.array(*[let(rehashed(h, k), _word) for k in range(WORDS)]))


def as_hex(fp: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(fp[k]), 16, "0") for k in reversed(range(WORDS))]))


def distance(a: Column, b: Column) -> Column:
    return sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(1, WORDS)), F.bit_count(a[0].bitwiseXOR(b[0])))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, about 1/2 for unrelated ones."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def _masks(radius: int, level: int) -> list[list[int]]:
    """For each of radius + 1 blocks its bits in each word: contiguous on level 0, then by digits of the bit number."""
    blocks = radius + 1
    block = lambda bit: bit * blocks // BITS if level == 0 else bit // blocks ** (level - 1) % blocks
    masks = [[sum(1 << (bit % 64) for bit in range(64 * k, 64 * k + 64) if block(bit) == b) for k in range(WORDS)] for b in range(blocks)]
    return [[m - (1 << 64) if m >> 63 else m for m in mask] for mask in masks]


def _tables(rows: DataFrame, radius: int, level: int) -> DataFrame:
    """Each row once for every block of the level: `key` goes on with the block's bits, `took` with its number."""
    blocks = F.array(*[F.struct(F.lit(i).alias("b"), *[F.lit(m).alias(f"m{k}") for k, m in enumerate(mask)]) for i, mask in enumerate(_masks(radius, level))])
    keyed = rows.withColumn("block", F.explode(blocks))
    bits = [F.col("fp")[k].bitwiseAND(F.col("block")[f"m{k}"]) for k in range(WORDS)]
    return keyed.withColumns({"key": F.xxhash64("key", "block.b", *bits), "took": F.concat("took", F.array("block.b"))}).drop("block")


def _first_agreed(radius: int, level: int, a: str, b: str) -> Column:
    apart = [F.col(f"{a}.fp")[k].bitwiseXOR(F.col(f"{b}.fp")[k]) for k in range(WORDS)]
    found = F.lit(None).cast("int")
    for i, mask in reversed(list(enumerate(_masks(radius, level)))):
        equal = F.lit(True)
        for k, m in enumerate(mask):
            equal = equal & (apart[k].bitwiseAND(F.lit(m)) == 0)
        found = F.when(equal, F.lit(i)).otherwise(found)
    return found


def near_fingerprints(queries: DataFrame, points: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(fp, near, distance): for every `fp` of queries all fingerprints `fp` of points within `radius` bits; both hold distinct rows."""
    start = [F.lit(0).cast("long").alias("key"), F.array().cast("array<int>").alias("took")]
    asked, held = queries.select("fp", *start), points.select("fp", *start)
    done = []
    for level in range(LEVELS):
        asked, held = _tables(asked, radius, level), common.saved(_tables(held, radius, level), "block-tables")
        if level < LEVELS - 1:
            full = common.saved(held.groupBy("key").count().filter(F.col("count") > hot).select("key"), "hot-blocks")
            if not full.isEmpty():
                full = common.small_side(full)
                done.append((asked.join(full, "key", "left_anti"), held.join(full, "key", "left_anti"), level))
                asked, held = asked.join(full, "key", "left_semi"), held.join(full, "key", "left_semi")
                continue
        done.append((asked, held, level))
        break
    found = None
    for q, p, level in done:
        on = (F.col("q.key") == F.col("p.key")) & (distance(F.col("q.fp"), F.col("p.fp")) <= radius)
        for i in range(level + 1):
            on = on & (F.col("q.took")[i] == F.col("p.took")[i]) & (F.col("q.took")[i] == _first_agreed(radius, i, "q", "p"))
        met = q.alias("q").join(p.alias("p"), on).select(F.col("q.fp").alias("fp"), F.col("p.fp").alias("near"), distance(F.col("q.fp"), F.col("p.fp")).alias("distance"))
        found = met if found is None else found.union(met)
    return found


def _ranges(docs: DataFrame, doc_id: str) -> tuple[list[int], list[int]]:
    """(bounds of the ranges, descending; doc_ids that hold more than one range)."""
    spark = docs.sparkSession
    n = docs.count()
    ranges = min(MOST_RANGES, max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // RANGE_ROWS))
    ids = docs.select(F.col(doc_id).cast("long").alias("d")).filter("d IS NOT NULL")
    share = ranges * SAMPLED / max(n, 1)
    # at most about SAMPLED ids for each range come to the driver
    drawn = np.sort(np.array((ids.sample(share, 7) if share < 1 else ids).toArrow().column("d"), np.int64))[::-1]
    picks = drawn[::max(1, len(drawn) // ranges)]
    bounds, times = np.unique(picks, return_counts=True)
    return bounds[::-1].tolist(), bounds[times > 1].tolist()


def _place(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at or above the doc_id, found in two steps of at most about 256 comparisons."""
    as_array = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")
    if not bounds:
        return F.lit(0)
    every, heads = as_array(bounds), as_array(bounds[::256])
    coarse = F.greatest(F.size(F.filter(heads, lambda h: h >= doc_id)) - 1, F.lit(0)) * 256
    return let(coarse, lambda at: at + F.size(F.filter(F.slice(every, at + 1, F.lit(256)), lambda b: b >= doc_id)))


def spliced(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_chars, fp, edited_sha256, edited_fp, next_fp.

    The edited text keeps all but the last half (rounded down) of the code points and goes on with as many of the next document's first.
    """
    bounds, hot = _ranges(docs, doc_id)
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    full = F.col("doc_id").isNull() | F.col("doc_id").isin(hot) if hot else F.col("doc_id").isNull()
    tie = F.xxhash64("text")
    one = F.lit(1).cast("long").alias("copies")
    cold = rows.filter(~full).select("doc_id", "text", one, F.lit(0).alias("sub"), (2 * _place(F.col("doc_id"), bounds)).alias("part"))
    shared = rows.filter(full).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    shared = shared.select("doc_id", "text", "copies", F.shiftrightunsigned(tie, 52).cast("int").alias("sub"),
                           F.when(F.col("doc_id").isNull(), 2 * len(bounds) + 1).otherwise(2 * _place(F.col("doc_id"), bounds) - 1).alias("part"))
    placed = cold.union(shared).withColumn("fp", fingerprint(F.col("text")))
    order = Window.partitionBy("part", "sub").orderBy(F.col("doc_id").desc_nulls_last(), F.shiftrightunsigned(tie, 52), tie, "text")
    follows = F.struct("text", "fp")
    looked = placed.select("*", F.lead(follows).over(order).alias("next"), F.lag(F.lit(True)).over(order).isNull().alias("is_first"))
    looked = looked.withColumn("is_last", F.col("next").isNull())
    itself = F.struct(follows.alias("next"), (F.col("copies") - 1).alias("times"), F.lit(False).alias("is_first"), F.lit(False).alias("is_last"))
    after = F.struct(F.col("next"), one.alias("times"), F.col("is_first"), F.col("is_last"))
    paired = looked.select("doc_id", "text", "fp", "part", "sub", F.explode(F.when(F.col("copies") > 1, F.array(after, itself)).otherwise(F.array(after))).alias("p"))
    done = _edited(paired.select("doc_id", "text", "fp", "part", "sub", F.col("p.times"), F.col("p.is_first"), F.col("p.is_last"),
                                 F.col("p.next.text").alias("next_text"), F.col("p.next.fp").alias("next_fp")),
                   "times", "part", "sub", "is_first", "is_last", F.when(F.col("is_first") | F.col("is_last"), F.col("text")).alias("text"))
    done = common.saved(done, "spliced")

    # one row per range from here on
    heads = done.filter("is_first").select("part", "sub", F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    line = Window.orderBy("part", "sub")
    here = F.struct("part", "sub")
    keys = heads.select("part", "sub", F.coalesce(F.lead(here).over(line), F.first(here).over(line)).alias("after"))
    heads = heads.select(F.struct("part", "sub").alias("after"), "next_text", "next_fp")
    ends = done.filter("is_last").drop("edited_sha256", "edited_fp", "next_fp").join(keys, ["part", "sub"]).join(heads, "after")
    every = done.filter("NOT is_last").drop("part", "sub", "is_first", "is_last", "text").unionByName(_edited(ends, "times"))
    return every.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_chars", "fp", "edited_sha256", "edited_fp", "next_fp", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).drop("copy")


def _edited(pairs: DataFrame, *more) -> DataFrame:
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", 1, n - half), F.substring("next_text", F.lit(1), half))
    cut = pairs.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"), *more)
    return cut.select(*[c for c in cut.columns if c != "edited"], F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fp"))


def near_counts(rows: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, n_near): for each fingerprint `fp` of queries how many of `rows` (column fp) have a fingerprint within `radius` bits."""
    points = common.saved(rows.groupBy("fp").agg(F.count("*").alias("n")), "points")
    found = near_fingerprints(queries.select("fp").distinct(), points.select("fp"), radius)
    return found.join(points.select(F.col("fp").alias("near"), "n"), "near").groupBy("fp").agg(F.sum("n").alias("n_near"))


def digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """The rows of `spliced` with likenesses, and for every doc_id divisible by 100 the number of rows within `radius` bits, itself included."""
    rows = common.saved(spliced(docs, text, doc_id), "fingerprints")
    asked = F.pmod(F.col("doc_id").cast("long"), F.lit(100)) == 0
    counts = near_counts(rows.select("fp"), rows.filter(asked).select("fp"), radius)
    done = rows.select("doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), F.when(asked, F.col("fp")).alias("asked"))
    # the other rows have no part in the join, where all of them would have one key
    counted = done.filter("asked IS NOT NULL").join(counts.withColumnRenamed("fp", "asked"), "asked", "left")
    return counted.drop("asked").unionByName(done.filter("asked IS NULL").drop("asked").withColumn("n_near", F.lit(None).cast("long")))
