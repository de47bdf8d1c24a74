"""Near copies: every pair of texts whose word shingles have Jaccard similarity 0.8 or more is linked, SimHash links first.

Words are lower-cased (A-Z) runs between white space; a text is the set of its shingles of `size` words, as 64-bit hashes; fewer words give
one shingle, none the shingle of nothing.

First the SimHash fingerprints of the same shingles are linked by vantage-point trees (`simhash`), and each link is verified on both texts.
Such links join large groups of close copies without their pairs, but a pair at 0.8 may differ in up to a third of the bits, where no
block choice prunes. What they leave apart is found by prefix filtering, which loses none: with all shingles in one global order, two
sets at 4/5 or more share one of the first n - ceil(4n/5) + 1 of each. The order puts shingles of rare hash buckets first; it steers cost only,
never the result. Texts that share a first shingle are compared with one leader for each such shingle. Where a shingle then still has
several components, pairs of different components go through a join that has three exact bounds in its condition: set sizes, places of the shared
shingle, and parity sketches (each shingle flips one of SKETCH_BITS bits, so sketches differ in no more bits than the sets differ in
shingles). Only pairs that pass become rows. Every link is verified by counting shared shingles of both texts.

Defined results: null and blank texts are equal to each other; repeated rows give one row each; rows with null doc_id take part but never
name a component unless it has no other row; links are symmetric, so ties cannot change a component; a very long text costs its own shingles in one
task; an empty table gives no rows. `drop_near` tells rows apart by doc_id and text, so null and repeated ids lose no other row; rows that repeat doc_id and
text of the one that stays stay too; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.llm import common, graph, simhash

SHINGLE = 5
#: Hash buckets of the global order: a fixed bound on what is counted and broadcast.
BUCKETS = 1 << 16
STAR_ROUNDS = 3
SKETCH_BITS = 1024


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; never empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts, ends[size - 1:].tolist(), strict=False)], np.uint64))


def _key(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes())


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Jaccard similarity of 4/5 or more, in whole numbers."""
    return 9 * len(np.intersect1d(left, right, assume_unique=True)) >= 4 * (len(left) + len(right))


def _bucket_counts(texts: DataFrame, size: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += np.bincount((shingles(t.as_py(), size) % BUCKETS).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def _sketch(found: np.ndarray) -> np.ndarray:
    """Parity of the shingles dealt to each bit, as longs."""
    bits = np.bincount((found >> np.uint64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _prefixes(docs: DataFrame, text: str, doc_id: str, size: int) -> DataFrame:
    """(doc_id, h0, h1, key, n, first, fp, sketch): mark of the text, key and size of the shingle set, its first shingles in the global order,
    its SimHash and its parity sketch."""
    order = docs.sparkSession.sparkContext.broadcast(_bucket_counts(docs.select(text), size))

    def run(batches):
        for batch in batches:
            keys, sizes, first, points, sketches = [], [], [], [], []
            for t in batch.column(3):
                found = shingles(t.as_py(), size)
                keys.append(_key(found))
                sizes.append(len(found))
                ranked = found[np.lexsort((found, order.value[(found % BUCKETS).astype(np.int64)]))]
                first.append(ranked[:len(found) - -(-4 * len(found) // 5) + 1].view(np.int64))
                points.append(simhash.majority(found))
                sketches.append(_sketch(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), _lists(first),
                 pa.array(np.array(points, np.uint64).view(np.int64)), _lists(sketches)],
                names=["doc_id", "h0", "h1", "key", "n", "first", "fp", "sketch"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), *common.text_marks(text), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, h0 long, h1 long, key long, n int, first array<long>, fp long, sketch array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _keyed_texts(docs: DataFrame, text: str, each: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text): one text of each of the keys, fetched by its mark."""
    asked = common.saved(each.join(keys, "key", "left_semi").groupBy("key").agg(F.min("h0").alias("h0")), "asked")
    marked, _ = common.routed(docs.select(F.xxhash64(F.coalesce(text, F.lit(""))).alias("h0"), F.col(text).alias("text")), F.col("h0"), common.marked(asked, "h0"))
    return common.saved(marked.dropDuplicates(["h0"]).join(asked, "h0").select("key", "text"), "near-texts")


def _verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches):
        for batch in batches:
            held: dict[int, np.ndarray] = {}
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            fits = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                for key, column in ((x, 2), (y, 3)):
                    if key not in held:
                        if len(held) > 1000:
                            held.clear()
                        held[key] = shingles(batch.column(column)[i].as_py(), size)
                    if key == x:
                        left = held[key]
                fits.append(similar(left, held[y]))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("left")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("right")), "b")
    return common.saved(both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long"), "similar")


def _may_fit(a: str, b: str):
    """What is left of both sets from a shared shingle on can still hold 4/5; true for the first shared shingle of any pair that fits."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    return 9 * left >= 4 * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _pair(found: DataFrame) -> DataFrame:
    return found.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def _apart() -> Column:
    """An upper bound of the similarity fits: the sketches differ in no more bits than two sets at 4/5 differ in shingles."""
    words = [F.bit_count(F.col("x.sketch")[i].bitwiseXOR(F.col("y.sketch")[i])) for i in range(SKETCH_BITS // 64)]
    return 9 * sum(words[1:], words[0]) <= F.col("x.n") + F.col("y.n")


def _simhash_pairs(each: DataFrame) -> DataFrame:
    """(a, b): keys of equal fingerprints with the least of them, and the least of linked fingerprints."""
    points = common.saved(each.groupBy("fp").agg(F.min("key").alias("low")), "points")
    near = simhash.links(points.select("fp"))
    met = near.join(points.select(F.col("fp").alias("a"), F.col("low").alias("left")), "a").join(points.select(F.col("fp").alias("b"), F.col("low").alias("right")), "b")
    pairs = met.select("left", "right").unionByName(each.join(points, "fp").select(F.col("key").alias("left"), F.col("low").alias("right")))
    return pairs.filter("left <> right").select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).distinct()


def links(each: DataFrame, docs: DataFrame, text: str, size: int, star_rounds: int = STAR_ROUNDS) -> DataFrame | None:
    """(node, root) of the components of keys that hold more than one."""
    rows = each.select("key", "n", F.posexplode("first").alias("at", "token"))
    shared = common.saved(rows.groupBy("token").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high").select("token"), "shared")
    rows = common.saved(rows.join(shared, "token").distinct(), "meeting")
    first_pairs = common.saved(_simhash_pairs(each), "pairs")
    keys = rows.select("key").union(first_pairs.select("a")).union(first_pairs.select("b")).distinct()
    texts = _keyed_texts(docs, text, each, common.saved(keys, "near-keys"))
    tried, linked, labels = [], [], None
    for turn in range(-1, star_rounds + 1):
        if labels is None:
            open_rows = rows.withColumn("label", F.col("key"))
        else:
            named = rows.join(labels, rows["key"] == labels["node"], "left").withColumn("label", F.coalesce("root", "key")).drop("node", "root")
            mixed = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token")
            open_rows = common.saved(named.join(mixed, "token"), "open")
        if turn < 0:
            pairs = first_pairs
        elif turn < star_rounds:
            x = open_rows.select("token", F.struct("key", "n", "at", "label").alias("x"))
            # each shingle has a leader of its own, so a text meets many of its group without all pairs of it
            y = open_rows.groupBy("token").agg(F.min_by(F.struct("key", "n", "at", "label"), F.xxhash64("key", "token", F.lit(turn))).alias("y"))
            pairs = _pair(x.join(y, "token").filter("x.label <> y.label").filter(_may_fit("x", "y")))
        else:
            sketches = each.select("key", "sketch").dropDuplicates(["key"])
            open_rows = common.saved(open_rows.join(sketches, "key"), "open")
            x, y = (open_rows.select("token", F.struct("key", "n", "at", "label", "sketch").alias(side)) for side in "xy")
            met = x.join(y, "token").filter("x.label <> y.label AND x.key < y.key")
            pairs = _pair(met.filter(_may_fit("x", "y") & _apart()))
        for before in tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = common.saved(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried.append(pairs)
        found = _verified(pairs, texts, size)
        if found.isEmpty():
            continue
        linked.append(found)
        every = linked[0]
        for more in linked[1:]:
            every = every.union(more)
        labels = common.saved(graph.components(every), "components")
    return labels


def _rooted(docs: DataFrame, text: str, doc_id: str, size: int) -> DataFrame:
    """(doc_id, h0, h1, key, root) of every document."""
    each = common.saved(_prefixes(docs, text, doc_id, size), "prefixes")
    labels = links(each, docs, text, size)
    rows = each.select("doc_id", "h0", "h1", "key")
    if labels is None:
        return rows.withColumn("root", F.col("key"))
    named = rows.join(labels, rows["key"] == labels["node"], "left").select("doc_id", "h0", "h1", "key", F.coalesce("root", "key").alias("root"))
    return common.saved(named, "rooted")


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, key of its shingle set, and component_id, the smallest doc_id of its component."""
    rooted = _rooted(docs, text, doc_id, size)
    least = common.saved(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return rooted.join(least, "root").select("doc_id", "key", "component_id")


def drop_near(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """One document of each component stays: the one with its smallest doc_id (null last), then text mark."""
    return common.keep_one(docs, _rooted(docs, text, doc_id, size), text, doc_id)
