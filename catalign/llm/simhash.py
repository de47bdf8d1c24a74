"""Near-duplicates by SimHash, found exactly through vantage-point trees.

Fingerprint: words are lower-cased (A-Z) runs between white space; each 3-word shingle, repeats included, gives XXH64 with seed 42; a
bit is set if more than half of the hashes have it.

Distinct fingerprints are dealt into shards: two fingerprints within `radius` bits agree on at least one choice of `blocks - radius` out of
`blocks` bit blocks (distance zero on those bits), so a shard per choice and value holds every linked pair somewhere. A shard above
SHARD_SIZE is parted by Hamming distance to a vantage point of its own into shells of radius + 1; fingerprints near the lower boundary
of their shell are also queried against the shell below, and parting goes on until shards fit. Inside a shard a vantage-point tree splits
at the median distance, and the triangle bound prunes branches: only points within `radius` of a boundary meet the other side. A
shard returns a spanning forest of its links, never all pairs; components are then joined across shards.

Defined results: null and empty texts have fingerprint zero and are linked like any other; fewer than three words give one shingle;
repeated rows give one row each; rows with null doc_id take part but never name a component unless it has no other row; ties do not occur, as
links are symmetric; a very long text is hashed in parts; an empty table gives no rows. `drop_near` tells rows apart by doc_id and text, so null
and repeated ids lose no other row; rows that repeat doc_id and text of the one that stays stay too; other columns, whatever their names,
pass through untouched.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalign.llm import common, graph

SEED, SHINGLE, RADIUS = 42, 3, 3
LEAF = 48
SHARD_SIZE = 4096
#: A shard is parted this many times at most; it is then searched as it is, exactly, by one tree.
PARTINGS = 8


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - size + 1
    if n < 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist(), strict=False)]
    return majority(np.array(hashes, np.uint64))


def majority(values: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    total, ones = len(values), np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):
        part = np.ascontiguousarray(values[at:at + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """(doc_id, h0, h1, fp): fp as a signed long beside the mark of the text."""

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), size) for t in batch.column(3)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(values.view(np.int64))], names=["doc_id", "h0", "h1", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), *common.text_marks(text), text).mapInArrow(run, f"doc_id {kind}, h0 long, h1 long, fp long")


def _distance(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


class Links:
    """A forest over positions; links inside a component cost nothing."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        apart = self.label[left] != self.label[right]
        if apart.any():
            self.held.append(np.stack([left[apart], right[apart]]))
            self.size += int(apart.sum())
            if self.size > 200_000:
                self.settle()

    def settle(self) -> np.ndarray:
        if self.held:
            left, right = np.concatenate(self.held, axis=1)
            self.held, self.size = [], 0
            label = self.label
            while True:
                a, b = label[left], label[right]
                apart = a != b
                if not apart.any():
                    break
                left, right, a, b = left[apart], right[apart], a[apart], b[apart]
                np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
                while True:
                    up = label[label]
                    if (up == label).all():
                        break
                    label = up
            self.label = label
        return self.label


def _brute(points: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, links: Links) -> None:
    i, j = np.nonzero(np.bitwise_count(points[a][:, None] ^ points[b][None, :]) <= radius)
    links.add(a[i], b[j])


def tree_links(points: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Labels of the components among the points, links at `radius` or fewer bits, by a vantage-point tree searched with itself."""
    links = Links(len(points))
    stack: list[tuple[np.ndarray, np.ndarray | None, int]] = [(np.arange(len(points)), None, 0)]
    while stack:
        a, b, failed = stack.pop()
        if b is None:
            if len(a) <= LEAF:
                if len(a) > 1:
                    _brute(points, a, a, radius, links)
                continue
            away = _distance(points[a], points[a[len(a) // 2]])
            middle = int(np.median(away))
            near = away <= middle
            if near.all():
                near = away < middle
            inner, outer = a[near], a[~near]
            if not len(inner) or not len(outer):
                for at in range(0, len(a), 256):
                    _brute(points, a[at:at + 256], a, radius, links)
                continue
            edge = int(away[near].max())
            stack += [(inner, None, 0), (outer, None, 0)]
            # triangle bound: a link across the boundary lies within radius of it on both sides
            stack.append((inner[away[near] > edge - radius], outer[away[~near] <= edge + radius], 0))
            continue
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) <= LEAF * LEAF * 4 or failed > 3:
            for at in range(0, len(a), 1024):
                _brute(points, a[at:at + 1024], b, radius, links)
            continue
        vantage = points[a[len(a) // 2]]
        to_a, to_b = _distance(points[a], vantage).astype(np.int16), _distance(points[b], vantage).astype(np.int16)
        cut = int(np.median(to_b))
        # links need |distance(a) - distance(b)| <= radius
        low_b, low_a, high_a = to_b <= cut, to_a <= cut + radius, to_a > cut - radius
        worth = low_a.sum() * low_b.sum() + high_a.sum() * (~low_b).sum() < 0.9 * len(a) * len(b)
        stack.append((a[low_a], b[low_b], 0 if worth else failed + 1))
        stack.append((a[high_a], b[~low_b], 0 if worth else failed + 1))
    return links.settle()


def _choices(n: int, radius: int) -> list[int]:
    """Bit masks of the block choices: finer the more fingerprints there are."""
    blocks = radius + (1 if n < 1 << 24 else 2 if n < 1 << 32 else 3)
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(masks, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(points: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links (a, b) that join all fingerprints `fp` (distinct rows) within `radius` bits, as stars inside shards."""
    spark = points.sparkSession
    n = points.count()
    parts = common.partitions_for(spark, n, 100_000)
    masks = F.array(*[F.lit(_signed(m)) for m in _choices(n, radius)])
    keyed = points.select("fp", F.posexplode(masks).alias("choice", "mask"))
    open_shards = keyed.select("fp", F.xxhash64("choice", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard"))
    for level in range(PARTINGS):
        large = open_shards.groupBy("shard").agg(F.count("*").alias("n"), F.min_by("fp", F.xxhash64("fp", F.lit(level))).alias("vantage"))
        large = common.saved(large.filter(F.col("n") > shard_size).select("shard", "vantage"), "vantage")
        if large.isEmpty():
            break
        large = common.small_side(large)
        away = F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage")))
        width = radius + 1
        shells = F.when(away % width < radius, F.array((away / width).cast("int"), (away / width).cast("int") - 1)).otherwise(F.array((away / width).cast("int")))
        parted = open_shards.join(large, "shard").select("fp", "shard", F.explode(shells).alias("shell"))
        open_shards = common.saved(open_shards.join(large, "shard", "left_anti").select("fp", "shard").union(
            parted.select("fp", F.xxhash64("shard", F.lit(level), "shell").alias("shard"))), "shards")

    def search(batches):
        shard, fp = [], []
        for batch in batches:
            shard.append(np.asarray(batch.column(0)))
            fp.append(np.asarray(batch.column(1)).view(np.uint64))
        if not shard:
            return
        shards, values = np.concatenate(shard), np.concatenate(fp)
        order = np.lexsort((values, shards))
        shards, values = shards[order], values[order]
        cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1], True])
        left, right = [], []
        sizes = np.diff(cuts)
        pairs = cuts[:-1][sizes == 2]
        close = _pair_close(values, pairs, radius)
        left.append(values[close + 1])
        right.append(values[close])
        for a, size in zip(cuts[:-1][sizes > 2], sizes[sizes > 2], strict=True):
            here = values[a:a + size]
            label = tree_links(here, radius)
            hung = np.flatnonzero(label != np.arange(size))
            if len(hung):
                left.append(here[hung])
                right.append(here[label[hung]])
        a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
        for at in range(0, len(a), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[at:at + 50_000]), pa.array(b[at:at + 50_000])], names=["a", "b"])

    return open_shards.repartition(parts, "shard").select("shard", "fp").mapInArrow(search, "a long, b long")


def _pair_close(values: np.ndarray, at: np.ndarray, radius: int) -> np.ndarray:
    return at[np.bitwise_count(values[at] ^ values[at + 1]) <= radius]


def _rooted(docs: DataFrame, text: str, doc_id: str, radius: int, size: int) -> tuple[DataFrame, DataFrame]:
    """((doc_id, h0, h1, fp) of the documents, (fp, root, least doc_id) of the distinct fingerprints)."""
    each = common.saved(fingerprints(docs, text, doc_id, size), "fingerprints")
    distinct = common.saved(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    found = common.saved(graph.components(links(distinct.select("fp"), radius)), "components")
    return each, distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fp (signed) and component_id."""
    each, rooted = _rooted(docs, text, doc_id, radius, size)
    least = common.saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = common.saved(rooted.join(least, "root").select("fp", "component_id"), "named")
    return each.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One document of each component stays: the one with its smallest doc_id (null last), then text mark."""
    each, rooted = _rooted(docs, text, doc_id, radius, size)
    return common.keep_one(docs, common.saved(each.join(rooted.select("fp", "root"), "fp").select("doc_id", "h0", "h1", "root"), "rooted"), text, doc_id)
