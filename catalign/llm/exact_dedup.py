"""Exact deduplication through counting quotient filters.

Every partition packs the 64-bit fingerprints of its texts into counting quotient filters, one per fingerprint range: the
high bits of a fingerprint name the range and the quotient, the rest is the remainder; a filter holds an occupied bit per
quotient, a run-end bit per slot, the sorted remainders and the counts. Nothing of a fingerprint is lost, so filters of one
range merge by their sorted remainders, and counts add up exactly. Texts whose fingerprint counts more than one go on to
byte verification: grouping by the text itself, which Spark combines inside each partition, so thousands of copies travel
as one row per partition.

Defined results: null text counts as empty and equals the empty text; of equal texts the row with the largest doc_id stays
(null doc_ids are smallest; if all are null keep_id is null); rows that repeat a kept doc_id and its text are all marked
kept, and `drop_copies` leaves one of them; ties therefore cannot change a result; a very long text is compared whole, by its bytes; an
empty table gives no rows; other columns, whatever their names, pass through `drop_copies` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.llm import common

#: Fingerprints that one merging task holds, about.
RANGE_SIZE = 100_000


class QuotientFilter:
    """Sorted fingerprints with counts, as quotient runs of remainders."""

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray) -> None:
        self.fingerprints, self.counts = fingerprints, counts

    @classmethod
    def of(cls, values: np.ndarray) -> QuotientFilter:
        return cls(*np.unique(values, return_counts=True))

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Lossless: equal (quotient, remainder) pairs add their counts."""
        both = np.concatenate([self.fingerprints, other.fingerprints])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([self.counts, other.counts])[order]
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
        return QuotientFilter(both[first], np.add.reduceat(counts, first) if len(first) else counts)

    def pack(self, range_bits: int) -> bytes:
        n = len(self.fingerprints)
        q = max(1, n.bit_length())
        low = 64 - range_bits
        q = min(q, low - 1)
        body = self.fingerprints & np.uint64((1 << low) - 1)
        quotient = (body >> np.uint64(low - q)).astype(np.int64)
        width = (low - q + 7) // 8
        remainder = body & np.uint64((1 << (low - q)) - 1)
        occupied = np.zeros(1 << q, np.uint8)
        occupied[quotient] = 1
        run_end = np.r_[quotient[1:] != quotient[:-1], True].astype(np.uint8)
        many = self.counts > 1
        return b"".join([
            n.to_bytes(8, "little"), q.to_bytes(1, "little"), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
            np.ascontiguousarray(remainder.view(np.uint8).reshape(n, 8)[:, :width]).tobytes(),
            np.packbits(many).tobytes(), self.counts[many].astype(np.uint64).tobytes()])

    @classmethod
    def unpack(cls, data: bytes, prefix: int, range_bits: int) -> QuotientFilter:
        n, q = int.from_bytes(data[:8], "little"), data[8]
        low = 64 - range_bits
        width, at = (low - q + 7) // 8, 9

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.flatnonzero(np.unpackbits(take(((1 << q) + 7) // 8))[: 1 << q])
        run_end = np.unpackbits(take((n + 7) // 8))[:n]
        remainder = np.zeros((n, 8), np.uint8)
        remainder[:, :width] = take(n * width).reshape(n, width)
        many = np.unpackbits(take((n + 7) // 8))[:n].astype(bool)
        counts = np.ones(n, np.int64)
        counts[many] = np.frombuffer(data, np.uint64, int(many.sum()), at)
        run = np.cumsum(run_end) - run_end
        quotient = occupied[run].astype(np.uint64)
        body = (quotient << np.uint64(low - q)) | remainder.reshape(-1).view(np.uint64)
        return cls((np.uint64(prefix) << np.uint64(low)) | body if range_bits else body, counts)


def partition_filters(fingerprints: DataFrame, range_bits: int) -> DataFrame:
    """One packed filter per partition and fingerprint range: (range, filter)."""

    def pack(batches):
        values = [np.asarray(b.column(0)).view(np.uint64) for b in batches]
        held = QuotientFilter.of(np.concatenate(values)) if values else None
        if held is None or not len(held.fingerprints):
            return
        prefix = held.fingerprints >> np.uint64(64 - range_bits)
        cuts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1], True])
        for at in range(0, len(cuts) - 1, 256):
            rows = [(int(prefix[a]), QuotientFilter(held.fingerprints[a:b], held.counts[a:b]).pack(range_bits))
                    for a, b in zip(cuts[at:at + 256], cuts[at + 1:at + 257], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                             names=["range", "filter"])

    return fingerprints.mapInArrow(pack, "range long, filter binary")


def repeated_fingerprints(filters: DataFrame, range_bits: int) -> DataFrame:
    """Fingerprints whose merged count exceeds one: (fp, n)."""

    def merge(table: pa.Table) -> pa.Table:
        prefix = table.column("range")[0].as_py()
        parts = [QuotientFilter.unpack(f, prefix, range_bits) for f in table.column("filter").to_pylist()]
        while len(parts) > 1:
            parts = [parts[i].merge(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        many = parts[0].counts > 1
        return pa.table({"fp": pa.array(parts[0].fingerprints[many].view(np.int64)), "n": pa.array(parts[0].counts[many])})

    return filters.groupBy("range").applyInArrow(merge, "fp long, n long")


def _text(frame: DataFrame, column: str) -> Column:
    return F.coalesce(frame[column], F.lit(""))


def _repeats(docs: DataFrame, text: str) -> DataFrame:
    """Bucket numbers of the fingerprints that occur more than once."""
    # counting rows reads no text; it only sets how many ranges the filters are dealt over
    n = docs.count()
    range_bits = max(4, (n // RANGE_SIZE).bit_length())
    fingerprints = docs.select(F.xxhash64(_text(docs, text)).alias("fp"))
    merged = repeated_fingerprints(partition_filters(fingerprints, range_bits), range_bits)
    return common.saved(common.marked(merged, "fp"), "repeats")


def _groups(suspects: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Byte verification: (text_sha256, keep_id, group_size) of the texts that really occur more than once."""
    whole = suspects.select(_text(suspects, text).alias("t"), suspects[doc_id].alias("d"))
    equal = whole.groupBy("t").agg(F.max("d").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    return common.saved(equal.select(F.sha2("t", 256).alias("text_sha256"), "keep_id", "group_size"), "copies")


def copy_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    buckets = _repeats(docs, text)
    suspects, _ = common.routed(docs.select(doc_id, text), F.xxhash64(_text(docs, text)), buckets)
    groups = _groups(suspects, text, doc_id)
    rows = docs.select(docs[doc_id].alias("doc_id"), F.sha2(_text(docs, text), 256).alias("text_sha256"))
    found = rows.join(groups, "text_sha256", "left")
    size = F.coalesce("group_size", F.lit(1))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), size.cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without further copies; texts that occur once never leave their partition."""
    buckets = _repeats(docs, text)
    whole = _text(docs, text)
    rows = common.packed(docs, docs[doc_id].alias("id"), F.xxhash64(whole).alias("fp"), F.sha2(whole, 256).alias("sha"))
    suspects, single = common.routed(rows, F.col("fp"), buckets)
    groups = _groups(suspects.select(F.col("row")[text].alias("text"), F.col("id").alias("doc_id")), "text", "doc_id")
    found = suspects.join(groups.select(F.col("text_sha256").alias("sha"), "keep_id", "group_size"), "sha", "left")
    alone = found.filter("group_size IS NULL").select("row")
    stays = found.filter(F.col("group_size").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("sha").agg(F.first("row").alias("row")).select("row")
    return single.select("row").unionByName(alone).unionByName(stays).select("row.*")
