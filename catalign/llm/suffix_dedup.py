"""Removal of repeated byte strings with distributed suffix arrays.

A byte goes if a string of WINDOW bytes covers it that also starts anywhere else, in the same text or another. Every string of that length
holds an anchor, the smallest hash among its n-grams; equal strings hold equal anchors. A text is thus cut into runs of windows with one
anchor each, and only runs that share an anchor have to meet:

1. anchors are counted over all texts; where one occurs once, nothing repeats, and where all its runs are equal, all repeats;
2. the other runs are dealt out by anchor, each distinct run once, and put into suffix arrays of bounded chunks by two-stage sorting: only
   suffixes smaller than their successors are sorted directly, the rest is induced by one scan over the buckets of first bytes; adjacent
   windows with a common prefix of WINDOW bytes repeat;
3. an anchor with more than HOT_RUNS distinct runs (a line that stands in many different surroundings) is not collected: its runs become the
   texts of a further round with longer n-grams, which take in the surroundings; with n-grams of WINDOW bytes nothing is left to sort.

Results are judged on the input and are exact up to collisions of 128-bit keys. Which anchors repeat is also broadcast as a bitmap of at most
MAX_BITS bits that only saves emitting runs that cannot repeat; a join decides.

Defined results: null text is empty; texts shorter than WINDOW lose nothing; ties, repeated rows and null ids are just further texts; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.llm import common

WINDOW = 200
#: n-gram lengths of the rounds.
GRAMS = (32, 128, WINDOW)
HOT_RUNS = 1024
CHUNK_BYTES = 1 << 18
MAX_BITS = 1 << 27
#: Window starts of a piece of a long text, at most.
PIECE_STARTS = 1 << 18

_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 20) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, PIECE_STARTS + WINDOW + 1), _powers(pow(_BASE, -1, 1 << 64), PIECE_STARTS + WINDOW + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def runs(data: bytes, gram: int):
    """Yield (starts, numbers of window starts, anchors, run hashes) for the pieces of a text; every window start is in one run."""
    for at in range(0, len(data) - WINDOW + 1, PIECE_STARTS):
        piece = np.frombuffer(data, np.uint8, min(PIECE_STARTS + WINDOW - 1, len(data) - at), at)
        n = len(piece)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[piece] * _UP[:n], out=prefix[1:])
        hashes = _mixed((prefix[gram:] - prefix[:-gram]) * _DOWN[:n - gram + 1])
        # the low bits hold the place, so a window's anchor is one place: the leftmost of equal ones
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width, have = WINDOW - gram + 1, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        begin = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        size = np.diff(np.r_[begin, len(least)])
        anchor = hashes[(least[begin] & _PLACE).astype(np.int64)]
        whole = (prefix[begin + size - 1 + WINDOW] - prefix[begin]) * _DOWN[begin]
        yield at + begin, size, anchor, _mixed(whole + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def suffix_array(codes: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """Suffixes of `codes` (0 ends a text, bytes are 1 to 256) in the order of their first `depth` codes, by two-stage sorting."""
    n = len(codes)
    # a suffix is smaller than its successor if its first code is, or is equal to a code whose suffix is
    step = np.sign(codes[1:].astype(np.int32) - codes[:-1])
    step = np.r_[step, 1]
    known = np.where(step != 0, np.arange(n), n)
    smaller = step[np.minimum.accumulate(known[::-1])[::-1]] > 0
    text = codes.astype(">u2").tobytes() if codes.max(initial=0) > 255 else codes.astype(np.uint8).tobytes()
    wide = len(text) // max(n, 1)
    direct = np.flatnonzero(smaller).tolist()
    if wide == 1:
        direct.sort(key=lambda i: text[i:i + depth])
    else:
        direct.sort(key=lambda i: text[2 * i:2 * (i + depth)])
    direct = np.array(direct, np.int64)
    first = codes[direct]
    cut = np.searchsorted(first, np.arange(258))
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for code in range(257):
        own = induced[code]
        if own:
            # what a bucket induces in itself: runs of the same code, one longer in each turn
            last = np.concatenate(own)
            own = [last]
            while len(last):
                last = last[last > 0] - 1
                last = last[(codes[last] == code) & ~smaller[last]]
                if len(last):
                    own.append(last)
        bucket = np.concatenate([*own, direct[cut[code]:cut[code + 1]]]) if own else direct[cut[code]:cut[code + 1]]
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[codes[before] > code]
        if len(before):
            to = codes[before]
            order = np.argsort(to, kind="stable")
            to, before = to[order], before[order]
            edges = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                induced[to[a]].append(before[a:b])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_starts(texts: list[bytes]) -> list[np.ndarray]:
    """For each text which of its window starts begin a string that also starts elsewhere among the texts."""
    size = np.array([len(t) + 1 for t in texts])
    base = np.cumsum(size) - size
    joined = np.frombuffer(b"\0".join(texts) + b"\0" * (WINDOW + 9), np.uint8)
    total = int(size.sum())
    codes = joined[:total].astype(np.uint16) + 1
    codes[base + size - 1] = 0
    starts = np.zeros(total, bool)
    for b, s in zip(base.tolist(), size.tolist(), strict=True):
        starts[b:max(b, b + s - WINDOW)] = True
    order = suffix_array(codes)
    order = order[starts[order]]
    # adjacent common prefixes, eight bytes at a time
    word = joined[:-7].astype(np.uint64)
    for k in range(1, 8):
        word = word | (joined[k:len(joined) - 7 + k].astype(np.uint64) << np.uint64(8 * k))
    same = np.arange(len(order) - 1)
    for at in range(0, WINDOW, 8):
        same = same[word[order[same] + at] == word[order[same + 1] + at]]
    again = np.zeros(total, bool)
    again[order[same]] = again[order[same + 1]] = True
    return [again[b:max(b, b + s - WINDOW)] for b, s in zip(base.tolist(), size.tolist(), strict=True)]


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _anchors(texts: DataFrame, gram: int) -> DataFrame:
    """(anchor, same): anchors that occur more than once, and whether all their runs are equal."""

    def run(batches):
        for batch in batches:
            held = [(r[2], r[3], w) for d, w in zip(batch.column(0), batch.column(1), strict=True) for r in runs(d.as_py(), gram) for w in [w.as_py()]]
            for at in range(0, len(held), 2000):
                part = held[at:at + 2000]
                a, s = np.concatenate([h[0] for h in part]), np.concatenate([h[1] for h in part])
                w = np.repeat([h[2] for h in part], [len(h[0]) for h in part])
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(s.view(np.int64)), pa.array(w, pa.int64())], names=["anchor", "run", "weight"])

    found = texts.select("data", "weight").mapInArrow(run, "anchor long, run long, weight long")
    counted = found.groupBy("anchor").agg(F.sum("weight").alias("n"), F.min("run").alias("low"), F.max("run").alias("high"))
    return common.saved(counted.filter("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("same")), "anchors")


def _bitmap(anchors: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the anchors, at most MAX_BITS, gathered in blocks of equal size."""
    n = anchors.count()
    bits = 1 << 16
    while bits < 16 * n and bits < MAX_BITS:
        bits *= 2
    block = 1 << 16

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.asarray(batch.column(0)).view(np.uint64) % np.uint64(bits)
            for b in np.unique(at // np.uint64(block)):
                mine = at[at // np.uint64(block) == b] % np.uint64(block)
                held.setdefault(int(b), np.zeros(block, bool))[mine.astype(np.int64)] = True
        for b, flags in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["b", "bits"])

    bucket = F.floor(F.pmod("anchor", F.lit(bits)) / block)
    dealt = anchors.select("anchor", bucket.alias("b")).repartition("b").select("anchor")
    out = np.zeros(bits, bool)
    for row in dealt.mapInArrow(run, "b long, bits binary").toLocalIterator():
        out[row.b * block:(row.b + 1) * block] |= np.unpackbits(np.frombuffer(row.bits, np.uint8)).astype(bool)
    return np.packbits(out, bitorder="little"), bits


def _occurrences(texts: DataFrame, gram: int, anchors: DataFrame) -> DataFrame:
    """Runs whose anchor repeats, with `same`; `data` holds the bytes of the first equal run of a batch."""
    bitmap, bits = _bitmap(anchors)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            known: set = set()
            columns: list[list] = [[] for _ in range(8)]
            size = 0
            for k1, k2, data, weight in zip(*(batch.column(i) for i in range(4)), strict=True):
                data = data.as_py()
                for start, count, anchor, whole in runs(data, gram):
                    at = anchor % np.uint64(bits)
                    hit = np.flatnonzero((shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
                    if not len(hit):
                        continue
                    a, s = anchor[hit].view(np.int64).tolist(), whole[hit].view(np.int64).tolist()
                    begin, n = start[hit].tolist(), count[hit].tolist()
                    columns[0] += [k1.as_py()] * len(hit)
                    columns[1] += [k2.as_py()] * len(hit)
                    columns[2] += begin
                    columns[3] += n
                    columns[4] += a
                    columns[5] += s
                    columns[6] += [weight.as_py()] * len(hit)
                    for key, b, c in zip(zip(a, s, strict=True), begin, n, strict=True):
                        if key in known:
                            columns[7].append(None)
                        else:
                            known.add(key)
                            columns[7].append(data[b:b + c + WINDOW - 1])
                            size += c + WINDOW
                if size > 8 << 20:
                    yield out(columns)
                    columns, size = [[] for _ in range(8)], 0
            yield out(columns)

    def out(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 7 + [pa.binary()], strict=True)],
                                          names=["k1", "k2", "start", "n", "anchor", "run", "weight", "data"])

    rows = texts.select("k1", "k2", "data", "weight").mapInArrow(
        run, "k1 long, k2 long, start long, n long, anchor long, run long, weight long, data binary")
    return common.saved(common.saved(rows, "runs").join(anchors, "anchor"), "occurrences")


def _sorted_runs(distinct: DataFrame) -> DataFrame:
    """(anchor, run, begins, ends): spans of repeated window starts in distinct runs, by suffix arrays of chunks of whole anchors."""

    def chunk(rows: list[tuple]) -> pa.RecordBatch:
        flags = repeated_starts([r[2] for r in rows])
        keep = []
        for (a, s, _, weight), own in zip(rows, flags, strict=True):
            if weight > 1:
                keep.append((a, s, [0], [len(own)]))
            elif own.any():
                begin, end = _spans(own)
                keep.append((a, s, begin.tolist(), end.tolist()))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([k[i] for k in keep], kinds[i]) for i in range(4)], names=["anchor", "run", "begins", "ends"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > CHUNK_BYTES and row[0] != held[-1][0]:
                    yield chunk(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield chunk(held)

    parts = common.partitions_for(distinct.sparkSession, distinct.count(), 40_000)
    dealt = distinct.select("anchor", "run", "data", "weight").repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor long, run long, begins array<long>, ends array<long>")


def repeated(texts: DataFrame, level: int = 0) -> DataFrame:
    """(k1, k2, spans): for texts (k1, k2, data, weight) the spans of window starts that repeat; weight counts equal texts."""
    gram = GRAMS[level]
    anchors = _anchors(texts, gram)
    found = _occurrences(texts, gram, anchors)
    distinct = found.filter("NOT same").groupBy("anchor", "run").agg(F.sum("weight").alias("weight"), F.max("data").alias("data"))
    distinct = common.saved(distinct, "distinct")
    hot = common.saved(distinct.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_RUNS).select("anchor"), "hot")
    span = F.struct("begin", "end")
    if hot.isEmpty() or gram == WINDOW:
        answers = _sorted_runs(distinct)
    else:
        hot = common.small_side(hot)
        further = repeated(common.saved(distinct.join(hot, "anchor", "left_semi").select(F.col("anchor").alias("k1"), F.col("run").alias("k2"), "data", "weight"), "further"), level + 1)
        answers = _sorted_runs(distinct.join(hot, "anchor", "left_anti")).unionByName(further.select(
            F.col("k1").alias("anchor"), F.col("k2").alias("run"), F.transform("spans", lambda s: s["begin"]).alias("begins"),
            F.transform("spans", lambda s: s["end"]).alias("ends")))
    answers = common.saved(answers, "answers")
    whole = found.filter("same").select("k1", "k2", F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("end"))
    part = found.filter("NOT same").select("k1", "k2", "start", "anchor", "run").join(answers, ["anchor", "run"]).select(
        "k1", "k2", F.explode(F.arrays_zip("begins", "ends")).alias("s"), "start").select(
        "k1", "k2", (F.col("start") + F.col("s.begins")).alias("begin"), (F.col("start") + F.col("s.ends")).alias("end"))
    # a text has no more spans than bytes, so its list is bounded by the text
    return whole.union(part).distinct().groupBy("k1", "k2").agg(F.collect_list(span).alias("spans"))


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text, F.length(text)).alias("k2")]


def strip(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and `kept`, the remaining bytes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.encode(whole, "UTF-8").alias("data"), *_keys(whole))
    texts = rows.filter(F.octet_length("data") >= WINDOW).select("k1", "k2", "data", F.lit(1).cast("long").alias("weight"))
    spans = common.saved(repeated(texts), "spans")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for data, own in zip(part.column(1), part.column(2), strict=True):
                    data, own = data.as_py(), own.as_py() or []
                    kept, upto, removed, n = [], 0, 0, 0
                    end = -1
                    for begin, stop in sorted((s["begin"], s["end"] + WINDOW - 1) for s in own):
                        if begin > end:
                            kept.append(data[upto:begin])
                            n += 1
                            removed += stop - begin
                        else:
                            removed += max(0, stop - end)
                        end = max(end, stop)
                        upto = end
                    kept.append(data[upto:])
                    left = b"".join(kept)
                    out.append((len(data), removed, n, hashlib.sha256(left).hexdigest(), left))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([o[i] for o in out], kinds[i]) for i in range(5)]],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.join(spans, ["k1", "k2"], "left").select("doc_id", "data", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
