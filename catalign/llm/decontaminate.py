"""Benchmark decontamination by BM25 retrieval with block-max WAND.

Test items are cut into units of at most UNIT_WORDS words and put into an inverted index: postings by unit, in blocks that keep their largest
impact. Impacts are BM25 weights divided by the unit's own score, so 1 means that the passage has every word of the unit. Every training
text is queried as a row of overlapping passages long enough to hold any unit whole. A passage whose words' largest impacts cannot sum
to the threshold has no result, nor has one that holds too little of every unit's rarer words (what a unit's most common words can add is
bounded, so this drops nothing); all others are answered by block-max WAND, which returns every unit at or above the threshold. Retrieved
items are then verified on the whole text: at least `overlap` of the five-word shingles of both the question and the answer must occur in it
(an item's last sentence is its answer, unless `answer` names a column; shorter parts must occur whole).

The index is broadcast in chunks of at most CHUNK_ITEMS items, one pass over the texts for each, so its size is bounded at any benchmark
size. Document frequencies are those of all items.

Defined results: null or empty texts match nothing; null or empty items are never found; repeated items and texts each give their rows; ties
in score keep all; an empty table on either side gives no leaks; other columns pass through `drop_leaks` untouched.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalign.llm import common

UNIT_WORDS, PASSAGE_WORDS, STRIDE = 32, 48, 16
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.8, 5
K1, B = 1.2, 0.75
BLOCK = 16
#: Share of a unit's own score that its most common words may hold and still be left out of the screen.
COMMON_SHARE = 0.3
CHUNK_ITEMS = 20_000
# ASCII punctuation and control bytes are spaces, capitals small letters; other bytes stay.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def parts(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item without an answer column: the last sentence answers."""
    cuts = [m.end() for m in re.finditer(r"[.?!\n]+\s*", text.strip()) if m.end() < len(text.strip())]
    question, answer = (text.strip()[:cuts[-1]], text.strip()[cuts[-1]:]) if cuts else (text, "")
    q, a = words(question), words(answer)
    return (q, a) if q else (a, q)


def _held(part: list[bytes], joined: bytes) -> float:
    """Share of the part's shingles that occur in the text, 1 for an empty part."""
    if not part:
        return 1.0
    n = max(1, len(part) - SHINGLE + 1)
    shingles = [b" " + b" ".join(part[i:i + SHINGLE]) + b" " for i in range(n)]
    return sum(s in joined for s in shingles) / n


class Index:
    """Inverted index of units with block maxima."""

    def __init__(self, items: list[tuple[int, str, str | None]], frequency: dict[bytes, int], n_units: int, mean_length: float) -> None:
        self.items = []
        self.unit_item: list[int] = []
        units: list[Counter] = []
        for item_id, text, answer in items:
            question, reply = (words(text), words(answer)) if answer is not None else parts(text)
            own = question + reply if answer is not None else words(text)
            if not own:
                continue
            self.items.append((item_id, question, reply))
            for at in range(0, len(own), UNIT_WORDS):
                unit = own[at:at + UNIT_WORDS] if len(own) - at >= UNIT_WORDS // 2 or at == 0 else own[-UNIT_WORDS:]
                units.append(Counter(unit))
                self.unit_item.append(len(self.items) - 1)
        self.terms: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for number, unit in enumerate(units):
            length = sum(unit.values())
            weight = {}
            for term, tf in unit.items():
                df = max(1, frequency.get(term, 1))
                idf = math.log(1 + (n_units - df + 0.5) / (df + 0.5)) if n_units >= df else math.log(1.5)
                weight[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))
            whole = sum(weight.values())
            for term, value in weight.items():
                at = self.terms.setdefault(term, len(self.terms))
                if at == len(postings):
                    postings.append([])
                postings[at].append((number, value / whole))
        self.units = [[u for u, _ in p] for p in postings]
        self.impacts = [[i for _, i in p] for p in postings]
        self.block_last = [[p[min(at + BLOCK, len(p)) - 1][0] for at in range(0, len(p), BLOCK)] for p in postings]
        self.block_max = [[max(i for _, i in p[at:at + BLOCK]) for at in range(0, len(p), BLOCK)] for p in postings]
        self.largest = np.array([max(i) for i in self.impacts] or [0.0])
        self._screen(len(units))

    def _screen(self, n_units: int) -> None:
        """Postings of each unit's rarer terms, and the share that they leave out."""
        own: list[list[tuple[int, float, int]]] = [[] for _ in range(n_units)]
        for term, held in enumerate(self.units):
            for unit, impact in zip(held, self.impacts[term], strict=True):
                own[unit].append((len(held), impact, term))
        rows: list[list[tuple[int, float]]] = [[] for _ in self.units]
        self.left_out = np.zeros(n_units)
        for unit, terms in enumerate(own):
            for _, impact, term in sorted(terms, reverse=True):
                if self.left_out[unit] + impact <= COMMON_SHARE:
                    self.left_out[unit] += impact
                else:
                    rows[term].append((unit, impact))
        self.rare_start = np.cumsum([0, *map(len, rows)])
        self.rare_unit = np.array([u for r in rows for u, _ in r], np.int64)
        self.rare_impact = np.array([i for r in rows for _, i in r])

    def passages(self, ids: np.ndarray, segment: np.ndarray, threshold: float) -> np.ndarray:
        """First segments of the passages that may reach the threshold. A passage is three consecutive segments of STRIDE words."""
        known = ids >= 0
        ids, segment = ids[known], segment[known]
        size = self.rare_start[ids + 1] - self.rare_start[ids]
        at = np.repeat(self.rare_start[ids] - np.cumsum(size) + size, size) + np.arange(size.sum())
        width = int(segment[-1]) + 4 if len(segment) else 4
        key, where = np.unique(self.rare_unit[at] * width + np.repeat(segment, size), return_inverse=True)
        if not len(key):
            return key
        here = np.bincount(where, weights=self.rare_impact[at])
        total = here.copy()
        for step in (1, 2):
            for ahead in range(1, step + 1):
                if len(key) > ahead:
                    total[:-ahead] += np.where(key[ahead:] == key[:-ahead] + step, here[ahead:], 0.0)
        near = total + self.left_out[key // width] >= threshold - 1e-9
        first = key[near] % width
        return np.unique(np.concatenate([first, first - 1, first - 2]))

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All units whose impacts sum to the threshold or more, by block-max WAND over distinct terms."""
        cursors = [[self.units[t][0], 0, t] for t in terms]
        out = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.largest[t]
                if bound >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            unit = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
                pivot += 1
            # the largest impacts of the blocks in which the pivot would stand
            bound, end = 0.0, None
            for _, _, t in cursors[:pivot + 1]:
                b = bisect.bisect_left(self.block_last[t], unit)
                if b < len(self.block_last[t]):
                    bound += self.block_max[t][b]
                    end = self.block_last[t][b] if end is None else min(end, self.block_last[t][b])
            if bound >= threshold - 1e-9:
                score = 0.0
                for c in cursors[:pivot + 1]:
                    self._seek(c, unit)
                    if c[0] == unit:
                        score += self.impacts[c[2]][c[1]]
                if score >= threshold - 1e-9:
                    out.append((unit, score))
                target = unit + 1
            else:
                target = (end if end is not None else unit) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, unit + 1)
            for c in cursors[:pivot + 1]:
                self._seek(c, target)
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def _seek(self, cursor: list, unit: int) -> None:
        if 0 <= cursor[0] < unit:
            held = self.units[cursor[2]]
            cursor[1] = bisect.bisect_left(held, unit, cursor[1])
            cursor[0] = held[cursor[1]] if cursor[1] < len(held) else -1

    def leaks(self, texts: list[str | None], threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
        """(position in texts, item_id, bm25, question overlap, answer overlap) of all verified items."""
        own = [words(t) for t in texts]
        get = self.terms.get
        ids = np.array([get(w, -1) for doc in own for w in doc], np.int64)
        size = np.array([len(doc) for doc in own], np.int64)
        begin = np.cumsum(size) - size
        # segments are numbered through all texts, with three empty ones between, so no passage spans two texts
        segments = -(-size // STRIDE) + 3
        base = np.cumsum(segments) - segments
        segment = np.repeat(base, size) + (np.arange(len(ids)) - np.repeat(begin, size)) // STRIDE
        found: dict[int, dict[int, float]] = {}
        for first in self.passages(ids, segment, threshold).tolist():
            doc = int(np.searchsorted(base, max(first, 0), "right")) - 1
            offset = (first - base[doc]) * STRIDE
            if first < 0 or offset >= size[doc]:
                continue
            start = begin[doc] + offset
            terms = np.unique(ids[start:min(start + PASSAGE_WORDS, begin[doc] + size[doc])])
            terms = terms[terms >= 0]
            if self.largest[terms].sum() < threshold - 1e-9:
                continue
            for unit, score in self.search(terms.tolist(), threshold):
                best = found.setdefault(doc, {})
                best[self.unit_item[unit]] = max(score, best.get(self.unit_item[unit], 0.0))
        out = []
        for doc, items in found.items():
            joined = b" " + b" ".join(own[doc]) + b" "
            for item, score in items.items():
                item_id, question, answer = self.items[item]
                q, a = _held(question, joined), _held(answer, joined)
                if q >= overlap and a >= overlap:
                    out.append((doc, item_id, score, q, a))
        return out


def _slices(texts: pa.Array, most_bytes: int = 2 << 20):
    """(start, texts) in slices of about so many bytes."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size > most_bytes:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def _statistics(items: DataFrame) -> tuple[DataFrame, int, float]:
    """Term frequencies over units, number of units, mean unit length, over all items."""

    def run(batches):
        for batch in batches:
            terms: Counter = Counter()
            n = total = 0
            for text in batch.column("body").to_pylist():
                own = words(text)
                for at in range(0, len(own), UNIT_WORDS):
                    n += 1
                    total += len(own[at:at + UNIT_WORDS])
                    terms.update(set(own[at:at + UNIT_WORDS]))
            keys = [*terms, b""]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([*terms.values(), n], pa.int64()),
                                              pa.array([0] * len(terms) + [total], pa.int64())], names=["term", "n", "total"])

    found = common.saved(items.select("body").mapInArrow(run, "term binary, n long, total long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")), "terms")
    sums = found.filter(F.octet_length("term") == 0).first()
    return found.filter(F.octet_length("term") > 0), (sums["n"] if sums else 0), (sums["total"] / sums["n"] if sums and sums["n"] else 1.0)


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
          answer: str | None = None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row for each text and item of which it has question and answer: doc_id, item_id, bm25, question_overlap, answer_overlap."""
    context = docs.sparkSession.sparkContext
    reply = F.col(answer) if answer else F.lit(None).cast("string")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"), reply.alias("answer"))
    items = common.saved(items.filter(F.col("text").isNotNull()).withColumn("body", F.concat_ws(" ", "text", "answer")), "items")
    terms, n_units, mean_length = _statistics(items)
    chunks = -(-items.count() // CHUNK_ITEMS) or 1
    dealt = items.withColumn("chunk", F.pmod(F.xxhash64("body", "item_id"), F.lit(chunks)))
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = None
    for chunk in range(chunks):
        own = dealt.filter(F.col("chunk") == chunk)
        held = own.select("item_id", "text", "answer").collect()
        if chunks > 1:  # only the frequencies that this chunk needs come to the driver
            need = docs.sparkSession.createDataFrame([(bytes(w),) for w in {w for r in held for w in words(f"{r.text} {r.answer or ''}")}], "term binary")
            frequency = {bytes(r.term): r.n for r in terms.join(need, "term", "left_semi").collect()}
        else:
            frequency = {bytes(r.term): r.n for r in terms.collect()}
        index = context.broadcast(Index([tuple(r) for r in held], frequency, n_units, mean_length))

        def run(batches, index=index):
            for batch in batches:
                ids, hits = [], []
                for start, texts in _slices(batch.column(1)):
                    for doc, *hit in index.value.leaks(texts, threshold, overlap):
                        ids.append(start + doc)
                        hits.append(hit)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(ids, pa.int64())), *[pa.array([h[k] for h in hits], t) for k, t in enumerate(
                        (pa.int64(), pa.float64(), pa.float64(), pa.float64()))]],
                    names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap"])

        part = rows.mapInArrow(run, f"doc_id {kind}, item_id long, bm25 double, question_overlap double, answer_overlap double")
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """The documents without those that hold a test item; rows are told apart by their text, so no id takes other rows with it."""
    asked = docs.select(F.struct(*common.text_marks(text)).alias("mark"), F.col(text).alias("text"))
    gone = common.saved(leaks(asked, benchmark, "text", "mark", **limits).select("doc_id.h0", "doc_id.h1").distinct(), "leaks")
    suspects, clean = common.routed(common.packed(docs, *common.text_marks(text)), F.col("h0"), common.marked(gone, "h0"))
    return clean.select("row").unionByName(suspects.join(gone, ["h0", "h1"], "left_anti").select("row")).select("row.*")
