"""Toxicity scores from a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of a whole text (lengths NGRAMS, lower-cased, white space as one blank), hashed to
2**HASH_BITS. Training takes at most MAX_ROWS labelled rows (a documented bound, lowest hash of the id first); document counts by class are
added up in Spark. A feature's ratio is the log of its smoothed share among toxic rows over that among the others. Features whose
shares differ by at least MIN_Z standard errors are kept, at most MAX_FEATURES of the largest; a logistic regression with an L2 penalty is
fitted on the ratios of those present. Only text goes into a score.

Defined results: null text counts as empty, and an empty text scores by the intercept alone; rows without label do not train; null labels count
as missing; a doc_id that is repeated trains once for each row; with labels of one class or none every score is the smoothed share of toxic
rows; an empty table gives no rows; other columns pass through `drop_toxic` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.llm import common

NGRAMS = (4, 5, 6, 7)
HASH_BITS = 21
MAX_ROWS = 20_000
MAX_FEATURES = 1 << 11
MIN_Z = 5.0
ALPHA = 0.5
PENALTY = 1.0
THRESHOLD = 0.7
#: Characters hashed at a time; longer texts go in pieces that overlap by the longest n-gram, so none is missed.
PIECE = 1 << 18
_MULTIPLIERS = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


def _grams(text: str):
    """Hashed n-grams of a text, in arrays."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    points[(points <= 32) | (points == 160)] = 32
    longest = NGRAMS[-1]
    for at in range(0, len(points), PIECE):
        piece = points[at:at + PIECE + longest - 1]
        value = piece.copy()
        for n in range(2, longest + 1):
            if len(piece) < n:
                break
            value = value[:len(piece) - n + 1] * _MULTIPLIERS[0] + piece[n - 1:]
            if n in NGRAMS:
                yield ((value ^ (value >> np.uint64(29))) * _MULTIPLIERS[1] >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Distinct hashed n-grams."""
    found = list(_grams(text or ""))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def selected(text: str | None, slot: np.ndarray) -> np.ndarray:
    """Distinct slots of the kept features that occur in the text; `slot` is -1 for the rest."""
    found = [s[s >= 0] for s in (slot[g] for g in _grams(text or ""))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Classifier:
    """Weights by slot and the intercept."""

    def __init__(self, slot: np.ndarray, weights: np.ndarray, intercept: float) -> None:
        self.slot, self.weights, self.intercept = slot, weights, intercept

    def score(self, text: str | None) -> float:
        value = self.intercept
        if len(self.weights):
            value += float(self.weights[selected(text, self.slot)].sum())
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def _fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled presence, by accelerated gradient steps with a backtracked step size."""
    size = np.array([len(r) for r in rows])
    column = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    value = ratio[column]
    n, d = len(rows), len(ratio)
    w, b = np.zeros(d), float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    seen, seen_b, momentum, step = w.copy(), b, 1.0, 1.0

    def margins(weights, intercept):
        return np.bincount(row, weights=value * weights[column], minlength=n) + intercept

    def loss(weights, intercept):
        z = margins(weights, intercept)
        return (np.logaddexp(0, z) - labels * z).sum() + PENALTY * (weights @ weights) / 2, z

    for _ in range(rounds):
        now, z = loss(seen, seen_b)
        error = 1 / (1 + np.exp(-z)) - labels
        gradient = np.bincount(column, weights=value * error[row], minlength=d) + PENALTY * seen
        slope = error.sum()
        size_of = gradient @ gradient + slope * slope
        while True:
            next_w, next_b = seen - step * gradient, seen_b - step * slope
            after, _ = loss(next_w, next_b)
            if after <= now - step * size_of / 2 or step < 1e-12:
                break
            step /= 2
        coming = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        seen, seen_b = next_w + (momentum - 1) / coming * (next_w - w), next_b + (momentum - 1) / coming * (next_b - b)
        if np.abs(next_w - w).max(initial=0) < 1e-5 and abs(next_b - b) < 1e-5:
            w, b = next_w, next_b
            break
        w, b, momentum, step = next_w, next_b, coming, step * 1.5
    return w * ratio, b


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", allowed: Column | None = None) -> Classifier:
    """Learn from the labelled documents for which `allowed` (over the document's id) holds."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).filter("_label IN (0, 1) AND _id IS NOT NULL")
    if allowed is not None:
        known = known.withColumnRenamed("_id", doc_id).filter(allowed).withColumnRenamed(doc_id, "_id")
    # the bounded sample is chosen among the labels alone, so only its texts are fetched
    sample = common.saved(known.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(MAX_ROWS), "labels")
    chosen = common.saved(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id").select("_label", "_text"), "training")
    size = 1 << HASH_BITS

    def count(batches):
        held = np.zeros((2, size), np.int32)
        rows = [0, 0]
        for batch in batches:
            for y, t in zip(batch.column(0), batch.column(1), strict=True):
                held[y.as_py()][features(t.as_py())] += 1
                rows[y.as_py()] += 1
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[rows[0], held[0][at]], pa.int64()), pa.array(np.r_[rows[1], held[1][at]], pa.int64())],
                                         names=["f", "clean", "toxic"])

    sums = chosen.mapInArrow(count, "f long, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sums = common.saved(sums, "grams")
    all_rows = sums.filter("f = -1").first()
    q, p = (all_rows.clean, all_rows.toxic) if all_rows else (0, 0)
    none = Classifier(np.zeros(0, np.int64), np.zeros(0), float(np.log((p + ALPHA) / (q + ALPHA))))
    if not p or not q:
        return none
    pooled = (F.col("clean") + F.col("toxic")) / (p + q)
    z = F.abs(F.col("toxic") / p - F.col("clean") / q) / F.sqrt(pooled * (1 - pooled) * (1 / p + 1 / q) + 1e-12)
    kept = sums.filter("f >= 0").withColumn("z", z).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "f").limit(MAX_FEATURES).toArrow()
    if not kept.num_rows:
        return none
    at = kept.column("f").to_numpy()
    ratio = np.log((kept.column("toxic").to_numpy() + ALPHA) / (p + 2 * ALPHA)) - np.log((kept.column("clean").to_numpy() + ALPHA) / (q + 2 * ALPHA))
    slot = np.full(size, -1, np.int32)
    slot[at] = np.arange(len(at))
    slot_b = docs.sparkSession.sparkContext.broadcast(slot)

    def pick(batches):
        for batch in batches:
            rows = [selected(t.as_py(), slot_b.value).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["label", "slots"])

    # at most MAX_ROWS short lists, in an order of their own so that the fit does not depend on how the rows were dealt out
    table = chosen.mapInArrow(pick, "label int, slots array<int>").toArrow()
    found = sorted(((y, np.asarray(s.values)) for y, s in zip(table.column("label").to_pylist(), table.column("slots"), strict=True)),
                   key=lambda r: (r[0], r[1].tobytes()))
    rows, ys = [r[1].astype(np.int64) for r in found], np.array([r[0] for r in found], float)
    weights, intercept = _fit(rows, ys, ratio)
    return Classifier(slot, weights, intercept)


def score(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """The documents with `score` in place of their text."""
    model_b = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != text]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*others).schema)

    def run(batches):
        for batch in batches:
            scores = [model_b.value.score(t.as_py()) for t in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(others))], pa.array(scores, pa.float64())], names=[*others, "score"])

    return docs.select(*others, text).mapInArrow(run, f"{fields}{', ' if others else ''}score double")


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """crc32 of the id as text; rows without id are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, learnt from the labels of rows that are not held out."""
    model = train(docs, labels, allowed=~held_out(F.col("doc_id")))
    found = score(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score stays below the threshold."""
    model_b = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = pa.array([model_b.value.score(t.as_py()) < THRESHOLD for t in batch.column(at)], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)
