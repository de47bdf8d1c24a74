"""Scoring texts with a Brown class bigram model.

    P(text) = prod P(class_i | class_{i-1}) * P(token_i | class_i)

Tokens are lower-cased (A-Z) runs between white space and one end per text. The CLUSTERED most frequent words get their class by exchange
clustering: in each round every other word is tried in every class and moves to the one where the class bigram likelihood of all its
neighbours is highest; rounds run over neighbour rows in Spark, and only the class of each word and the class-by-class counts
(both of fixed size) meet on the driver. The other words of the head that were seen at least NAMED times begin in a class by their shape and are tried
in every exchange class, by all their neighbours; a word moves to the likeliest if it gains more there than the choice of
one class in so many costs (its logarithm), or words seen twice would move by chance. Words seen less often are what is known about words never seen:
they, and tokens outside the head, stay in the class of their shape, so every token has exactly one class.
Transitions are smoothed towards the class's own probability, emissions of shape classes by half a count for each token and one unseen.

Counts cover the whole training part. Counts of the HEAD most frequent tokens are broadcast (a fixed bound); all other counts are joined.

Defined results: null text is empty and has one token, the end; rows without doc_id are training rows (crc32 of null is null);
repeated rows are each scored and each counted; with no training rows N is 0 and all scores use the half counts alone; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalign.llm import common

HEAD = 1 << 18
CLUSTERED = 1 << 13
CLASSES = 128
ROUNDS = 12
#: A word seen this often has a class by its neighbours.
NAMED = 2
HALF = 0.5
#: Share of the class's own probability in a transition, in pseudo counts of the class before.
SMOOTH = 5.0
# Shape classes: 4 kinds of last byte by ASCII or one of 16 marks of the first byte pair beyond it.
SHAPES = 4 * 17
_ASCII = bytes(range(128))
_LAST = np.array([1 if chr(b).isdigit() else 0 if chr(b).isalpha() or b > 127 else 2 if b in b".,;:!?" else 3 for b in range(256)]).tolist()


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


@lru_cache(maxsize=1 << 17)
def shape(word: bytes) -> int:
    rest = b"" if word.isascii() else word.translate(None, _ASCII)
    return _LAST[word[-1]] * 17 + (1 + rest[-1 if len(rest) < 2 else 1] % 16 if rest else 0)


def is_held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, c) over a frame with one text column; every task adds up its own counts first."""

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
            if len(held) > 400_000:
                yield from out(held)
                held = Counter()
        yield from out(held)

    def out(held: Counter):
        keys, values = list(held), list(held.values())
        for at in range(0, len(keys), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 50_000], pa.binary()), pa.array(values[at:at + 50_000], pa.int64())],
                                             names=["token", "c"])

    return texts.mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Head:
    """The most frequent tokens with their counts, and the symbol of any token.

    Symbols: positions below `clustered` (the words with a class by neighbours), then the shapes of all other tokens, then the end. None stands for the end in token lists.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray, clustered: int) -> None:
        self.words, self.counts, self.clustered = words, counts, clustered
        self.end = clustered + SHAPES
        shapes = [clustered + shape(w) for w in words[clustered:]]
        # by position: clustered words, other head words, the end, and a last place for tokens outside the head
        self.symbol = np.array([*range(clustered), *shapes, self.end, -1], np.int64)
        self.at: dict[bytes | None, int] | None = None

    def __getstate__(self):
        return self.__dict__ | {"at": None}

    def read(self, words: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Positions (-1 outside the head), symbols, and the places of tokens outside the head."""
        if self.at is None:
            self.at = {w: i for i, w in enumerate([*self.words, None])}
        ids = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        symbols = self.symbol[ids]
        rare = np.flatnonzero(ids < 0).tolist()
        if rare:
            symbols[rare] = np.fromiter((self.clustered + shape(words[i]) for i in rare), np.int64, len(rare))
        return ids, symbols, rare


def _slices(texts, most_tokens: int = 200_000):
    """(row of the first text, tokens of consecutive texts with an end after each, number of tokens of each)."""
    first, held, sizes = 0, [], []
    for i, text in enumerate(texts):
        own = tokens(text.as_py())
        held += own
        held.append(None)
        sizes.append(len(own) + 1)
        if len(held) > most_tokens:
            yield first, held, sizes
            first, held, sizes = i + 1, [], []
    if sizes:
        yield first, held, sizes


def pair_counts(texts: DataFrame, head, end: int) -> DataFrame:
    """(pair, n) of adjacent symbols over all texts, the end standing before and after each; pair = first * (end + 1) + second."""

    def run(batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, words, _ in _slices(batch.column(0)):
                symbols = head.value.read(words)[1]
                held.append(np.concatenate([[end], symbols[:-1]]) * (end + 1) + symbols)
                size += len(symbols)
                if size > 4_000_000:
                    yield from out(held)
                    held, size = [], 0
        yield from out(held)

    def out(held):
        if held:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(keys), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 200_000]), pa.array(counts[at:at + 200_000])], names=["pair", "n"])

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def neighbours(pairs: DataFrame, clustered: int, end: int) -> DataFrame:
    """(w, others, counts): for each clustered word its clustered neighbours; others >= 0 come after it, ~other < 0 before it."""
    first, second = F.floor(F.col("pair") / (end + 1)).cast("int"), (F.col("pair") % (end + 1)).cast("int")
    both = F.array(F.struct(first.alias("w"), second.alias("o")), F.struct(second.alias("w"), (-1 - first).alias("o")))
    own = pairs.filter((first < clustered) & (second < clustered))
    sides = own.select("n", F.explode(both).alias("s")).select("s.w", "s.o", "n")
    # a word has at most 2 * clustered neighbours, so its row is bounded
    return sides.groupBy("w").agg(F.collect_list(F.struct("o", "n")).alias("near")).select("w", F.col("near.o").alias("others"), F.col("near.n").alias("counts"))


def _profiles(batch: pa.RecordBatch, classes: np.ndarray, n_classes: int):
    """Words of the batch and their neighbour counts by class: following classes, then preceding ones."""
    words = np.asarray(batch.column(0))
    lists = batch.column(1)
    size = np.diff(np.asarray(lists.offsets))
    row = np.repeat(np.arange(len(words)), size)
    others = np.asarray(lists.flatten())
    n = np.asarray(batch.column(2).flatten())
    column = np.where(others >= 0, classes[np.maximum(others, 0)], n_classes + classes[np.maximum(~others, 0)])
    table = np.bincount(row * (2 * n_classes) + column, weights=n, minlength=len(words) * 2 * n_classes).reshape(len(words), 2 * n_classes)
    return words, table


def exchange(near: DataFrame, n_words: int, n_classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every clustered word, by rounds of exchange over the neighbour rows."""
    spark = near.sparkSession
    classes = np.arange(n_words) % n_classes
    still = 0
    for turn in range(rounds):
        held = spark.sparkContext.broadcast(classes)

        def add_up(batches, held=held):
            total = np.zeros((n_classes, n_classes))
            for batch in batches:
                words, table = _profiles(batch, held.value, n_classes)
                np.add.at(total, held.value[words], table[:, :n_classes])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

        matrix = sum((np.frombuffer(r.m).reshape(n_classes, n_classes) for r in near.mapInArrow(add_up, "m binary").toLocalIterator()),
                     np.zeros((n_classes, n_classes)))
        smooth = matrix + 0.1
        after = np.log(smooth / smooth.sum(axis=1, keepdims=True))  # [class of the word, class after]
        before = np.log(smooth / smooth.sum(axis=0, keepdims=True))  # [class before, class of the word]
        gain = np.concatenate([after, before.T], axis=1)  # [class, following then preceding]

        def move(batches, held=held, gain=gain, turn=turn):
            for batch in batches:
                words, table = _profiles(batch, held.value, n_classes)
                best = np.argmax(table @ gain.T, axis=1)
                # every other word moves in a round, or neighbours would swap classes for ever
                best = np.where((words + turn) % 2 == 0, best, held.value[words])
                yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(best)], names=["w", "k"])

        moved = near.mapInArrow(move, "w long, k long").toArrow()
        after_move = classes.copy()
        after_move[moved.column("w").to_numpy()] = moved.column("k").to_numpy()
        held.unpersist()
        still = still + 1 if (after_move == classes).all() else 0
        classes = after_move
        if still == 2:
            break
    return classes


def assign(pairs: DataFrame, classes: np.ndarray, shapes: np.ndarray, n_classes: int) -> np.ndarray:
    """Class of all named words, whose shapes are given: `classes` for the first, which the exchange placed, and for each other one the exchange
    class in which the class bigrams with all its neighbours are likeliest, of equal ones the first, or
    the class of its shape (n_classes and more) where that is not less likely by more than a factor of n_classes."""
    core, n_named = len(classes), len(shapes)
    classes = np.concatenate([classes, n_classes + shapes[core:]])
    k = n_classes + SHAPES + 1
    for turn in range(2 if core < n_named else 0):
        of = symbol_classes(classes, n_classes)
        held = pairs.sparkSession.sparkContext.broadcast(of)

        def sides(batches, held=held, turn=turn):
            # class bigrams of the partition go along in the same pass, below zero
            own, total = held.value, np.zeros(k * k, np.int64)
            for batch in batches:
                pair, n = np.asarray(batch.column(0)), np.asarray(batch.column(1))
                first, second = pair // len(own), pair % len(own)
                total += np.bincount(own[first] * k + own[second], weights=n, minlength=k * k).astype(np.int64)
                # every other word moves in a turn
                fore, back = ((w >= core) & (w < n_named) & ((w + turn) % 2 == 0) for w in (first, second))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([first[fore] * (2 * k) + own[second[fore]], second[back] * (2 * k) + k + own[first[back]]])),
                     pa.array(np.concatenate([n[fore], n[back]]))], names=["at", "n"])
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(-1 - seen), pa.array(total[seen])], names=["at", "n"])

        counted = common.saved(pairs.select("pair", "n").mapInArrow(sides, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")), "sides")
        matrix = counted.filter("at < 0").toArrow()
        known = np.full(k * k, 0.1)
        known[-1 - matrix.column("at").to_numpy()] += matrix.column("n").to_numpy()
        known = known.reshape(k, k)
        after, before = np.log(known / known.sum(axis=1, keepdims=True)), np.log(known / known.sum(axis=0, keepdims=True))
        # [class, following then preceding class]
        tried = pairs.sparkSession.sparkContext.broadcast((np.concatenate([after, before.T], axis=1), shapes))

        def place(batches, tried=tried):
            gain, shapes = tried.value
            for batch in batches:
                # a word has at most one count for each side and class, so the table of some words is bounded
                for at in range(0, len(batch), 4096):
                    part = batch.slice(at, 4096)
                    own = np.diff(np.asarray(part.column(1).offsets))
                    column, n = np.asarray(part.column(1).flatten()), np.asarray(part.column(2).flatten())
                    table = np.bincount(np.repeat(np.arange(len(own)), own) * (2 * k) + column, weights=n, minlength=len(own) * 2 * k).reshape(len(own), 2 * k)
                    value = table @ gain.T
                    best, rows = np.argmax(value[:, :n_classes], axis=1), np.arange(len(own))
                    start = n_classes + shapes[np.asarray(part.column(0))]
                    moves = value[rows, best] > value[rows, start] + math.log(n_classes)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.where(moves, best, start))], names=["w", "k"])

        word, column = F.floor(F.col("at") / (2 * k)).alias("w"), (F.col("at") % (2 * k)).cast("int").alias("c")
        near = counted.filter("at >= 0").select(word, F.struct(column, "n").alias("s")).groupBy("w").agg(F.collect_list("s").alias("s")).select("w", "s.c", "s.n")
        placed = near.mapInArrow(place, "w long, k long").toArrow()
        classes = classes.copy()
        classes[placed.column("w").to_numpy()] = placed.column("k").to_numpy()
        held.unpersist()
        tried.unpersist()
    return classes


class Model:
    """Transitions by class and emissions by head position and shape, in log10; all of fixed size."""

    def __init__(self, head: Head, classes: np.ndarray, n_classes: int, pairs: np.ndarray, shape_size: np.ndarray, shape_words: np.ndarray) -> None:
        """`pairs`: counts of class bigrams; `shape_size`, `shape_words`: tokens and distinct tokens of each shape in the training part."""
        self.head = head
        self.classes = symbol_classes(classes, n_classes)
        own = pairs.sum(axis=0) + HALF
        own /= own.sum()
        self.transition = np.log10((pairs + SMOOTH * own) / (pairs.sum(axis=1, keepdims=True) + SMOOTH))
        self.shape_size = np.log10(shape_size + HALF * (shape_words + 1))
        k = len(classes)
        size = np.bincount(classes, weights=head.counts[:k], minlength=n_classes)
        by_shape = np.maximum(np.concatenate([classes - n_classes, head.symbol[k:len(head.words)] - k]), 0)  # of no meaning for words of exchange classes
        shaped = np.log10(head.counts + HALF) - self.shape_size[by_shape]
        placed = np.log10(head.counts[:k]) - np.log10(size[classes])
        # by position as in the head: the end is the only token of its class
        self.emission = np.concatenate([np.where(classes < n_classes, placed, shaped[:k]), shaped[k:], [0.0, 0.0]])


def symbol_classes(classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Class of every symbol: exchange classes, one class per shape, the end."""
    return np.concatenate([classes, n_classes + np.arange(SHAPES + 1)]).astype(np.int64)


def class_pairs(pairs: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Class bigram counts from the counts of symbol pairs."""
    of, n = symbol_classes(classes, n_classes), n_classes + SHAPES + 1
    held = pairs.sparkSession.sparkContext.broadcast(of)

    def run(batches):
        total = np.zeros(n * n)
        for batch in batches:
            pair = np.asarray(batch.column(0))
            a, b = held.value[pair // len(held.value)], held.value[pair % len(held.value)]
            total += np.bincount(a * n + b, weights=np.asarray(batch.column(1)), minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    found = pairs.select("pair", "n").mapInArrow(run, "pair long, n double").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(n, n)


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", parts: int = 5, part: int = 1, head_size: int = HEAD,
          clustered: int = CLUSTERED, n_classes: int = CLASSES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark: SparkSession = docs.sparkSession
    context = spark.sparkContext
    held_out = is_held_out(F.col(doc_id), parts, part)
    training = docs.filter(~held_out).select(text)
    counts = common.saved(count_tokens(training), "tokens")
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = training.count()
    total, vocabulary = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    top = counts.orderBy(F.desc("c"), "token").limit(head_size).toArrow()
    words = top.column("token").to_pylist()
    seen = top.column("c").to_numpy()
    named = int((seen >= NAMED).sum())
    head = Head(words, seen.astype(float), named)
    head_b = context.broadcast(head)
    pairs = common.saved(pair_counts(training, head_b, head.end), "pairs")
    core = min(clustered, named)
    classes = np.zeros(0, np.int64)
    if core:
        placed = exchange(common.saved(neighbours(pairs, core, head.end), "neighbours"), core, n_classes)
        classes = assign(pairs, placed, np.fromiter(map(shape, words[:named]), np.int64, named), n_classes)

    # the named words are the first by count and spelling, so the last of them tells whether a word is one
    last_named = (int(seen[named - 1]), words[named - 1]) if named else None

    def by_shape(batches):
        size, kinds = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for batch in batches:
            for token, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if last_named is None or c < last_named[0] or (c == last_named[0] and token > last_named[1]):
                    k = shape(token)
                    size[k] += c
                    kinds[k] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES)), pa.array(size), pa.array(kinds)], names=["k", "size", "kinds"])

    shapes = counts.mapInArrow(by_shape, "k long, size long, kinds long").groupBy("k").agg(F.sum("size").alias("size"), F.sum("kinds").alias("kinds")).toArrow()
    shape_size, shape_words = np.zeros(SHAPES), np.zeros(SHAPES)
    shape_size[shapes.column("k").to_numpy()] = shapes.column("size").to_numpy()
    shape_words[shapes.column("k").to_numpy()] = shapes.column("kinds").to_numpy()
    stayed = classes >= n_classes
    shape_size += np.bincount(classes[stayed] - n_classes, weights=seen[:named][stayed], minlength=SHAPES)
    shape_words += np.bincount(classes[stayed] - n_classes, minlength=SHAPES)
    fitted = context.broadcast(Model(head, classes, n_classes, class_pairs(pairs, classes, n_classes), shape_size, shape_words))
    floor = math.log10(total + HALF * (vocabulary + 1))

    def run(batches):
        m = fitted.value
        log_head = np.log10(np.concatenate([m.head.counts, [ends, 0.0]]) + HALF)
        last = len(m.head.words)
        for batch in batches:
            for first, words, sizes in _slices(batch.column(2)):
                ids, symbols, rare = m.head.read(words)
                kinds = m.classes[symbols]
                value = m.transition[np.concatenate([m.classes[[m.head.end]], kinds[:-1]]), kinds] + m.emission[ids]
                base = log_head[ids] - floor
                known = (ids >= 0) & ((ids < last) | (ends > 0))
                # what the counts of rare tokens add is joined in below
                value[rare] -= m.shape_size[symbols[rare] - m.head.clustered]
                base[rare] = -floor
                start = np.cumsum(sizes) - sizes
                cut = np.searchsorted(rare, np.concatenate([start, [len(words)]]))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array([words[i] for i in rare], pa.binary()))
                part_batch = batch.slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [part_batch.column(0), part_batch.column(1), pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), start)),
                     pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(value, start)), lists],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), text).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<binary>")
    # written with its row numbers, so they stay the same when a lost task runs again
    scored = common.saved(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    asked = scored.select("row", F.explode("rare").alias("token"))
    if total == ends:
        answered = asked.select("row", F.lit(0).cast("long").alias("c"))
    else:
        answered = asked.join(counts, "token", "left").select("row", F.coalesce("c", F.lit(0)).cast("long").alias("c"))
    added = answered.groupBy("row").agg(F.sum(F.log10(F.col("c") + HALF)).alias("more"), F.count(F.when(F.col("c") > 0, 1)).alias("known"))
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("rare").join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))
