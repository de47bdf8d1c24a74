"""Compare every text with a list of names without emitting pairs.

The list is cut into tiles of bounded size and texts into chunks, both by hash of distinct values,
so no task depends on how often a value or a brand occurs. A task sees one chunk and one tile and
returns one row per text; the tiles of a text are folded afterwards. One tile is the usual case; a
longer list only means more tiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.functions.text import let

TILE_ROWS = 2000
NAME_ROWS = 8000  # names of a tile in the best-ratio search, laid out in blocks
BLOCK_ROWS = 4000
BROADCAST_CHARS = 4_000_000
MIN_CHUNKS = 32
CHUNK_ROWS = 2000


def meet(texts: DataFrame, keys: Sequence[str], names: DataFrame, fields: Sequence[str],
         tile_rows: int = TILE_ROWS) -> tuple[DataFrame, int]:
    """Texts joined to ``names`` as arrays of structs, one row per text and tile, each array sorted by its first field.

    Rows and characters are counted first: they set the number of tiles, and only a list that is
    measured to be small is broadcast; a longer one joins on tile and chunk, so no key carries all texts.
    """
    chars = F.sum(sum((F.coalesce(F.length(F.col(f).cast("string")), F.lit(0)) for f in fields), F.lit(16)))
    rows, size = names.agg(F.count("*"), F.coalesce(chars, F.lit(0))).first()
    count = max(1, math.ceil(rows / tile_rows))
    tile = F.pmod(F.xxhash64(*fields), F.lit(count)).cast("int")
    packed = (names.select(tile.alias("tile"), F.struct(*fields).alias("s"))
              .groupBy("tile").agg(F.array_sort(F.collect_list("s")).alias("names")))
    spread = texts.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    if size <= BROADCAST_CHARS:
        return spread.join(F.broadcast(packed), "tile", "left"), count
    chunks = _chunks(texts)
    dealt = spread.withColumn("chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int"))
    packed = packed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return dealt.join(packed, ["tile", "chunk"], "left").drop("chunk"), count


def first_hit(texts: DataFrame, keys: Sequence[str], names: DataFrame, fields: Sequence[str],
              test, out: str = "hit", tile_rows: int = TILE_ROWS) -> DataFrame:
    """Left join to the first name (by ``fields[0]``) for which ``test(row, name)`` holds.

    ``texts`` is unique on ``keys``; ``test`` gets the text row's columns and a name struct.
    """
    met, count = meet(texts, keys, names, fields, tile_rows)
    hits = met.select(*keys, F.get(F.filter("names", test), F.lit(0)).alias(out))
    return hits if count == 1 else hits.groupBy(*keys).agg(F.min(out).alias(out))


def best_hit(texts: DataFrame, keys: Sequence[str], names: DataFrame, fields: Sequence[str],
             rank, out: str = "hit", tile_rows: int = TILE_ROWS, *, own: Column) -> DataFrame:
    """The largest ``rank(name, own)`` struct of every text over all names; ``own``, an expression over the text row, is evaluated once per tile."""
    met, count = meet(texts, keys, names, fields, tile_rows)
    best = let(own, lambda value: F.array_max(F.transform("names", lambda name: rank(name, value))))
    hits = met.select(*keys, best.alias(out))
    return hits if count == 1 else hits.groupBy(*keys).agg(F.max(out).alias(out))


def all_hits(texts: DataFrame, keys: Sequence[str], names: DataFrame, fields: Sequence[str],
             test, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per text and name that passes ``test``."""
    met, _ = meet(texts, keys, names, fields, tile_rows)
    return (met
            .select(*keys, F.explode(F.filter("names", test)).alias("hit"))
            .select(*keys, "hit.*"))


def _chunks(df: DataFrame, tiles: int = 1) -> int:
    """Chunks of at most about CHUNK_ROWS counted texts, so what a task holds does not grow with the data; with ``tiles``, no more than keep all tasks busy."""
    busy = max(MIN_CHUNKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(math.ceil(busy / tiles), math.ceil(df.count() / CHUNK_ROWS))


def _cogrouped(left: DataFrame, right: DataFrame, parts: int, run, schema: str) -> DataFrame:
    """Run ``run(chunk, tile)`` per pair of groups; a fixed partition count keeps the heavy work spread out."""
    by = ["chunk", "tile"]
    return (left.repartition(parts, *by).groupBy(*by).cogroup(right.repartition(parts, *by).groupBy(*by))
            .applyInPandas(run, schema))


LETTERS = 96
LEAD = 16  # names finished first, to have a high score to compare bounds with
ALIGNED = 200  # from this length on the matcher drops frequent letters, so block bounds do not hold


def _letters(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)


def _letter_counts(texts: list[str]) -> np.ndarray:
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return np.bincount(rows * LETTERS + _letters(texts) % LETTERS, minlength=len(texts) * LETTERS).astype(np.int32).reshape(len(texts), LETTERS)


def _letter_prefixes(codes: np.ndarray) -> np.ndarray:
    """Letter counts of every prefix of each padded row (padding is -1)."""
    rows, width = codes.shape
    steps = np.zeros((rows, width + 1, LETTERS), dtype=np.uint8)
    at = np.nonzero(codes >= 0)
    steps[at[0], at[1] + 1, codes[at] % LETTERS] = 1
    return np.cumsum(steps, axis=1, dtype=np.uint8)


class _Names:
    """Letters of one block of names, laid out so that bounds and ratios for a text come from whole-array operations."""

    def __init__(self, entries: list[str]) -> None:
        self.sizes = np.array([len(e) for e in entries], dtype=np.int64)
        self.counts = _letter_counts(entries)
        short = [e if len(e) < ALIGNED else "" for e in entries]
        self.short = self.sizes < ALIGNED
        lengths = np.array([len(e) for e in short], dtype=np.int64)
        plain = np.full((len(entries), int(lengths.max(initial=0))), -1, dtype=np.int32)
        plain[np.arange(plain.shape[1])[None, :] < lengths[:, None]] = _letters(short)
        self.prefixes = _letter_prefixes(plain)
        # letters as small numbers from 1 on: 0 is padding, and what no name holds gets the number behind the last
        self.alphabet = np.unique(plain[plain >= 0])
        self.kind = np.uint8 if len(self.alphabet) < 255 else np.int32
        self.codes = np.where(plain >= 0, np.searchsorted(self.alphabet, plain) + 1, 0).astype(self.kind)

    def letter_bound(self, own: str, rows: np.ndarray) -> np.ndarray:
        """Ratio if all shared letters were aligned."""
        shared = np.minimum(self.counts[rows], _letter_counts([own])[0]).sum(axis=1)
        return 2.0 * shared / np.maximum(1, self.sizes[rows] + len(own))

    def _blocks(self, own: np.ndarray, rows: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block that the matcher takes first in each window: length, end in the text, end in the name. Longest, then earliest in the text, then in the name."""
        a0, a1, b0, b1 = windows
        # letters run down and windows across, so that every step is one pass over long rows
        at = a0 + np.arange((a1 - a0).max())[:, None]
        left = np.where(at < a1, own[np.minimum(at, len(own) - 1)], len(self.alphabet) + 1).astype(self.kind)
        at = b0 + np.arange((b1 - b0).max())[:, None]
        right = np.where(at < b1, self.codes[rows, np.minimum(at, self.codes.shape[1] - 1)], 0).astype(self.kind)
        run = np.zeros((len(right) + 1, len(rows)), dtype=np.uint8)
        fresh = np.zeros_like(run)
        longest_yet = np.zeros(len(rows), dtype=np.uint8)
        end_own, end_name = (np.zeros(len(rows), dtype=np.int64) for _ in range(2))
        for i, letter in enumerate(left):
            np.add(run[:-1], 1, out=fresh[1:])
            fresh[1:] *= (right == letter).view(np.uint8)
            run, fresh = fresh, run
            longest = run.max(axis=0)
            better = np.flatnonzero(longest > longest_yet)
            if len(better):
                longest_yet[better], end_own[better] = longest[better], i + 1
                end_name[better] = (run[:, better] == longest[better]).argmax(axis=0)
        length = longest_yet.astype(np.int64)
        return length, a0 + end_own, b0 + end_name

    def scores(self, own: str, rows: np.ndarray, extra: np.ndarray, best: float, lead: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` whose ratio plus ``extra`` reaches ``best``, and these scores; the text and all names have fewer than 200 letters.

        All windows still to do are matched at once. After each turn the letters shared inside the open windows bound what a name can still reach, and
        names that cannot reach ``best`` are left. After the first turn the ``lead`` names of the highest bounds are finished to raise ``best``.
        """
        letters = _letters([own])
        place = np.searchsorted(self.alphabet, letters)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == letters
        coded = np.where(known, place + 1, len(self.alphabet) + 1).astype(self.kind)
        mine = _letter_prefixes(letters[None, :])[0]
        total, matched = self.sizes[rows] + len(own), np.zeros(len(rows), dtype=np.int64)
        of = np.flatnonzero(self.sizes[rows] > 0)
        windows = np.array([np.zeros_like(of), np.full_like(of, len(own)), np.zeros_like(of), self.sizes[rows[of]]])
        turn = 0
        while True:
            a0, a1, b0, b1 = windows
            named = rows[of]
            shared = np.minimum(mine[a1] - mine[a0], self.prefixes[named, b1] - self.prefixes[named, b0]).sum(axis=1, dtype=np.int64)
            most = matched + np.bincount(of, shared, minlength=len(rows)).astype(np.int64)
            score = np.minimum(1.0, 2.0 * most / total + extra)
            if turn == 1 and len(rows) > lead > 0:
                first = np.argpartition(-score, lead)[:lead]
                best = max(best, self.scores(own, rows[first], extra[first], best)[1].max(initial=0.0))
            alive = score >= best - 1e-9
            open_ = alive[of] & (shared > 0)
            of, windows = of[open_], windows[:, open_]
            if not len(of):
                return rows[alive], score[alive]
            length, end_own, end_name = self._blocks(coded, rows[of], windows)
            matched += np.bincount(of, length, minlength=len(rows)).astype(np.int64)
            a0, a1, b0, b1 = windows
            beside = np.hstack([np.array([a0, end_own - length, b0, end_name - length]), np.array([end_own, a1, end_name, b1])])
            of = np.hstack([of, of])
            worth = np.hstack([length, length]) > 0
            worth &= (beside[1] > beside[0]) & (beside[3] > beside[2])
            of, windows = of[worth], beside[:, worth]
            turn += 1


def _word_flags(texts: list[str]) -> np.ndarray:
    words = [w for _, group in fixed.BOOST_WORDS for w in group]
    return np.array([[w in t for w in words] for t in texts], dtype=bool).reshape(len(texts), len(words))


def _reaching(laid: _Names, entries: list[str], own: str, rows: np.ndarray, extra: np.ndarray, best: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows among which are all that have the highest score from ``best`` on, and their scores."""
    most = np.minimum(1.0, laid.letter_bound(own, rows) + extra[rows])
    order = np.argsort(-most, kind="stable")
    rows, most = rows[order], most[order]
    found = []
    whole = laid.short[rows] if len(own) < ALIGNED else np.zeros(len(rows), dtype=bool)
    for k, limit in zip(rows[~whole], most[~whole]):
        if limit < best - 1e-9:
            break
        score = min(1.0, SequenceMatcher(None, own, entries[k]).ratio() + float(extra[k]))
        found.append((k, score))
        best = max(best, score)
    parts = [(np.array([k for k, _ in found], dtype=np.int64), np.array([score for _, score in found]))]
    rows, most = rows[whole], most[whole]
    for part in (slice(0, LEAD), slice(LEAD, None)):
        reach = rows[part][most[part] >= best - 1e-9]
        if len(reach):
            parts.append(laid.scores(own, reach, extra[reach], best, LEAD))
            best = max(best, parts[-1][1].max(initial=0.0))
    return np.concatenate([r for r, _ in parts]), np.concatenate([x for _, x in parts])


def nearest_names(texts: DataFrame, names: DataFrame, *, fold: str = "lower", boost: bool = False,
                  by_brand: bool = False, tile_rows: int = NAME_ROWS) -> DataFrame:
    """Exact best name per text under the block-matching ratio.

    ``texts(text[, brand])`` and ``names(name, position[, name_brand])`` hold distinct rows. With
    ``by_brand`` a name counts when its brand contains the text's brand or the reverse; a text whose
    brand fits no name at all is compared with every name. Letter counts and the longest common block
    bound each ratio from above, so most names are never aligned. Result: ``text[, brand], name, position, score``.
    """
    tiles = max(1, math.ceil(names.count() / tile_rows))
    chunks = _chunks(texts, tiles)
    keys = ["text", "brand"] if by_brand else ["text"]
    change = str.lower if fold == "lower" else str.upper
    weights = np.array([w for w, group in fixed.BOOST_WORDS for _ in group])
    cap = fixed.BOOST_CAP

    left = (texts.withColumn("chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)))
            .withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))))
    right = (names.withColumn("tile", F.pmod(F.xxhash64("name", "position"), F.lit(tiles)).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))))

    def search(chunk: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("position").reset_index(drop=True)
        entries = [change(x or "") for x in tile["name"]]
        brands = np.array([(b or "").upper() for b in tile["name_brand"]], dtype=object) if by_brand else None
        masks: dict[str, np.ndarray] = {}
        asked = []
        for row in chunk.itertuples(index=False):
            fits, mask = True, None
            if by_brand:
                brand = (row.brand or "").upper().strip()
                if brand not in masks:
                    masks[brand] = np.array([not row.brand or brand in b or b in brand for b in brands], dtype=bool)
                fits = bool(masks[brand].any())
                mask = masks[brand] if fits else None
            asked.append(((row.text, row.brand) if by_brand else (row.text,), change(row.text or ""), fits, mask))
        best, place = np.zeros(len(asked)), np.full(len(asked), -1)
        # a best score found in one block rules out names of the next
        for start in range(0, len(entries), BLOCK_ROWS):
            block = entries[start:start + BLOCK_ROWS]
            laid, flags = _Names(block), _word_flags([e.lower() for e in block])
            for n, (_, own, _, mask) in enumerate(asked):
                picked = np.arange(len(block)) if mask is None else np.flatnonzero(mask[start:start + BLOCK_ROWS])
                if own and len(picked):
                    extra = np.zeros(len(block))
                    if boost:
                        extra = np.minimum(cap, ((flags & _word_flags([own.lower()])[0]) * weights).sum(axis=1))
                    rows, scores = _reaching(laid, block, own, picked, extra, best[n])
                    top = scores.max(initial=0.0)
                    if top > best[n]:
                        best[n], place[n] = top, start + rows[scores == top].min()
        out = [(*key, fits, best[n], tile["name"][place[n]] if place[n] >= 0 else None, int(tile["position"][place[n]]) if place[n] >= 0 else None)
               for n, (key, _, fits, _) in enumerate(asked)]
        return pd.DataFrame(out, columns=[*keys, "fits", "score", "name", "position"]).astype({"position": "Int64"})

    schema = ("text string, " + ("brand string, " if by_brand else "")
              + "fits boolean, score double, name string, position long")
    scored = _cogrouped(left, right, chunks * tiles, search, schema)
    scored = scored.filter(F.col("text").isNotNull())
    order = F.struct((~F.col("fits")).alias("a"), (-F.col("score")).alias("b"), F.col("position").alias("c"))
    best = scored.groupBy(*keys).agg(F.min_by(F.struct("name", "position", "score"), order).alias("m"))
    return best.select(*keys, "m.*")


def nearest_vectors(items: DataFrame, names: DataFrame, *, blocked: bool = False,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """Exact highest-cosine name per item: ``items(id, vector[, block])``, ``names(position, vector[, block])``.

    One matrix product per chunk and tile; with ``blocked`` only names of the item's block count.
    Result: ``id, position, similarity``; ties go to the lowest position, and only positive
    similarities match.
    """
    chunks = _chunks(items)
    tiles = max(1, math.ceil(names.count() / tile_rows))
    left = (items.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)))
            .withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))))
    right = (names.withColumn("tile", F.pmod(F.xxhash64("position"), F.lit(tiles)).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))))

    def units(vectors: pd.Series) -> np.ndarray:
        matrix = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(norms == 0, 1.0, norms)

    def search(chunk: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": [], "position": [], "similarity": []})
        if chunk.empty or tile.empty:
            return empty
        tile = tile.sort_values("position").reset_index(drop=True)
        scores = units(chunk["vector"]) @ units(tile["vector"]).T
        if blocked:
            same = chunk["block"].to_numpy()[:, None] == tile["block"].to_numpy()[None, :]
            scores = np.where(same, scores, -2.0)
        best = scores.argmax(axis=1)
        found = scores[np.arange(len(chunk)), best]
        out = pd.DataFrame({"id": chunk["id"].to_numpy(), "position": tile["position"].to_numpy()[best],
                            "similarity": found})
        return out[out["similarity"] > 0]

    scored = _cogrouped(left, right, chunks * tiles, search, "id long, position long, similarity double")
    order = F.struct((-F.col("similarity")).alias("s"), F.col("position").alias("p"))
    return (scored.groupBy("id").agg(F.min_by(F.struct("position", "similarity"), order).alias("m"))
            .select("id", "m.*"))
