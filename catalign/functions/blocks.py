"""Ratio of two texts by their matching blocks, as array expressions.

The longest common block is taken first (of equally long ones the earliest in the left text, then in the right), then the same is
done with what lies before it in both and what lies behind it in both; the ratio is twice the letters of all blocks over the letters of both
texts. The pairs of windows still to do are a stack in the state of a fold. The longest block of a window is found in one sweep over the
left text: a start goes on while the right text contains what it spans, and a later start only counts if it spans more.

In a right text of 200 letters and more, letters that fill over a hundredth of it begin no block; a block found without them is then
widened by equal letters on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalign.functions.text import let

# From this many letters on frequent ones begin no block, and what counts as frequent.
LONG, SHARE = 200, 100
#: Stand for frequent letters of the left and the right text; two noncharacters, so they never match.
LEFT_MARK, RIGHT_MARK = "￾", "￿"


def _cut(text: Column, start: Column, size: Column) -> Column:
    return F.substring(text, start + 1, size)


def frequent_letters(right: Column) -> Column:
    """The letters of a long text that begin no block, as one string; empty for a short text."""
    often = F.floor(F.length(right) / SHARE) + 1
    kept = F.filter(F.array_distinct(F.split(right, "")), lambda c: (c != "") & (F.length(right) - F.length(F.replace(right, c, F.lit(""))) > often))
    return F.when(F.length(right) >= LONG, F.array_join(kept, "")).otherwise(F.lit(""))


def _masked(text: Column, letters: Column, mark: str) -> Column:
    marks = F.repeat(F.lit(mark), F.length(letters))
    return F.when(letters == "", text).otherwise(F.call_function("translate", text, letters, marks))


def longest_block(left: Column, right: Column) -> Column:
    """struct<i, k>: where the longest common block begins in the left text (from 0), and its length."""
    n = F.length(left)
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("k"), F.lit(0).alias("best"))

    def sweep(s: Column, _: Column) -> Column:
        spans = right.contains(_cut(left, s["i"], s["k"] + 1))
        return F.when(s["i"] + s["k"] >= n, s).when(spans, F.struct(s["i"].alias("i"), (s["k"] + 1).alias("k"), s["i"].alias("best"))).otherwise(
            F.struct((s["i"] + 1).alias("i"), s["k"].alias("k"), s["best"].alias("best")))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(2 * n, F.lit(1))), start, sweep,
                       lambda s: F.struct(s["best"].alias("i"), s["k"].alias("k")))


def _shared_start(left: Column, right: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.least(F.length(left), F.length(right)), F.lit(1)))
    return F.aggregate(places, F.lit(0), lambda n, at: F.when(
        (n == at - 1) & (at <= F.length(left)) & (F.substring(left, at, F.lit(1)) == F.substring(right, at, F.lit(1))), at).otherwise(n))


def _block(left: Column, right: Column, frequent: Column) -> Column:
    """struct<i, j, k> of the block that two windows match with; k is 0 if there is none."""
    def placed(a: Column, b: Column) -> Column:
        return let(longest_block(a, b), lambda m: F.struct(
            m["i"].alias("i"), F.when(m["k"] == 0, F.lit(0)).otherwise(F.call_function("instr", b, _cut(a, m["i"], m["k"])) - 1).alias("j"), m["k"].alias("k")))

    def widened(m: Column) -> Column:
        before = _shared_start(F.reverse(_cut(left, F.lit(0), m["i"])), F.reverse(_cut(right, F.lit(0), m["j"])))
        behind = _shared_start(_cut(left, m["i"] + m["k"], F.length(left)), _cut(right, m["j"] + m["k"], F.length(right)))
        return let(before, lambda n: F.struct((m["i"] - n).alias("i"), (m["j"] - n).alias("j"), (m["k"] + n + behind).alias("k")))

    found = let(_masked(left, frequent, LEFT_MARK), lambda a: let(_masked(right, frequent, RIGHT_MARK), lambda b: placed(a, b)))
    return let(found, lambda m: F.when(frequent == "", m).otherwise(widened(m)))


def matched_letters(left: Column, right: Column) -> Column:
    """Letters in matching blocks."""
    def window(a: Column, b: Column) -> Column:
        return F.struct(a.alias("a"), b.alias("b"))

    def state(stack: Column, total: Column) -> Column:
        return F.struct(stack.alias("stack"), total.alias("total"))

    def taken(s: Column, top: Column, m: Column) -> Column:
        a, b = top["a"], top["b"]
        beside = F.array(window(_cut(a, F.lit(0), m["i"]), _cut(b, F.lit(0), m["j"])),
                         window(_cut(a, m["i"] + m["k"], F.length(a)), _cut(b, m["j"] + m["k"], F.length(b))))
        rest = F.slice(s["stack"], F.lit(1), F.size(s["stack"]) - 1)
        worth = F.filter(beside, lambda w: (w["a"] != "") & (w["b"] != ""))
        return F.when(m["k"] == 0, state(rest, s["total"])).otherwise(state(F.concat(rest, worth), s["total"] + m["k"]))

    def whole(frequent: Column) -> Column:
        # every step takes a window, and a window that matches leaves two at most
        steps = F.sequence(F.lit(1), 2 * F.least(F.length(left), F.length(right)) + 1)
        step = lambda s, _: F.when(F.size(s["stack"]) == 0, s).otherwise(
            let(F.element_at(s["stack"], -1), lambda top: let(_block(top["a"], top["b"], frequent), lambda m: taken(s, top, m))))
        return F.aggregate(steps, state(F.array(window(left, right)), F.lit(0)), step, lambda s: s["total"])

    return let(frequent_letters(right), whole)


def block_ratio(left: Column, right: Column) -> Column:
    """Lower-cased block-matching ratio of two texts (order matters); null and empty texts score 0."""
    lower = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return let(lower(left), lambda a: let(lower(right), lambda b: F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        2.0 * matched_letters(a, b) / (F.length(a) + F.length(b)))))
