"""The prefix trie of conversations, by the Euler-tour technique.

Turns are placed by a range sort with counts of equal rows, so neither a hot conversation nor a repeated row fills a task, and texts travel no
further than their digest. A prefix is identified by its depth and running sums of the pieces of a 128-bit hash of (place, turn); every node
checks that all its rows have one last turn and one parent, so a collision would be an error and no wrong result.

Euler tour: each node v has an enter arc 2v and an exit arc 2v + 1; an enter arc is followed by the enter arc of the first child or its own exit arc, an exit
arc by the enter arc of the next sibling or the exit arc of the parent. The list is ranked by contraction: chains inside a path are first contracted
where their arcs lie together, then random mates are spliced out round by round until at most LAST arcs are left; these are ranked in one task, and the
rounds are undone in reverse. Prefix sums by rank, in blocks, give at the two arcs of a node what lies between them: its subtree.

Defined results: null role and text are empty; turns sort by turn (null first), then role, the first 64 characters of the text, and its digest, so
ties are deterministic and equal rows each stay a turn; rows with a null conv_id form one conversation that has no number: it keeps its own turns, is
the smallest member only where it is the only one, and its decimal is empty (conv_id 2^63-1 is reserved for it); an empty table gives no rows;
other columns are ignored; a very long text is hashed where it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.llm import common

#: Every GROUP conversations share the opening of the first of them; h is crc32 of the decimal conv_id modulo SHARES.
GROUP, SHARES = 20, 4
NO_ID = (1 << 63) - 1
BLOCK = 4096
#: Most arcs that one task ranks at the end, and arcs of a task that contracts paths.
LAST, TASK_ARCS = 1 << 15, 400_000
PATH = 512
KEY = ["depth", "s0", "s1", "s2", "s3"]
PIECES = KEY[1:]


def running(rows: DataFrame, part: Sequence[str], pos: str, values: Sequence[str], levels: int = 1, block: int = BLOCK) -> DataFrame:
    """Adds `before_<value>`: sums over earlier integer positions of the same key, scanned in blocks of positions and then over block totals."""
    no = f"{pos}_no"
    placed = rows.withColumn(no, F.floor(F.col(pos) / block))
    window = Window.partitionBy(*part, no).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    inner = placed.select("*", *[F.coalesce(F.sum(v).over(window), F.lit(0)).alias(f"before_{v}") for v in values])
    totals = common.saved(placed.groupBy(*part, no).agg(*[F.sum(v).alias(v) for v in values]), "totals")
    if totals.groupBy(*part).count().filter("count > 1").isEmpty():
        return inner.drop(no)
    if levels:
        totals = running(totals, part, no, values, levels - 1, block)
    else:
        line = Window.partitionBy(*part).orderBy(no).rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select("*", *[F.coalesce(F.sum(v).over(line), F.lit(0)).alias(f"before_{v}") for v in values])
    carried = totals.filter(" OR ".join(f"before_{v} <> 0" for v in values)).select(*part, no, *[F.col(f"before_{v}").alias(f"carried_{v}") for v in values])
    joined = inner.join(common.small_side(common.saved(carried, "carried")), [*part, no], "left")
    return joined.select(*rows.columns, *[(F.col(f"before_{v}") + F.coalesce(f"carried_{v}", F.lit(0))).alias(f"before_{v}") for v in values])


def placed_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, sig, words): the turns of each conversation numbered from 1."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role, body = text("role"), text("text")
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"), F.col("turn"), role.alias("role"), F.substring(body, 1, 64).alias("head"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, body), 256).alias("sig"), F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["conv", "turn", "role", "head", "sig"]
    grouped = rows.groupBy(*order, "words").agg(F.count("*").alias("times"))
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = common.saved(grouped.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "conv", "sig", "words", "times", F.monotonically_increasing_id().alias("at")), "turns")
    numbered = running(line, ["conv"], "at", ["times"])
    return common.saved(numbered.select("conv", F.explode(F.sequence(F.col("before_times") + 1, F.col("before_times") + F.col("times"))).alias("pos"), "sig", "words"), "placed")


def share(conv: Column) -> Column:
    """h: how many turns a conversation takes over."""
    return F.when(conv == NO_ID, F.lit(0)).otherwise(F.crc32(conv.cast("string").cast("binary")) % SHARES)


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, n_turns) of all rebuilt conversations, (conv, depth, sig, words, ends) of their turns)."""
    sizes = placed.groupBy("conv").agg(F.max("pos").alias("own"))
    first = F.when(F.col("conv") != NO_ID, F.col("conv") - F.col("conv") % GROUP)
    convs = sizes.select("conv", "own", share(F.col("conv")).alias("h"), first.alias("first"))
    openings = placed.filter((F.col("pos") < SHARES) & (F.col("conv") % GROUP == 0) & (F.col("conv") != NO_ID))
    known = openings.groupBy(F.col("conv").alias("first")).agg(F.max("pos").alias("offered"))
    taken = F.least("h", F.coalesce("offered", F.lit(0)))
    convs = common.saved(convs.join(known, "first", "left").select(
        "conv", "first", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")), "convs")
    shared = convs.join(openings.select(F.col("conv").alias("first"), F.col("pos").alias("depth"), "sig", "words"), "first").filter("depth <= h")
    own = placed.join(convs, "conv").filter("pos > h").withColumn("depth", F.col("taken") + F.col("pos") - F.col("h"))
    columns = ["conv", "depth", "sig", "words", (F.col("depth") == F.col("n_turns")).alias("ends")]
    return convs.select("conv", "n_turns"), common.saved(shared.select(*columns).unionByName(own.select(*columns)), "rebuilt")


def prefixes(turns: DataFrame) -> DataFrame:
    """The turns (conv, depth, words, ends) with the key of the prefix they end, and `check`, equal for equal last turn and parent."""
    def piece(k: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(k // 2), "depth", "sig"), 32 * (k % 2)).bitwiseAND(F.lit(0xFFFFFFFF))

    hashed = turns.withColumns({p: piece(k) for k, p in enumerate(PIECES)})
    summed = running(hashed, ["conv"], "depth", PIECES)
    parent = [F.col(f"before_{p}").alias(f"p{k}") for k, p in enumerate(PIECES)]
    return summed.select("conv", "depth", "words", "ends", *[(F.col(f"before_{p}") + F.col(p)).alias(p) for p in PIECES], *parent,
                         F.xxhash64("sig", *[f"before_{p}" for p in PIECES]).alias("check"))


def nodes_of(rows: DataFrame) -> DataFrame:
    """(id, key, conv, n_convs, words, parent, parent_conv) of all nodes below the root, whose id is 0; ids are positive."""
    parents = [f"p{k}" for k in range(len(PIECES))]
    same = F.when(F.min("check") == F.max("check"), F.min("conv")).otherwise(F.raise_error(F.lit("two prefixes have one key")).cast("long"))
    found = rows.groupBy(*KEY).agg(F.count("*").alias("n_convs"), same.alias("conv"), F.max("words").alias("words"), *[F.max(p).alias(p) for p in parents])
    nodes = common.saved(found.withColumn("id", F.monotonically_increasing_id() + 1), "nodes")
    above = nodes.select("id", "conv", *KEY)
    on = (F.col("v.depth") - 1 == F.col("u.depth")) & (F.col("v.depth") > 1)
    for k, p in enumerate(PIECES):
        on = on & (F.col(f"v.p{k}") == F.col(f"u.{p}"))
    deep = nodes.filter("depth > 1").alias("v").join(above.alias("u"), on).select("v.*", F.col("u.id").alias("parent"), F.col("u.conv").alias("parent_conv"))
    top = nodes.filter("depth = 1").select("*", F.lit(0).cast("long").alias("parent"), F.lit(None).cast("long").alias("parent_conv"))
    return common.saved(deep.unionByName(top).drop(*parents), "nodes")


def successors(nodes: DataFrame) -> DataFrame:
    """(arc, next, conv, depth): the Euler tour as a linked list, from arc 0 to arc 1, whose next is -1."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = common.saved(nodes.select("id", "parent", "conv", "depth").repartitionByRange(parts, "parent", "conv").sortWithinPartitions("parent", "conv").withColumn(
        "at", F.monotonically_increasing_id()), "siblings")
    part = F.shiftrightunsigned("at", 33)
    edge = F.struct("parent", "id")
    # one row per partition of the sort
    heads = line.groupBy(part.alias("part")).agg(F.min_by(edge, "at").alias("head"), F.max_by(edge, "at").alias("tail"))
    beside = Window.orderBy("part")
    heads = F.broadcast(common.saved(heads.select("part", F.lead("head").over(beside).alias("after"), F.lag("tail").over(beside).alias("ahead")), "edges"))
    inside = Window.partitionBy("part").orderBy("at")
    beside_each = line.withColumn("part", part).select("*", F.lead(edge).over(inside).alias("right"), F.lag(edge).over(inside).alias("left")).join(heads, "part")
    after, ahead = F.coalesce("right", "after"), F.coalesce("left", "ahead")
    sibling = F.when(after["parent"] == F.col("parent"), after["id"])
    linked = common.saved(beside_each.select("id", "parent", "conv", "depth", sibling.alias("sibling"), F.coalesce(ahead["parent"] != F.col("parent"), F.lit(True)).alias("eldest")), "linked")
    child = linked.filter("eldest").select(F.col("parent").alias("id"), F.col("id").alias("child"))
    root = spark.range(1).select(F.col("id"), F.lit(None).cast("long").alias("parent"), F.lit(-1).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("sibling"))
    every = linked.select("id", "parent", "conv", F.col("depth").cast("long").alias("depth"), "sibling").unionByName(root).join(child, "id", "left")
    enter = F.struct((F.col("id") * 2).alias("arc"), F.coalesce(F.col("child") * 2, F.col("id") * 2 + 1).alias("next"))
    leave = F.struct((F.col("id") * 2 + 1).alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1)).cast("long").alias("next"))
    return every.select("conv", "depth", F.explode(F.array(enter, leave)).alias("a")).select("a.arc", "a.next", "conv", "depth")


def _back_to_heads(arc: np.ndarray, after: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For arcs in ascending order: index of the head of each one's chain, weight from the head to it, and index of its successor or -1."""
    at = np.minimum(np.searchsorted(arc, after), len(arc) - 1)
    follower = np.where(arc[at] == after, at, -1)
    head, away = np.arange(len(arc)), np.zeros(len(arc), np.int64)
    linked = follower >= 0
    head[follower[linked]] = np.flatnonzero(linked)
    away[follower[linked]] = weight[linked]
    while True:
        further = head[head]
        if (further == head).all():
            return head, away, follower
        away += away[head]
        head = further


def _arrays(batches) -> list[np.ndarray]:
    held = pa.Table.from_batches(list(batches))
    found = [np.asarray(held.column(i).to_numpy()) for i in range(3)]
    order = np.argsort(found[0])
    return [f[order] for f in found]


def _within_paths(arcs: DataFrame, parts: int) -> DataFrame:
    """(arc, next, weight, head, away): heads of the chains that lie together, with what follows the chain, and the other arcs with their head."""

    def run(batches):
        batches = list(batches)
        if not sum(map(len, batches)):
            return
        arc, after, weight = _arrays(batches)
        head, away, follower = _back_to_heads(arc, after, weight)
        tail = follower < 0
        end, total = np.full(len(arc), -1), np.zeros(len(arc), np.int64)
        end[head[tail]], total[head[tail]] = after[tail], (away + weight)[tail]
        for i in range(0, len(arc), 50_000):
            s = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(c[s]) for c in (arc, end, total, arc[head], away)], names=["arc", "next", "weight", "head", "away"])

    dealt = arcs.repartition(parts, "conv", F.floor(F.col("depth") / PATH))
    return common.saved(dealt.select("arc", "next", F.lit(1).cast("long").alias("weight")).mapInArrow(run, "arc long, next long, weight long, head long, away long"), "paths")


def ranks(arcs: DataFrame, last: int = LAST) -> DataFrame:
    """(arc, rank): places in the list (arc, next, conv, depth), from 0."""
    spark = arcs.sparkSession
    arcs = common.saved(arcs, "arcs")
    paths = _within_paths(arcs, common.partitions_for(spark, arcs.count(), TASK_ARCS))
    removed = [paths.filter("arc <> head").select("arc", "head", "away")]
    active = paths.filter("arc = head").select("arc", "next", "weight")
    turn = 0
    while active.count() > last:
        turn += 1
        coin = F.xxhash64("arc", F.lit(turn)).bitwiseAND(F.lit(1)) == 1
        stay, go = active.filter(coin), active.filter(~coin)
        mates = common.saved(stay.alias("a").join(go.alias("b"), F.col("a.next") == F.col("b.arc"), "left").select(
            "a.arc", F.col("a.weight").alias("away"), F.col("b.arc").alias("gone"), F.coalesce("b.next", "a.next").alias("next"),
            (F.col("a.weight") + F.coalesce("b.weight", F.lit(0))).alias("weight")), "mates")
        gone = mates.filter("gone IS NOT NULL").select(F.col("gone").alias("arc"), F.col("arc").alias("head"), "away")
        removed.append(gone)
        active = common.saved(mates.select("arc", "next", "weight").unionByName(go.join(gone, "arc", "left_anti")), "active")

    def rank(batches):
        batches = list(batches)
        if not sum(map(len, batches)):
            return
        arc, after, weight = _arrays(batches)
        _, away, _ = _back_to_heads(arc, after, weight)
        yield pa.RecordBatch.from_arrays([pa.array(arc), pa.array(away)], names=["arc", "rank"])

    # at most `last` rows
    found = common.saved(active.repartition(1).mapInArrow(rank, "arc long, rank long"), "ranks")
    for gone in reversed(removed):
        back = gone.join(found.select(F.col("arc").alias("head"), "rank"), "head").select("arc", (F.col("rank") + F.col("away")).alias("rank"))
        found = common.saved(found.unionByName(back), "ranks")
    return found


def subtree_sums(ranked: DataFrame, values: DataFrame, names: Sequence[str]) -> DataFrame:
    """(id, names): for each node the sums of the values (id, names) in its subtree, from prefix sums by rank."""
    arcs = ranked.withColumn("id", F.shiftright("arc", 1)).join(values, "id")
    own = F.col("arc").bitwiseAND(F.lit(1)) == 0
    summed = running(arcs.select("arc", "id", "rank", *[F.when(own, F.col(n)).otherwise(F.lit(0)).alias(n) for n in names]), [], "rank", names)
    signed = lambda n: F.sum(F.when(own, -F.col(f"before_{n}")).otherwise(F.col(f"before_{n}"))).alias(n)
    return summed.groupBy("id").agg(*[signed(n) for n in names])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the conv_ids of each key, ascending and joined by commas, read as a sorted stream of packed runs of ids."""
    decimal = lambda c: F.when(c == NO_ID, F.lit("")).otherwise(c.cast("string"))
    packed = ends.groupBy(*KEY, F.shiftright("conv", 12).alias("run")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), decimal), ",").alias("ids"))

    def stream(batches):
        now, digest, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6)), strict=True):
                if key != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(done) > 10_000:
                yield _keyed(done)
                done = []
        if now is not None:
            done.append((*now, digest.hexdigest()))
            yield _keyed(done)

    sorted_runs = packed.repartition(*KEY).sortWithinPartitions(*KEY, "run")
    return sorted_runs.select(*[F.col(k).cast("long").alias(k) for k in KEY], "run", "ids").mapInArrow(stream, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string")


def _keyed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], names=[*KEY, "ends_sha256"])


def trie(turns: DataFrame, last: int = LAST) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, the root included."""
    convs, texts = rebuilt(placed_turns(turns))
    rows = common.saved(prefixes(texts), "prefixes")
    nodes = nodes_of(rows)
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children"))
    least = F.min("conv").alias("conv")
    zero = F.lit(0).cast("long")
    root = convs.agg(least, F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("id"), "conv", "n_convs", zero.alias("words"), F.lit(None).cast("long").alias("parent"), F.lit(None).cast("long").alias("parent_conv"), *[zero.alias(k) for k in KEY])
    root = common.saved(root, "root")
    top = root.first()
    if top is None:
        return nodes.select(*_columns())
    every = nodes.withColumn("parent_conv", F.when(F.col("parent") == 0, F.lit(top.conv)).otherwise(F.col("parent_conv"))).unionByName(root)
    every = common.saved(every.join(children.withColumnRenamed("parent", "id"), "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "every")
    values = every.select("id", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    sums = subtree_sums(ranks(successors(nodes), last), values, ["n_leaves", "saved_tokens"])
    ends = rows.filter("ends").select("conv", *KEY).unionByName(convs.filter("n_turns = 0").select("conv", *[zero.alias(k) for k in KEY]))
    hashes = common.saved(end_hashes(ends), "ends")
    joined = every.join(sums, "id").join(hashes, KEY, "left")
    return joined.select(*_columns(True))


def _columns(real: bool = False) -> list[Column]:
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(f"{'parent_' if 'parent' in c else ''}conv_id")
    own = [F.col(c) if real else F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    empty = F.lit(hashlib.sha256().hexdigest())
    ends = F.coalesce("ends_sha256", empty) if real else empty
    return [named("conv"), F.col("depth").cast("long").alias("depth"), named("parent_conv"), "n_convs", *own, ends.alias("ends_sha256")]
