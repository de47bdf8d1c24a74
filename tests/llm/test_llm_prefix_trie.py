import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalign.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _trie(rows):
    """The contract in plain Python: conversations as tuples of turns."""
    own = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        own.setdefault(c, []).append((turn is not None, turn or 0, role, text[:64], digest, text))
    own = {c: [(t[2], t[5]) for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        first = None if c is None else c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    low = lambda cs: min((c for c in cs if c is not None), default=None)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        leaf = lambda n: not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members)
        ends = sorted((c for c in cs if len(whole[c]) == len(node)), key=lambda c: (c is None, c or 0))
        out.append((low(cs), len(node), low(members[node[:-1]]) if node else None, len(cs), sum(len(n) == len(node) + 1 for n in below), sum(map(leaf, below)),
                    sum((len(members[n]) - 1) * len(_words(n[-1][1])) for n in below if n),
                    hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()))
    return sorted(out, key=repr)


def _words(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def _random_rows(seed, n):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-45, 130), n):
        for turn in range(rnd.randrange(1, 8)):
            rows.append((c, turn, rnd.choice(("user", "assistant", None)), rnd.choice(("hi", "hi there", "a b  c", "", None, "ünï code words"))))
    rows += [(5, None, "user", "early"), (5, 0, "user", "hi"), (5, 0, "user", "hi"), (None, 1, "user", "x y"), (None, 0, None, None), (2000, 0, "user", "one two three")]
    return rows


def _got(frame, **more):
    return sorted((tuple(r) for r in prefix_trie.trie(frame, **more).collect()), key=repr)


@pytest.mark.parametrize(("last", "block"), [(1 << 15, 4096), (6, 3)])
def test_against_brute_force(spark, clash, monkeypatch, last, block):
    """Few arcs at the end and short blocks send the list through rounds of mates and the sums through all levels."""
    monkeypatch.setattr(prefix_trie.running, "__defaults__", (1, block))
    rows = _random_rows(last, 40)
    assert _got(clash(spark.createDataFrame(rows, SCHEMA)), last=last) == _trie(rows)


def test_long_and_copied_conversations(spark):
    """Beyond one path length, a deep chain; a text of many words; many equal conversations."""
    long = [(3, i, "user", f"turn {i}") for i in range(700)]
    rows = long + [(4, 0, "user", "w " * 50_000)] + [(c, t, "user", f"same {t}") for c in range(1000, 1200) for t in range(4)]
    got = {(r[0], r[1]): r for r in _got(spark.createDataFrame(rows, SCHEMA), last=20)}
    want = {(r[0], r[1]): r for r in _trie(rows)}
    assert got == want


def test_few_rows(spark, empty_docs):
    assert _got(spark.createDataFrame([], SCHEMA)) == []
    for rows in ([(7, 0, "user", "a")], [(None, None, None, None)], [(0, 0, "u", "a b"), (1, 0, "u", "a b"), (2, 0, "u", "a b")]):
        assert _got(spark.createDataFrame(rows, SCHEMA)) == _trie(rows)


def test_list_ranking_of_any_list(spark):
    rnd = random.Random(1)
    order = list(range(3000))
    rnd.shuffle(order)
    rows = [(a, b, rnd.randrange(50), 0) for a, b in zip(order, [*order[1:], -1], strict=True)]
    found = {r.arc: r["rank"] for r in prefix_trie.ranks(spark.createDataFrame(rows, "arc long, next long, conv long, depth long"), last=100).collect()}
    assert found == {a: i for i, a in enumerate(order)}


def test_chains():
    arc, after = np.array([1, 2, 5, 7, 9]), np.array([5, 99, 2, -1, 7])
    head, away, follower = prefix_trie._back_to_heads(arc, after, np.array([1, 2, 3, 4, 5]))
    assert arc[head].tolist() == [1, 1, 1, 9, 9] and away.tolist() == [0, 4, 1, 5, 0] and follower.tolist() == [2, -1, 1, -1, 3]


def test_collisions_are_errors(spark):
    rows = spark.createDataFrame([(1, 1, 1, 7), (2, 1, 1, 8)], "conv long, depth long, words long, check long")
    for name in (*prefix_trie.PIECES, "p0", "p1", "p2", "p3"):
        rows = rows.withColumn(name, F.lit(0).cast("long"))
    with pytest.raises(Exception, match="one key"):
        prefix_trie.nodes_of(rows)
