import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from catalign.llm import block_tables, queries

FOLDER = "/root/testdata/sf0.001"


def _spread(h):
    """Spark's xxhash64 of longs."""
    seed = 42
    for x in h:
        seed = xxhash.xxh64_intdigest(int(x).to_bytes(8, "little"), seed)
    return seed


def _fingerprint(text):
    low = (text or "").lower()
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in low.split(" ") if w]
    found = Counter([_spread(p) for p in zip(hashes, hashes[1:], strict=False)] if len(hashes) > 1 else hashes)
    out = []
    for k in range(block_tables.WORDS):
        votes = [(h if not k else xxhash.xxh64_intdigest(k.to_bytes(4, "little"), _spread([h])), n.bit_length()) for h, n in found.items()]
        total = sum(n for _, n in votes)
        out.append(sum(1 << b for b in range(64) if 2 * sum(n for h, n in votes if h >> b & 1) > total))
    return tuple(out)


def _follow(rows):
    """(doc_id, text, next text) by descending doc_id."""
    key = lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest((r[1] or "").encode(), 42) >> 52, _signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)), r[1] or "")
    line = sorted(rows, key=key)
    return [(i, t or "", line[(k + 1) % len(line)][1] or "") for k, (i, t) in enumerate(line)]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _want(rows):
    out = []
    for i, text, after in _follow(rows):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = map(_fingerprint, (text, edited, after))
        like = lambda x, y: 1 - sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True)) / block_tables.BITS
        as_hex = lambda x: "".join(f"{w:016x}" for w in reversed(x))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_hex(a), as_hex(b), like(a, b), like(a, c)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("ranges", [3, 1 << 16])
def test_given_documents(spark, monkeypatch, ranges):
    monkeypatch.setattr(block_tables, "MOST_RANGES", ranges)
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = block_tables.digest(queries.table(spark, FOLDER, "documents")).select(COLUMNS + ["n_near"]).collect()
    want = _want(rows)
    assert sorted((tuple(r)[:7] for r in got), key=repr) == want
    points = np.array([[int(r[3][:16], 16), int(r[3][16:], 16)] for r in want], np.uint64)
    near = (np.bitwise_count(points[:, None] ^ points[None]).sum(axis=2) <= block_tables.RADIUS).sum(axis=1)
    counts = {r[0]: int(n) for r, n in zip(want, near, strict=True) if r[0] % 100 == 0}
    assert {r.doc_id: r.n_near for r in got if r.doc_id % 100 == 0} == counts and all(r.n_near is None for r in got if r.doc_id % 100)


def test_edited_halves_are_told_from_strangers(spark):
    """Of all documents of the table nearly all are nearer to their own edit than to the next document."""
    got = queries.QUERIES["op12_block_tables"](spark, "/root/testdata/sf0.01").select("near_edited", "near_next").toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.98 and got.near_edited.mean() > 0.65 and abs(got.near_next.mean() - 0.5) < 0.03


def test_rows_of_one_id_and_of_none(spark, docs, empty_docs):
    got = sorted((tuple(r) for r in block_tables.digest(docs).select(COLUMNS).collect()), key=repr)
    assert got == _want([(r.doc_id, r.text) for r in docs.collect()])
    hot = [(5, f"text {i % 7} of a hot id") for i in range(60)] + [(None, "none"), (None, "none"), (None, None)] + [(i, f"other words {i}") for i in range(30)]
    frame = spark.createDataFrame(hot, "doc_id long, text string")
    got = sorted((tuple(r) for r in block_tables.digest(frame).select(COLUMNS).collect()), key=repr)
    assert got == _want(hot)
    alone = block_tables.digest(spark.createDataFrame([(3, "abc def")], "doc_id long, text string")).first()
    assert alone.near_edited <= 1 and alone.near_next == 1
    assert block_tables.digest(empty_docs).count() == 0


def test_ranges_in_two_steps(spark):
    bounds = list(range(3000, -3000, -7))
    got = spark.range(-3100, 3100).select("id", block_tables._place(F.col("id"), bounds).alias("p")).collect()
    assert all(r.p == sum(b >= r.id for b in bounds) for r in got)


@pytest.mark.parametrize(("radius", "hot"), [(0, 2), (1, 4), (3, 3), (3, 10**6), (6, 10)])
def test_near_fingerprints_against_brute_force(spark, radius, hot):
    """A small `hot` sends most keys to the tables of further levels."""
    rng = np.random.default_rng(radius)
    points = rng.choice(rng.integers(0, 1 << 63, (9, 2), dtype=np.uint64), 300)
    for _ in range(4):
        flip = np.where(rng.random(300) < 0.5, np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64), np.uint64(0))
        points[np.arange(300), rng.integers(0, 2, 300)] ^= flip
    points = np.unique(points, axis=0)
    signed = points.view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp array<long>")
    got = [(tuple(r.fp), tuple(r.near), r.distance) for r in block_tables.near_fingerprints(frame.limit(100000), frame, radius, hot).collect()]
    away = np.bitwise_count(points[:, None] ^ points[None]).sum(axis=2)
    want = [(tuple(signed[i]), tuple(signed[j]), int(away[i, j])) for i, j in zip(*np.nonzero(away <= radius), strict=True)]
    assert sorted(got) == sorted(want)


def test_no_python_in_the_plan(spark):
    """The main path is made of Spark expressions: no Python, pandas or Arrow node in the plans of its parts."""
    rows = block_tables.spliced(queries.table(spark, FOLDER, "documents"))
    near = block_tables.near_fingerprints(rows.select("fp").distinct(), rows.select("fp").distinct())
    for frame in (rows, near):
        plan = frame._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_many_repeats_do_not_overflow(spark):
    text = " ".join(f"w{i % 3000} x" for i in range(40_000))
    got = spark.createDataFrame([(text,), ("a",), ("",), (None,)], "text string").select(block_tables.fingerprint(F.col("text")).alias("fp"), "text").collect()
    assert all(tuple(x % (1 << 64) for x in r.fp) == _fingerprint(r.text) for r in got)
