import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from catalign.llm import common, exact_dedup, graph, simhash, suffix_dedup


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    values = [rng.integers(0, 1 << 64, 500, dtype=np.uint64) for _ in range(3)]
    values.append(values[0][:100])
    merged = None
    for part in values:
        prefix = part >> np.uint64(61)
        for p in range(8):
            own = exact_dedup.QuotientFilter.of(part[prefix == p])
            back = exact_dedup.QuotientFilter.unpack(own.pack(3), p, 3)
            assert (back.fingerprints == own.fingerprints).all() and (back.counts == own.counts).all()
            merged = own if merged is None else merged.merge(back)
    want = Counter(np.concatenate(values).tolist())
    assert dict(zip(merged.fingerprints.tolist(), merged.counts.tolist(), strict=True)) == want


def test_copy_groups(docs):
    got = exact_dedup.copy_groups(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.text or "", []).append(r.doc_id)
    want = []
    for r in rows:
        own = groups[r.text or ""]
        keep = max((i for i in own if i is not None), default=None)
        want.append((r.doc_id, keep, len(own), r.doc_id == keep, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_drop_copies(docs, empty_docs):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 6, 7, 8, 9, 10]
    assert exact_dedup.drop_copies(empty_docs).count() == 0 and exact_dedup.copy_groups(empty_docs).count() == 0


def _fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs):
    for r in docs.select("text").collect():
        assert simhash.fingerprint(r.text) == _fingerprint(r.text)


def _labels(points, radius=3):
    near = np.bitwise_count(points[:, None] ^ points[None]) <= radius
    label = np.arange(len(points))
    while True:
        low = np.array([label[row].min() for row in near])
        if (low == label).all():
            return label
        label = low


def _cloud(seed, n, centres, flips):
    rng = np.random.default_rng(seed)
    out = rng.choice(rng.integers(0, 1 << 63, centres, dtype=np.uint64), n)
    for _ in range(flips):
        out ^= np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
    return np.unique(out)


@pytest.mark.parametrize(("centres", "flips"), [(1, 4), (40, 3), (900, 2)])
def test_tree_is_exact(centres, flips):
    points = _cloud(centres, 1200, centres, flips)
    assert (simhash.tree_links(points) == _labels(points)).all()


@pytest.mark.parametrize("shard_size", [40, 4096])
def test_links_across_shards(spark, shard_size):
    """A small shard size sends every hot shard through the parting by vantage points."""
    points = np.unique(np.concatenate([_cloud(3, 700, 2, 5), _cloud(4, 500, 60, 3)]))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    found = graph.components(simhash.links(frame, shard_size=shard_size)).collect()
    root = {r.node: r.root for r in found}
    label = _labels(points)
    groups, want = {}, {}
    for p, lab in zip(points.view(np.int64).tolist(), label.tolist(), strict=True):
        groups.setdefault(root.get(p, p), set()).add(p)
        want.setdefault(lab, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def _odd_ids(spark, clash):
    rows = [(1, "A b c"), (None, "A b c"), (None, "unique it is"), (5, "A b c"), (5, "other text here")]
    return clash(spark.createDataFrame(rows, "doc_id long, text string"))


def test_no_row_goes_with_the_id_of_another(spark, clash):
    frame = _odd_ids(spark, clash)
    others = [(None, "unique it is"), (5, "other text here")]
    for drop, kept in ((simhash.drop_near, [(1, "A b c")]), (exact_dedup.drop_copies, [(5, "A b c")])):
        left = drop(frame)
        assert left.columns == frame.columns and sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([*kept, *others], key=repr)


def test_near_groups(docs, empty_docs):
    got = {(r.doc_id, r.component_id) for r in simhash.near_groups(docs).collect()}
    assert (None, 1) in got and (2, 1) in got and (4, 3) in got and (8, 3) in got and (6, 5) in got and (10, 5) in got and (7, 7) in got
    left = simhash.drop_near(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 5, 7, 7, 9]
    assert simhash.near_groups(empty_docs).count() == 0 and simhash.drop_near(empty_docs).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5), (2000, 1999), (1999, 2000)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)} | {1999: 1999, 2000: 1999}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_leave_few_files(spark, tmp_path, monkeypatch):
    """Tables of a round are written over, and few edges go to few files even where shuffles have many partitions."""
    monkeypatch.setattr(common, "shared_dir", lambda _spark: str(tmp_path))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
        assert graph.components(chain).filter("root = 0").count() == 301
        assert len(list(tmp_path.glob("llm/*"))) == 3 and len(list(tmp_path.glob("llm/*/*.parquet"))) <= 3
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _strip(texts, window=200):
    counts = Counter(b[i:i + window] for b in texts for i in range(len(b) - window + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if counts[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def _texts():
    rnd = random.Random(5)
    make = lambda n: "".join(rnd.choices("abcdefgh é\n", k=n))
    line, passage = make(90), make(260)
    out = [make(rnd.randrange(0, 700)) + passage[rnd.randrange(0, 40):] + make(rnd.randrange(0, 300)) for _ in range(12)]
    out += [make(150) + line + make(150) for _ in range(30)]
    copy = make(900)
    near = copy[:400] + "X" + copy[401:]
    out += [copy, copy, near, near[:600], "a" * 700, "ab" * 300, "The " * 200, "", None, make(199), passage[:200], "x" * 199, "é" * 150]
    return out


@pytest.mark.parametrize("hot_runs", [2, 1024])
def test_suffix_dedup_against_brute_force(spark, clash, monkeypatch, hot_runs):
    """With few hot runs allowed the anchors go through all rounds of longer n-grams."""
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot_runs)
    texts = _texts()
    frame = clash(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.strip(frame).collect()}
    want = _strip([(t or "").encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want


def test_suffix_dedup_of_no_rows(spark, empty_docs):
    assert suffix_dedup.strip(empty_docs).count() == 0
    short = spark.createDataFrame([(None, "short"), (None, "short")], "doc_id long, text string")
    assert [(r.n_bytes, r.n_removed) for r in suffix_dedup.strip(short).collect()] == [(5, 0), (5, 0)]


def test_suffix_array_order():
    rnd = random.Random(3)
    for _ in range(60):
        codes = []
        for _ in range(rnd.randrange(1, 4)):
            codes += [rnd.choice((1, 2, 98, 256)) for _ in range(rnd.randrange(0, 50))] + [0]
        got = suffix_dedup.suffix_array(np.array(codes, np.uint16), 1000).tolist()
        assert got == sorted(range(len(codes)), key=lambda i: codes[i:])


def test_anchor_runs_cover_every_start():
    data = (b"abc" * 100 + bytes(random.Random(1).choices(range(256), k=3000)))
    for gram in suffix_dedup.GRAMS:
        starts = [i for begin, size, _, _ in suffix_dedup.runs(data, gram) for b, n in zip(begin.tolist(), size.tolist(), strict=True) for i in range(b, b + n)]
        assert starts == list(range(len(data) - 199))
