import duckdb
import numpy as np
import pytest

import corpus_pipeline
from catalign.llm import near_copies, queries


def _kept(rows):
    """doc_ids that stay, by all pairs of five-word shingle sets in plain Python."""
    sets, label = [], [i for i, _ in rows]
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    moved = True
    while moved:
        moved = False
        for i, j in pairs:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                moved = True
    return sorted(i for (i, _), least in zip(rows, label, strict=True) if i == least)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_stage_keeps_one_of_all_pairs_at_four_fifths(spark, folder):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    kept = dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, queries.table(spark, folder, "documents"), folder)
    assert sorted(r.doc_id for r in kept.collect()) == _kept(rows)


@pytest.mark.parametrize("star_rounds", [0, 3])
def test_chains_of_edited_copies(spark, monkeypatch, star_rounds):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(12):
        words = [f"w{x}" for x in rng.integers(0, 10_000, int(rng.integers(6, 120)))]
        for _ in range(15):
            words = list(words)
            words[int(rng.integers(len(words)))] = f"e{rng.integers(10_000)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(900, ""), (901, None), (902, " \n"), (903, "one two"), (904, "ONE  two")]
    plain = near_copies.links
    monkeypatch.setattr(near_copies, "links", lambda *a: plain(*a, star_rounds=star_rounds))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.drop_near(docs).collect()) == _kept(rows)


def test_cluster_at_the_threshold_makes_few_candidates(spark, monkeypatch):
    """Edited copies of one text, most of them just below 0.8 to each other, and a line common to many different texts."""
    rng = np.random.default_rng(9)
    base, line = [f"w{i}" for i in range(150)], " ".join(f"common{i}" for i in range(12))
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.integers(0, 150, int(rng.integers(1, 5))):
            words[at] = f"e{rng.integers(40)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, line + " " + " ".join(f"x{rng.integers(10_000)}" for _ in range(int(rng.integers(1, 5))))) for i in range(400)]
    tested = []
    plain = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a: tested.append(pairs.count()) or plain(pairs, *a))
    kept = sorted(r.doc_id for r in near_copies.drop_near(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == _kept(rows) and len(kept) > 20
    assert sum(tested) < 20 * len(rows)


def test_sketches_never_part_similar_sets():
    rng = np.random.default_rng(2)
    for n in (1, 9, 40, 700):
        left = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        right = np.unique(np.r_[left[len(left) // 9:], rng.integers(0, 1 << 63, n // 9, dtype=np.uint64)])
        apart = int(np.bitwise_count(near_copies._sketch(left).view(np.uint64) ^ near_copies._sketch(right).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(left, right))


def test_rows_without_ids_and_clashing_names(spark, clash, docs, empty_docs):
    """Null and repeated ids take no other row with them, and every inner name may be a column."""
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, "alone it is"), (5, "a b c d e f"), (5, "other words here"), (7, "twice"), (7, "twice")]
    frame = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    left = near_copies.drop_near(frame)
    assert left.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, "a b c d e f"), (None, "alone it is"), (5, "other words here"), (7, "twice"), (7, "twice")], key=repr)
    assert sorted(((r.doc_id, r.text and r.text[:5]) for r in near_copies.drop_near(docs).collect()), key=repr) == sorted(
        [(1, "alpha"), (3, ""), (5, "word0"), (7, "one"), (7, "one"), (9, "Größe")], key=repr)
    assert near_copies.drop_near(empty_docs).count() == 0
