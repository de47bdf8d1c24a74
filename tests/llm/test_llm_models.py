import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from catalign.llm import class_lm, decontaminate, mixing, toxicity
from catalign.llm.queries import table

FOLDER = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus():
    return duckdb.connect().execute(f"SELECT doc_id, text, source FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


# toxicity

def test_features_are_the_distinct_ngrams():
    grams = toxicity.features("ABcabc\tabc")
    padded = " abcabc abc "
    want = {padded[i:i + n] for n in toxicity.NGRAMS for i in range(len(padded) - n + 1)}
    assert len(grams) == len(want) and toxicity.features("abcabc ABC").tolist() == grams.tolist()


def test_pieces_of_long_texts_lose_nothing(monkeypatch):
    text = " ".join(f"w{i}x{i * 7}" for i in range(500))
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert toxicity.features(text).tolist() == whole.tolist()


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = toxicity.scored_documents(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").toPandas()
    rank = rows.score.rank()
    ones = (rows.toxic == 1).sum()
    area = (rank[rows.toxic == 1].sum() - ones * (ones + 1) / 2) / ones / (len(rows) - ones)
    assert area > 0.97
    assert ((rows.predicted == 1) & (rows.toxic == 1)).sum() / (rows.predicted == 1).sum() > 0.9
    assert ((rows.predicted == 1) & (rows.toxic == 1)).sum() / ones > 0.7


def test_toxicity_edges(spark, docs, empty_docs):
    one_class = spark.createDataFrame([(1, 1), (2, None), (99, 1), (None, 1)], "doc_id long, toxic int")
    scores = toxicity.scored_documents(docs, one_class).collect()
    assert len(scores) == docs.count() and len({r.score for r in scores}) == 1
    none = one_class.filter("false")
    assert toxicity.drop_toxic(docs, none).count() == docs.count() and toxicity.drop_toxic(docs, none).columns == docs.columns
    assert toxicity.scored_documents(empty_docs, one_class).count() == 0
    # held-out labels change nothing
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    texts = spark.createDataFrame([(i, "vile words here" if i % 2 else "kind words there") for i in range(200)], "doc_id long, text string")
    base = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    flipped = base.withColumn("toxic", F.when(F.col("doc_id").isin(ids), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    left, right = ({r.doc_id: r.score for r in toxicity.scored_documents(texts, lab).collect()} for lab in (base, flipped))
    assert left == right and left[1] > 0.9 and left[2] < 0.1


# class language model

def test_base_score_and_model(spark, corpus):
    got = {r.doc_id: r for r in class_lm.score(table(spark, FOLDER, "documents"), head_size=4000, clustered=600, n_classes=24).collect()}
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    tokens = {i: [*WORDS.findall(low(t)), "\0"] for i, t, _ in corpus}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count = Counter(w for i, own in tokens.items() if not out[i] for w in own)
    total, kinds = sum(count.values()), len(count)
    for i, own in tokens.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        row = got[i]
        assert abs(row.base_score - base) < 1e-6
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (out[i], len(own), sum(count[w] > 0 for w in own), total)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > sum(r.base_score for r in held) / sum(r.n_tokens for r in held) + 0.15


def test_probabilities_sum_to_one():
    head = class_lm.Head([b"a", b"b", b"c", b"zz"], np.array([5.0, 3.0, 2.0, 1.0]), 3)
    size, kinds = np.zeros(class_lm.SHAPES), np.zeros(class_lm.SHAPES)
    shape = class_lm.shape(b"zz")
    size[shape], kinds[shape] = 1, 1
    n = 2 + class_lm.SHAPES + 1
    pairs = np.zeros((n, n))
    pairs[n - 1, 0], pairs[0, 1], pairs[1, n - 1] = 3, 3, 3
    model = class_lm.Model(head, np.array([0, 0, 1]), 2, pairs, size, kinds)
    assert np.allclose((10 ** model.transition).sum(axis=1), 1)
    assert np.allclose(10 ** model.emission[:3], [5 / 8, 3 / 8, 1])
    assert np.isclose(10 ** model.emission[3] + 0.5 / 10 ** model.shape_size[shape], 1)
    ids, symbols, rare = head.read([b"b", b"zz", b"new", None])
    assert ids.tolist() == [1, 3, -1, 4] and symbols.tolist() == [1, 3 + shape, 3 + class_lm.shape(b"new"), 3 + class_lm.SHAPES] and rare == [2]


def test_exchange_gains_information(spark):
    """Two vocabularies that never mix: classes end up in one of them each, and the class bigrams tell more than at the start."""
    rng = np.random.default_rng(2)
    texts = [(" ".join(f"{k}{min(int(x), 19)}" for x in rng.exponential(5, 400)),) for k in "nv" * 20]
    words = [f"{k}{j}".encode() for j in range(20) for k in "nv"]
    head = class_lm.Head(words, np.ones(len(words)), len(words))
    pairs = class_lm.pair_counts(spark.createDataFrame(texts, "text string"), spark.sparkContext.broadcast(head), head.end)
    near = class_lm.neighbours(pairs, len(words), head.end)
    assert class_lm.class_pairs(pairs, np.zeros(len(words), np.int64), 1)[0, 0] == 399 * 40
    classes = class_lm.exchange(near, len(words), 5, 12)
    own = {k: Counter(c for w, c in zip(words, classes.tolist(), strict=True) if w[:1] == k) for k in (b"n", b"v")}
    assert not set(own[b"n"]) & set(own[b"v"])


def test_other_words_move_to_the_classes_of_their_neighbours(spark):
    rng = np.random.default_rng(4)
    texts = []
    for i, k in enumerate("nv" * 30):
        own = [f"{k}{min(int(x), 9)}" for x in rng.exponential(3, 120)]
        own[10::20] = [f"{k}rare{i // 2 % 4}"] * len(own[10::20])
        texts.append((" ".join(own) + f" once{i}x",))
    words = [f"{k}{j}".encode() for j in range(10) for k in "nv"] + [f"{k}rare{j}".encode() for k in "nv" for j in range(4)]
    head = class_lm.Head(words, np.ones(len(words)), len(words))
    pairs = class_lm.pair_counts(spark.createDataFrame(texts, "text string"), spark.sparkContext.broadcast(head), head.end)
    first = np.array([j % 2 * 2 + (j > 9) for j in range(20)])
    classes = class_lm.assign(pairs, first, np.array([class_lm.shape(w) for w in words]), 4)
    assert (classes[:20] == first).all() and {c // 2 for c in classes[20:24].tolist()} == {0} and {c // 2 for c in classes[24:].tolist()} == {1}
    assert class_lm.assign(pairs, first, np.zeros(20, np.int64), 4).tolist() == first.tolist()


def test_score_by_plain_sums(spark, corpus, monkeypatch):
    kept = []
    init = class_lm.Model.__init__
    monkeypatch.setattr(class_lm.Model, "__init__", lambda self, head, classes, *rest: kept.append((head, classes)) or init(self, head, classes, *rest))
    rows = corpus[:120]
    got = {r.doc_id: r for r in class_lm.score(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), head_size=900, clustered=60, n_classes=6).collect()}
    head, classes = kept[0]
    placed = dict(zip(head.words, classes.tolist(), strict=False))
    assert len(placed) == len(classes) > 60 and any(c < 6 for c in classes[60:]) and any(c >= 6 for c in classes[60:])
    docs = {i: [*class_lm.tokens(t), None] for i, t, _ in rows}
    kind = lambda w: "end" if w is None else placed.get(w, 6 + class_lm.shape(w))
    training = [own for i, own in docs.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for own in training for w in own)
    links = Counter(p for own in training for p in zip([kind(None), *map(kind, own)], map(kind, own)))  # noqa: B905
    size, into, out_of, types = Counter(), Counter(), Counter(), Counter(kind(w) for w in count)
    for w, c in count.items():
        size[kind(w)] += c
    for (a, b), n in links.items():
        into[b] += n
        out_of[a] += n
    whole = sum(into.values()) + 0.5 * (6 + class_lm.SHAPES + 1)
    for i, own in docs.items():
        want, last = 0.0, "end"
        for w in own:
            k = kind(w)
            want += math.log10((links[last, k] + 5 * (into[k] + 0.5) / whole) / (out_of[last] + 5))
            if k != "end":
                want += math.log10(count[w] / size[k] if k < 6 else (count[w] + 0.5) / (size[k] + 0.5 * (types[k] + 1)))
            last = k
        assert abs(got[i].score - want) < 1e-6


def test_language_model_edges(spark, docs, empty_docs):
    rows = class_lm.score(docs, head_size=50, clustered=20, n_classes=4).collect()
    assert len(rows) == docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 8)} == {1}
    twice = [r for r in rows if r.doc_id == 7]
    assert twice[0] == twice[1]
    assert class_lm.score(empty_docs).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = class_lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (only.train_tokens, only.n_known, only.held_out) == (0, 0, True) and math.isfinite(only.base_score)


# decontamination

def _index():
    rows = duckdb.connect().execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    frequency, n, total = Counter(), 0, 0
    for _, text in rows:
        own = decontaminate.words(text)
        for at in range(0, len(own), decontaminate.UNIT_WORDS):
            unit = own[at:at + decontaminate.UNIT_WORDS]
            frequency.update(set(unit))
            n, total = n + 1, total + len(unit)
    return decontaminate.Index([(i, t, None) for i, t in rows], frequency, n, total / n)


@pytest.mark.parametrize("threshold", [0.15, 0.3, 0.6])
def test_wand_and_screen_return_all(corpus, threshold):
    index = _index()
    texts = [t for _, t, _ in corpus[:150]]
    want = set()
    for k, text in enumerate(texts):
        own = decontaminate.words(text)
        for at in range(0, max(1, len(own)), decontaminate.STRIDE):
            scores = Counter()
            for term in {index.terms[w] for w in own[at:at + decontaminate.PASSAGE_WORDS] if w in index.terms}:
                for unit, impact in zip(index.units[term], index.impacts[term], strict=True):
                    scores[unit] += impact
            want |= {(k, index.items[index.unit_item[u]][0]) for u, s in scores.items() if s >= threshold - 1e-9}
    assert {(k, item) for k, item, *_ in index.leaks(texts, threshold, 0.0)} == want


def test_leaks_in_the_corpus(spark, corpus):
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table(spark, FOLDER, "documents"), table(spark, FOLDER, "benchmark")).collect()}
    norm = lambda t: " " + " ".join(w.decode() for w in decontaminate.words(t)) + " "
    assert got >= {(i, b) for i, t, _ in corpus for b, item in items if norm(item) in norm(t)}
    for i, b in got:
        text, item = norm(next(t for j, t, _ in corpus if j == i)), norm(dict(items)[b]).split()
        assert sum(f" {' '.join(item[k:k + 5])} " in text for k in range(len(item) - 4)) >= 0.7 * (len(item) - 4)


def test_leak_edges(spark, docs, empty_docs, monkeypatch):
    item = "Which river runs through the old town of the northern valley today? It is the silver Anbar river."
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "tiny item")], "item_id long, text string")
    found = spark.createDataFrame([
        (50, "before " * 100 + item.upper().replace(" ", "\n") + " after" * 100), (51, "before " * 90 + item[:60]), (52, "tiny. ITEM!"), (None, item)],
        "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(found, bench).collect()), key=repr)
    assert got == [(50, 1), (50, 1), (52, 4), (None, 1), (None, 1)]
    assert decontaminate.leaks(docs, bench).count() == 0 and decontaminate.leaks(empty_docs, bench).count() == 0
    assert decontaminate.leaks(found, bench.filter("false")).count() == 0
    left = decontaminate.drop_leaks(docs.unionByName(found.withColumn("lang", F.lit("en")), allowMissingColumns=True), bench)
    assert left.columns == docs.columns and left.count() == docs.filter("doc_id IS NOT NULL").count() + 1
    monkeypatch.setattr(decontaminate, "CHUNK_ITEMS", 1)
    assert sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(found, bench).collect()), key=repr) == got


def test_question_and_answer_must_both_occur(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten", "the answer is forty two of them")], "item_id long, text string, answer string")
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten and the answer is forty two of them"),
                                  (2, "one two three four five six seven eight nine ten and nothing")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.leaks(docs, bench, answer="answer", threshold=0.4).collect()] == [1]


# mixing

def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        unit = left / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if weight[s] * unit > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * unit for s in names}
        full |= more


def test_mix_of_the_corpus(spark, corpus):
    rows = mixing.mix_report(table(spark, FOLDER, "documents")).collect()
    sizes, source = {i: len(WORDS.findall(t or "")) for i, t, _ in corpus}, {i: s for i, _, s in corpus}
    by_source = Counter()
    for i, n in sizes.items():
        by_source[source[i]] += n
    want, taken = _targets(dict(by_source)), Counter()
    assert len(rows) == len(corpus)
    for r in rows:
        assert r["size"] == sizes[r.doc_id] and r.source_size == by_source[source[r.doc_id]] and r.taken in {k * r["size"] for k in range(4)}
        assert math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9)
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] / want[s] - 1) < 0.01 for s in want)
    again = mixing.mix_report(table(spark, FOLDER, "documents").repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_targets_stop_at_the_cap(spark, docs, empty_docs):
    text = lambda n: " ".join(["w"] * n)
    rows = [(1, text(1000), "a"), (2, text(3), "b"), (3, text(4), "b"), (4, text(30), "c"), (5, "", "d"), (6, None, None), (7, text(2), None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_report(frame).collect()
    want = _targets({"a": 1000, "b": 7, "c": 30, "d": 0, None: 2})
    assert {r.doc_id: round(r.target, 6) for r in got} == {i: round(want[s], 6) for i, _, s in rows}
    assert all(r.taken <= 3 * r["size"] for r in got) and sum(r.taken for r in got if r.doc_id in (2, 3)) == 21
    assert mixing.mix_report(empty_docs).count() == 0 and mixing.mixed(empty_docs).count() == 0
    mix = mixing.mixed(docs)
    assert mix.columns == [*docs.columns, "copy"]
    report = Counter()
    for r in mixing.mix_report(docs).collect():
        report[r.doc_id] += r["copies"]
    assert Counter(r.doc_id for r in mix.collect()) == +report


def test_newton_reaches_the_targets(spark):
    sources = spark.createDataFrame([("a", 100, 250.0, 1), ("b", 100, 3.0, 1), ("c", 100, 300.0, 1), ("d", 0, 0.0, 1), ("e", 10**12, 10.0, 1)],
                                    "source string, source_size long, target double, n_docs long")
    got = {r.source: r.multiplier for r in mixing.multipliers(sources).collect()}
    for name, size, target in (("a", 100, 250.0), ("b", 100, 3.0), ("c", 100, 300.0), ("e", 10**12, 10.0)):
        assert math.isclose(got[name], math.log(target / size), abs_tol=1e-8)
