import html
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from catalign.llm import decontaminate, extract_html, queries, toxicity
from catalign.llm.extract_html import main_text

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def _article(page):
    """What stands in the article element, with every tag that is no bold mark as a break."""
    body = page[page.index("<article>") + 9:page.index("</article>")]
    return " ".join(html.unescape(re.sub(r"<(?:br|/?p|/?h1)>", "\n", re.sub(r"</?b>", "", body))).split())


def test_given_pages():
    for folder in ("sf0.001", "sf0.01", "sf0.1"):
        for (page,) in duckdb.connect().execute(f"SELECT html FROM '/root/testdata/{folder}/pages.parquet'").fetchall():
            assert main_text(page) == _article(page)


def test_other_forms():
    para = "Some words, with commas, that make a paragraph of fair length for scoring, indeed. "
    page = (f"<html><body><div class='header'><h1>Site</h1></div><div id=menu><a href=/>Home</a></div><div class='cookie-notice'><p>{para}</p></div>"
            f"<div id=content><h2>Title &amp; more</h2><p>{para}<p>{para}<br>two&nbsp;words<div class='ad-box'>Buy</div><ul><li>one<li>two</ul><script>var a='<p>'</script>"
            f"<!-- <p>gone</p> --></div><aside>{para * 5}</aside><div class=comments><p>{para * 9}</p></div><form><p>{para}</p></form><footer>{para}</footer></body></html>")
    clean = para.strip()
    assert main_text(page) == f"Title & more {clean} {clean} two words one two"
    assert main_text("") == main_text(None) == "" and main_text("just &lt;text&gt;") == "just <text>"
    assert main_text("<div><a href=x>only</a> <a href=y>links</a></div><p>Real text here, it is.</p>").endswith("Real text here, it is.")
    assert main_text("<article>x<nav><p>menu</article><footer>f") == "x"
    assert main_text("<p>a<b>b</b>c</p><style>p{}") == "abc"
    assert main_text("<article><div class='entry-header'><h1>T</h1></div><p>body</p></article>") == "T body"
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    assert main_text(deep) == "deep text"


PARA = "Words of the article, with commas, that go on for a while so that they score as a paragraph does, indeed they do."
LAYOUTS = {
    "section of the article named discussion": f"<article><p>{PARA}</p><section class=discussion><p>{PARA}</p></section></article>",
    "section of the article named legal": f"<main><p>{PARA}</p><div id=legal><p>{PARA}</p></div></main>",
    "meta and tags with words": f"<article><div class=meta><p>{PARA}</p></div><div class=tags><p>{PARA}</p></div></article>",
    "marks inside other attributes": f"<div><p title='hidden gems'>{PARA}</p><p data-hidden=false data-id=comments>{PARA}</p></div>",
    "heading in a header of main": f"<header>Site</header><main><header><h1>{PARA}</h1></header><p>{PARA}</p></main>",
    "wrappers one level deeper": f"<div class=c><div><div><p>{PARA}</p><p>, , , {PARA}</p></div></div><div><div><p>{PARA}</p></div></div><div><div><p>{PARA}</p></div></div></div>",
    "layout flags": f"<div class='page has-sidebar with-header'><div><p>{PARA}</p><p>{PARA}</p></div></div>",
    "reader comments go": f"<div><p>{PARA}</p><p>{PARA}</p></div><div class=reader-comments><p>Gone {PARA}</p></div><p class=user-comment>Gone</p>",
    "menus go": f"<ul class=main-menu><li>Gone</ul><article><p>{PARA}</p><p>{PARA}</p></article><div class=bottom-nav>Gone</div>",
    "tags with links go": f"<article><p>{PARA}</p><p>{PARA}</p><div class=tags><a href=a>Gone one</a> <a href=b>Gone two</a></div></article>",
    "adverts in the article go": f"<article><p>{PARA}</p><div class=ad>Gone</div><div class='ad-box'>Gone</div><p>{PARA}</p></article>",
    "a table layout": f"<table><tr><td class=sidebar>Gone</td><td><p>{PARA}</p><p>{PARA}</p></td></tr></table>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page = LAYOUTS[name]
    text = main_text(f"<html><body>{page}<footer>Gone</footer></body></html>")
    assert text.count(PARA) == page.count(PARA) - page.count("Gone " + PARA) and "Gone" not in text and "Site" not in text


def test_extract_rows(spark, clash):
    long = "<article>" + "<p>word word, word</p>" * 50_000 + "</article>"
    rows = [(1, "u", "<p>é&amp;</p>"), (1, "u", "<p>é&amp;</p>"), (None, None, None), (2, "v", long)]
    got = extract_html.extract(clash(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(((r.page_id, r.text[:9], r.n_chars) for r in got.collect()), key=repr) == sorted(
        [(1, "é&", 2), (1, "é&", 2), (None, "", 0), (2, "word word", 50_000 * 16 - 1)], key=repr)
    assert extract_html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_exact_stage_against_brute_force(spark):
    docs = queries.table(spark, FOLDER, "documents")
    best = {}
    for r in docs.collect():
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    exact = STAGES["exact_dedup"](spark, docs, FOLDER)
    assert exact.columns == docs.columns and sorted(r.doc_id for r in exact.collect()) == sorted(best.values())


def test_near_stage_against_brute_force(spark):
    """One document of each component of five-word shingle sets at 0.8 or more stays."""
    docs = queries.table(spark, FOLDER, "documents")
    rows = docs.collect()
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for r in rows for w in [(r.text or "").encode().lower().split()]]
    near = np.array([[5 * len(a & b) >= 4 * len(a | b) for a in sets] for b in sets])
    label = np.array([r.doc_id for r in rows])
    while True:
        low = np.array([label[n].min() for n in near])
        if (low == label).all():
            break
        label = low
    kept = STAGES["simhash_dedup"](spark, docs, FOLDER)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(label.tolist()))


def test_leak_stage_against_brute_force(spark, clash):
    docs = queries.table(spark, FOLDER, "documents")
    items = [" ".join(w.decode() for w in decontaminate.words(t)) for (t,) in duckdb.connect().execute(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()]
    clean = {r.doc_id for r in STAGES["decontamination"](spark, docs, FOLDER).collect()}
    for r in docs.collect():
        body = f" {' '.join(w.decode() for w in decontaminate.words(r['text']))} "
        shared = max((sum(f" {' '.join(i.split()[k:k + 5])} " in body for k in range(len(i.split()) - 4)) / (len(i.split()) - 4) for i in items))
        if any(f" {i} " in body for i in items):
            assert r["doc_id"] not in clean
        elif shared < 0.7:
            assert r["doc_id"] in clean
    item = duckdb.connect().execute(f"SELECT text FROM '{FOLDER}/benchmark.parquet' LIMIT 1").fetchone()[0]
    rows = clash(spark.createDataFrame([(1, item), (None, item), (None, "clean it is"), (5, item), (5, "other text")], "doc_id long, text string"))
    left = STAGES["decontamination"](spark, rows, FOLDER)
    assert left.columns == rows.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == [(5, "other text"), (None, "clean it is")]


def _gram_features(text):
    """Hashed character n-grams, one by one."""
    padded = "".join(" " if ord(c) <= 32 or ord(c) == 160 else c for c in f" {(text or '').lower()} ")
    out = set()
    for n in toxicity.NGRAMS:
        for i in range(len(padded) - n + 1):
            value = 0
            for c in padded[i:i + n]:
                value = (value * 0x9E3779B97F4A7C15 + ord(c)) % (1 << 64)
            out.add((value ^ value >> 29) * 0xC2B2AE3D27D4EB4F % (1 << 64) >> 64 - toxicity.HASH_BITS)
    return out


def _brute_scores(rows, labels):
    """Scores of all rows by counts in dictionaries and Newton steps on a dense matrix."""
    grams = {i: _gram_features(t) for i, t in rows}
    train = [(grams[i], y) for i, y in labels.items() if i in grams]
    p, q = sum(y for _, y in train), sum(1 - y for _, y in train)
    counts = [Counter(), Counter()]
    for g, y in train:
        counts[y].update(g)
    strength = {}
    for f in set(counts[0]) | set(counts[1]):
        pooled = (counts[0][f] + counts[1][f]) / (p + q)
        strength[f] = abs(counts[1][f] / p - counts[0][f] / q) / np.sqrt(pooled * (1 - pooled) * (1 / p + 1 / q) + 1e-12)
    kept = sorted((f for f, z in strength.items() if z >= toxicity.MIN_Z), key=lambda f: (-strength[f], f))[:toxicity.MAX_FEATURES]
    ratio = np.array([np.log((counts[1][f] + .5) / (p + 1)) - np.log((counts[0][f] + .5) / (q + 1)) for f in kept])
    matrix = lambda sets: np.array([[f in g for f in kept] for g in sets]) * ratio
    x, y, w = np.c_[matrix([g for g, _ in train]), np.ones(len(train))], np.array([y for _, y in train]), np.zeros(len(kept) + 1)
    ridge = np.diag(np.r_[np.full(len(kept), toxicity.PENALTY), 0])
    for _ in range(40):
        s = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (s * (1 - s))[:, None]) + ridge, x.T @ (s - y) + ridge @ w)
    margin = np.c_[matrix([grams[i] for i, _ in rows]), np.ones(len(rows))] @ w
    return dict(zip([i for i, _ in rows], 1 / (1 + np.exp(-margin)), strict=True))


def test_toxicity_against_brute_force(spark):
    """The stage and op3 give the scores of a plain computation, up to the tolerance of the fit."""
    docs, labels = queries.table(spark, FOLDER, "documents"), queries.table(spark, FOLDER, "labels")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    known = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    want = _brute_scores(rows, known)
    kept = {r.doc_id for r in STAGES["toxicity"](spark, docs, FOLDER).collect()}
    assert all((i in kept) == (s < toxicity.THRESHOLD) for i, s in want.items() if abs(s - toxicity.THRESHOLD) > 0.01)
    want = _brute_scores(rows, {i: y for i, y in known.items() if zlib.crc32(str(i).encode()) % 3 != 1})
    for r in queries.QUERIES["op3_toxicity"](spark, FOLDER).collect():
        assert abs(r.score - want[r.doc_id]) < 0.01


def test_mix_stage_against_brute_force(spark, clash):
    """Words taken of each source against targets by plain water filling; a document is taken whole, up to three times."""
    docs = queries.table(spark, FOLDER, "documents")
    size, source = {}, {}
    for r in docs.collect():
        size[r.doc_id] = len([w for w in re.split("[ \t\n\v\f\r]+", r.text or "") if w])
        source[r.doc_id] = r.source
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    full = {}
    while True:
        unit = (sum(total.values()) - sum(full.values())) / max(sum(weight[s] for s in names if s not in full), 1)
        more = {s: 3 * total[s] for s in names if s not in full and weight[s] * unit > 3 * total[s]}
        if not more:
            break
        full |= more
    target = {s: full.get(s, weight[s] * unit) for s in names}
    taken, copies = Counter(), Counter()
    for r in STAGES["source_mix"](spark, docs, FOLDER).collect():
        taken[r.source] += size[r.doc_id]
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    longest = Counter()
    for i, n in size.items():
        longest[source[i]] = max(longest[source[i]], n)
    for s in names:
        assert abs(taken[s] - target[s]) <= max(0.01 * target[s], longest[s] / 2), s
    frame = clash(docs.limit(50))
    assert [c for c in STAGES["source_mix"](spark, frame, FOLDER).columns if c != "copy"] == frame.columns


def test_run_keeps_rows_whole(spark):
    source = {r.doc_id: r for r in queries.table(spark, FOLDER, "documents").collect()}
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    rows = out.collect()
    assert all(source[r.doc_id].text == r.text for r in rows)
    copies = Counter(r.doc_id for r in rows)
    assert all(sorted(r.copy for r in rows if r.doc_id == i) == list(range(1, n + 1)) for i, n in copies.items()) and max(copies.values()) <= 3


def test_every_stage_takes_no_rows(spark, empty_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty_docs, FOLDER)
        assert out.count() == 0 and out.columns[:5] == empty_docs.columns, name


def test_native_operator_and_registry():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "source_mix"]
