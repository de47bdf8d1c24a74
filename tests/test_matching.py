"""Matching against brute force in plain Python."""

import random
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from catalign.functions import fixed, text
from catalign.operators import joins, matching, tiles

WORDS = ["summit", "x", "850", "e-tec", "ranger", "lynx", "expert", "turbo", "sport", "renegade", "600r", "le"]


def some_texts(rng, n):
    return sorted({" ".join(rng.sample(WORDS, rng.randrange(1, 5))).title() for _ in range(n)})


def boost(a, b):
    a, b = a.lower(), b.lower()
    return min(0.2, sum(w for w, group in fixed.BOOST_WORDS for word in group if word in a and word in b))


def best(query, names, brand=None):
    pool = names
    if brand:
        pool = [n for n in names if brand.upper() in n[2].upper() or n[2].upper() in brand.upper()] or names
    found, score = None, 0.0
    for name, position, _ in sorted(pool, key=lambda n: n[1]):
        s = SequenceMatcher(None, query.lower(), name.lower()).ratio()
        s = min(1.0, s + boost(query, name)) if query else 0.0
        if s > score:
            found, score = position, s
    return found, score


def test_nearest_names_is_exact_for_any_tile_size(spark):
    rng = random.Random(1)
    names = [(t, i, rng.choice(["SKI-DOO", "LYNX", ""])) for i, t in enumerate(some_texts(rng, 60))]
    asked = [(t, rng.choice(["SKI-DOO", "LYNX", "YAMAHA", ""])) for t in some_texts(rng, 40)]
    catalog = spark.createDataFrame(names, "name string, position long, name_brand string")
    queries = spark.createDataFrame(asked, "text string, brand string")
    for tile_rows in (5, 1000):
        out = tiles.nearest_names(queries, catalog, boost=True, by_brand=True, tile_rows=tile_rows).collect()
        assert len(out) == len(asked)
        for r in out:
            position, score = best(r.text, names, r.brand)
            assert abs(r.score - score) < 1e-12 and r.position == position


def test_long_and_odd_texts_are_exact_too(spark):
    rng = random.Random(8)

    def made(n):
        return "".join(rng.choice("abcde é-") for _ in range(n)).strip() or "a"

    names = [(t, i, "") for i, t in enumerate(sorted({made(rng.choice([5, 30, 90, 250, 320])) for _ in range(50)}))]
    asked = sorted({made(rng.choice([4, 25, 60, 240])) for _ in range(30)})
    out = tiles.nearest_names(spark.createDataFrame([(t,) for t in asked], "text string"),
                              spark.createDataFrame(names, "name string, position long, name_brand string").drop("name_brand"), tile_rows=20)
    for r in out.collect():
        scores = [(SequenceMatcher(None, r.text.lower(), n.lower()).ratio(), -i) for n, i, _ in names]
        assert (r.score, -r.position) == max(scores)


def test_a_brand_without_any_name_falls_back_to_all(spark):
    catalog = spark.createDataFrame([("Summit X", 1, "SKI-DOO"), ("Ranger", 2, "LYNX")], "name string, position long, name_brand string")
    asked = spark.createDataFrame([("ranger", "ARCTIC")], "text string, brand string")
    assert tiles.nearest_names(asked, catalog, by_brand=True, tile_rows=1).first().position == 2


def test_nearest_vectors_equal_brute_force(spark):
    rng = random.Random(5)
    names = [(i, [rng.gauss(0, 1) for _ in range(4)], i % 3) for i in range(30)]
    items = [(i, [rng.gauss(0, 1) for _ in range(4)], i % 3) for i in range(25)]
    a = spark.createDataFrame(items, "id long, vector array<double>, block long")
    b = spark.createDataFrame(names, "position long, vector array<double>, block long")

    def cosine(x, y):
        return sum(p * q for p, q in zip(x, y)) / (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5

    got = {r.id: (r.position, r.similarity) for r in tiles.nearest_vectors(a, b, blocked=True, tile_rows=4).collect()}
    for i, v, block in items:
        scored = [(cosine(v, w), -p) for p, w, k in names if k == block]
        top = max(scored)
        if top[0] > 0:
            assert got[i][0] == -top[1] and abs(got[i][1] - top[0]) < 1e-9


def naive_candidates(code, brand):
    code, brand = code.upper().strip(), brand.upper()
    found = [f for b, prefixes, f in fixed.CODE_FAMILIES if b == brand and any(code.startswith(p) for p in prefixes.split("|"))]
    return sorted(set(found or ([code[:3], code[:4]] if len(code) >= 3 else [])))


def like(text_, pattern):
    import re
    shape = "".join("." if c == "_" else ".*" if c == "%" else re.escape(c) for c in pattern.upper())
    return re.search(shape, text_.upper(), re.S) is not None


def test_base_model_match_equals_a_nested_loop(spark):
    rng = random.Random(9)
    codes = ["LTTA", "RENE900", "AB", "MXZ850", "S_M850", "SU%X", "SUMM", "RAVE850", "XTRA", "abc", "FREE"]
    entries = [(i, rng.choice(codes), rng.choice(["Ski-Doo", "Lynx", "Polaris"]), rng.choice([2023, 2024])) for i in range(120)]
    models = [(f, f.replace("_", " ") + tail, b, y) for f in ["RENEGADE", "SUMMIT", "MXZ_TRAIL", "RAVE", "XTRIM", "MXZ850", "ABC", "FREERIDE"]
              for tail in ["", " X"] for b in ["Ski-Doo", "Lynx", "Polaris"] for y in [2023, 2024]]
    models = [(*m, i) for i, m in enumerate(models)]
    out = matching.match_base_models(
        spark.createDataFrame(entries, "entry_id long, model_code string, brand string, model_year int"),
        spark.createDataFrame(models, "base_model_id string, model_name string, brand string, model_year int, position long")).collect()
    assert len(out) == len(entries)
    for r in out:
        code, top = r.model_code.upper().strip(), None
        for c in naive_candidates(r.model_code, r.brand):
            for mid, name, brand, year, pos in sorted(models, key=lambda m: (m[2], m[1], m[4])):
                if year == r.model_year and like(brand, r.brand) and (like(mid, c) or like(name, c)):
                    a, b = set(code), set(mid.upper())
                    s = 0.5 * (mid == c) + 0.3 * (c in name.upper()) + 0.1 * (brand.upper() in code) + 0.1 * len(a & b) / len(a | b)
                    if s > (top[0] if top else 0.0):
                        top = (s, mid, pos)
        assert abs(r.match_confidence - (top[0] if top else 0.0)) < 1e-9
        assert r.matched_base_model_id == (top[1] if top and top[0] >= 0.7 else None)


def test_whitelist_tiers(spark):
    names = spark.createDataFrame([("BRP LYNX 69 Ranger 600R", 0), ("BRP Ski-Doo Tundra LE", 1)], "name string, position long")
    rows = spark.createDataFrame([("SKI-DOO", "Tundra LE"), ("SKI-DOO", "Summit Z"), ("SKI-DOO", "Tundra L"), ("BRP", "qqqq"), ("LYNX", None)],
                                 "brand string, malli string")
    kinds = {r.malli: r for r in matching.whitelist_match(rows, names).collect()}
    assert kinds["Tundra LE"].match_type == "exact"
    assert kinds["Summit Z"].match_type == "pattern" and kinds["Summit Z"].pattern == ".*SUMMIT.*"
    assert kinds["Tundra L"].match_type == "fuzzy" and kinds["Tundra L"].suggestion == "BRP Ski-Doo Tundra LE"
    assert kinds["qqqq"].match_type == "none" and kinds["qqqq"].suggestion is None
    assert kinds[None].match_type is None


def test_option_names_with_wildcards(spark):
    options = spark.createDataFrame([(1, "POWER_CLAW"), (2, "cobra"), (3, "a%z"), (4, "none")], "option_id long, name string").withColumn(
        "deleted_at", F.lit(None).cast("date"))
    texts = spark.createDataFrame([(1, "POWER CLAW and cobra"), (2, "cobra a-z"), (3, "")], "id long, text string").withColumn("created_at", F.current_date())
    got = {r.option_id: r.recent_usage_count for r in joins.option_usage_in_text(options, texts, ["id"], F.current_date()).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 0}


def test_known_options_remainder(spark):
    registry = spark.createDataFrame([(1, "Black edition", None, None), (2, "Ice Ripper", "LYNX", None)],
                                     "position long, name string, brand string, family string")
    rows = spark.createDataFrame([(1, "Black edition, Ice Ripper, gold", "LYNX", "Rave"), (2, "ice ripper", "BRP", "Rave"), (3, "", "LYNX", "R")],
                                 "id long, text string, brand string, family string")
    got = {r.id: r for r in joins.known_options(rows, registry, ["id"]).collect()}
    assert got[1].known == ["Black edition", "Ice Ripper"] and got[1].remainder == "gold"
    assert got[2].known == [] and got[2].remainder == "ice ripper"
    assert got[3].known is None
    fresh = {r.name for r in joins.new_registry_rows(joins.known_options(rows, registry, ["id"]), ["id"]).collect()}
    assert fresh == {"gold", "ice ripper"}


def test_child_document_of_a_chosen_parent(spark):
    parents = spark.createDataFrame([(1, "m"), (2, "n")], "id long, model string")
    models = spark.createDataFrame([("m", "Summit")], "name string, platform string")
    children = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "z")], "id long, pos int, engine string")
    row = joins.child_document(parents.filter("id = 1"), models, F.col("model") == F.col("name"), children, "id", ["pos"], "engines").collect()
    assert len(row) == 1 and row[0].platform == "Summit" and [e.engine for e in row[0].engines] == ["a", "b"]


def test_strict_mode_keeps_filler_words(spark):
    row = spark.sql("SELECT 'Expert package with WIS' AS p, '850 E-TEC turbo r' AS e").select(
        text.package_text(F.col("p")), text.package_text(F.col("p"), True), text.engine_text(F.col("e")), text.engine_text(F.col("e"), True)).first()
    assert list(row) == ["EXPERT WIS", "EXPERT PACKAGE WITH WIS", "850 ETEC TURBO R", "850 E-TEC TURBO R"]


def test_similarity_argument_and_tiles_beyond_the_broadcast(spark, monkeypatch):
    from catalign.functions import similarity
    from catalign.operators import tiles
    products = spark.createDataFrame([(1, "red fast sled", "LYNX"), (2, "blue sled", "OTHER"), (3, "nothing", "LYNX")], "id long, search_text string, brand string")
    catalog = spark.createDataFrame([(1, "red sled", "SKI-DOO"), (2, "fast sled", "LYNX"), (3, "blue sled", "LYNX")], "position long, search_text string, brand string")
    want = [(1, 2, 2 / 3), (2, 3, 1.0), (3, None, 0.0)]
    for rows, chars in ((2000, 4_000_000), (1, 4_000_000), (1, 0)):
        monkeypatch.setattr(tiles, "BROADCAST_CHARS", chars)
        monkeypatch.setattr(tiles.best_hit, "__defaults__", ("hit", rows))
        got = matching.match_texts(products, catalog, 0.5, similarity.word_similarity).orderBy("id").collect()
        assert [(r.id, r.catalog_position, round(r.score, 9)) for r in got] == [(i, p, round(s, 9)) for i, p, s in want]


def test_parts_of_a_text_are_taken_once(spark):
    from catalign.functions import similarity
    taken = spark.sparkContext.accumulator(0)

    def counted(value):
        taken.add(1)
        return value

    calls = F.udf(counted, "string").asNondeterministic()
    products = spark.range(50).select("id", F.concat(F.lit("sled "), F.col("id")).alias("search_text"), F.lit("").alias("brand"))
    catalog = spark.range(40).select(F.col("id").alias("position"), F.concat(F.lit("sled "), F.col("id")).alias("search_text"), F.lit("").alias("brand"))

    def close(left, right):
        return similarity.word_similarity(left, right)

    close.parts, close.compare = lambda c: similarity.word_parts(calls(c)), similarity.word_similarity.compare
    assert matching.match_texts(products, catalog, 0.5, close).filter("score = 1").count() == 40
    assert 90 <= taken.value <= 3 * (50 + 2 * 40)  # not 50 x 40


def test_lookup_keeps_the_smallest_model(spark):
    models = spark.createDataFrame([("A_B_2024", 7), ("A_B_2024", 3)], "lookup_key string, base_model_id long")
    entries = spark.createDataFrame([("A", "B", 2024)], "brand string, model_family string, model_year int")
    assert matching.match_by_key(entries, models).first().matched_base_model_id == 3


def test_few_texts_are_not_spread_over_more_chunks_than_tasks(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        # every chunk lays out every name once, so with many tiles few texts must stay in few chunks
        texts = spark.range(50)
        assert tiles._chunks(texts, 1) == 60 and tiles._chunks(texts, 20) == 3 and tiles._chunks(texts, 500) == 1
        assert tiles._chunks(spark.range(10 * tiles.CHUNK_ROWS), 500) == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_batched_scores_equal_the_matcher():
    rng = random.Random(4)
    for letters in ("ab", "abc ", "äöß€😀ab"):
        names = ["".join(rng.choice(letters) for _ in range(n)) for n in (0, 1, 5, 20, 60, 199) for _ in range(6)]
        own = "".join(rng.choice(letters) for _ in range(40))
        rows, extra = np.arange(len(names)), np.array([rng.choice([0, 0.05, 0.2]) for _ in names])
        got = tiles._Names(names).scores(own, rows, extra, 0.0)
        want = [min(1.0, SequenceMatcher(None, own, n).ratio() + x) for n, x in zip(names, extra)]
        assert got[1].tolist() == [want[k] for k in got[0]] and len(got[0]) == len(names)
        high = max(want)
        rows, scores = tiles._Names(names).scores(own, rows, extra, high, 3)
        assert scores.max() == high and rows[scores == high].tolist() == [k for k, x in enumerate(want) if x == high]
