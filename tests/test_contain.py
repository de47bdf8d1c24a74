"""Containment by anchors against plain loops."""

import random

import pytest

from catalign.operators import contain, joins, matching


def _words(seed, n, longest):
    rnd = random.Random(seed)
    return ["".join(rnd.choices("abcé 😀", k=rnd.randrange(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("key", ["text", "id"])
def test_contained_equals_a_nested_loop(spark, key):
    texts, names = sorted(set(_words(1, 120, 40))), _words(2, 150, 9) + ["", None, "a" * 30, "aaaa"]
    frame = spark.createDataFrame([*enumerate([*texts, "a" * 40]), (9999, None)], "id long, text string")
    named = spark.createDataFrame([(n,) for n in names], "n string")
    got = {tuple(r) for r in contain.contained(frame, [key], "text", named, "n").collect()}
    of = dict(enumerate([*texts, "a" * 40]))
    assert got == {(i if key == "id" else t, n) for i, t in of.items() for n in names if n is not None and n in t}


def test_anchor_is_the_rarest_part(spark):
    names = spark.createDataFrame([("abcdX",), ("abcdY",), ("abcd",), ("ab",)], "n string")
    assert {tuple(r) for r in contain.anchors(names, "n").collect()} == {("abcdX", "bcdX"), ("abcdY", "bcdY"), ("abcd", "abcd"), ("ab", "ab")}


def test_no_anchors_no_pairs(spark):
    none = spark.createDataFrame([], "n string")
    texts = spark.createDataFrame([("a",), (None,)], "text string")
    assert contain.contained(texts, ["text"], "text", none, "n").count() == 0
    assert contain.contained(none.toDF("text"), ["text"], "text", texts.toDF("n"), "n").count() == 0


def test_patterns_by_their_longest_run(spark):
    options = spark.createDataFrame([(1, "h_at", None), (2, "%", None), (3, "seat%lock", None), (4, "gone", "2025-01-01"), (5, "__", None), (6, None, None)],
                                    "option_id long, name string, deleted_at string")
    texts = spark.createDataFrame([(1, "a heat seat with lock"), (2, "x"), (3, "lock the seat"), (4, "gone hot")], "doc long, text string")
    from pyspark.sql import functions as F
    texts = texts.withColumn("created_at", F.lit("2025-02-20").cast("date"))
    out = joins.option_usage_in_text(options, texts, ["doc"], F.lit("2025-03-01").cast("date"))
    assert {r.option_id: r.recent_usage_count for r in out.collect()} == {1: 1, 2: 4, 3: 1, 5: 3, 6: 0}


def test_known_options_of_entries_without_brand(spark):
    entries = spark.createDataFrame([(1, " Standard seat ", None, "F"), (2, "Standard seat", None, "F"), (3, "Expert seat", "A", None), (4, None, "A", "F"), (5, "nothing", "A", "F")],
                                    "k long, text string, brand string, family string")
    registry = spark.createDataFrame([(1, "seat", None, None), (2, "standard", None, "F"), (3, "expert", "A", None), (4, "expert", "B", None)],
                                     "position long, name string, brand string, family string")
    got = {r.k: (r.known, r.remainder) for r in joins.known_options(entries, registry, ["k"]).collect()}
    assert got == {1: (["seat", "standard"], ""), 2: (["seat", "standard"], ""), 3: (["seat", "expert"], ""), 4: (None, None), 5: ([], "nothing")}


def test_first_family_by_position_and_suggestions(spark):
    products = spark.createDataFrame([(1, "Summit X"), (2, "SUM"), (3, "Ranger"), (4, ""), (5, None), (6, "rang")], "id long, malli string")
    catalog = spark.createDataFrame([("Ranger", 7), ("summit", 3), ("X", 1), ("summit", 9), ("Summit X 850", 2)], "model_family string, position long")
    got = {r.id: (r.model_family, r.catalog_position) for r in matching.first_containing(products, catalog).collect()}
    assert got == {1: ("X", 1), 2: ("Summit X 850", 2), 3: ("Ranger", 7), 4: (None, None), 5: (None, None), 6: ("Ranger", 7)}
    names = spark.createDataFrame([("Ranger RE", 2), ("Ranger", 5), ("Lynx", 1)], "name string, position long")
    found = {r.id: (r.listed, r.similar) for r in matching.suggest_models(products, names, "malli").collect()}
    assert found[3] == (True, None) and found[6] == (False, "Ranger RE") and found[1] == (False, None) and found[5] == (False, None)
