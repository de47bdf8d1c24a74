"""Stage arithmetic checked by hand, and rule engines."""

import random

from pyspark.sql import functions as F

from catalign.functions import fixed, jsons, maps, prices, text
from catalign.operators import rules
from catalign.plans import specbook, stages


def model(spark, **specs):
    base = maps.literal_map(specs)
    return spark.createDataFrame([("RENEGADE", "RENEGADE", "Ski-Doo", 2024, 1)],
                                 "base_model_id string, model_name string, brand string, model_year int, position long").withColumns(
        {"base_specs": base, "inheritance_base": F.lit(0.9)})


def entry(spark, code, price, year=2024, brand="Ski-Doo"):
    return spark.createDataFrame([(1, code, brand, year, float(price))], "entry_id long, model_code string, brand string, model_year int, price double")


def test_renegade_through_all_stages(spark):
    out = stages.reconcile(entry(spark, "RENEGADE900ACETURBO", 20001), model(spark, displacement="600cc", engine_type="2-stroke")).first()
    assert out.matched_base_model_id == "RENEGADE" and 0.8 <= out.match_confidence < 0.9
    inherited = out.inherited_specs
    assert inherited["suspension"] == "tMotion" and inherited["warranty"] == "3_year_extended" and inherited["reverse"] == "electric"
    assert abs(out.inheritance_confidence - 0.95) < 1e-9
    custom = out.customizations
    assert custom["displacement"] == "900cc" and custom["displacement_original"] == "600cc" and custom["displacement_customized"] == "true"
    assert custom["forced_induction"] == "turbocharged" and custom["target_use"] == "versatile"
    assert [o.description for o in out.spring_options] == ["Luxury comfort features"]
    assert out.success and out.confidence_level in ("medium", "high")
    weights = [0.3, 0.2, 0.2, 0.1, 0.2]
    assert abs(out.overall_confidence - sum(w * r.confidence for w, r in zip(weights, out.stage_results))) < 1e-9


def test_short_code_fails_and_stays(spark):
    out = stages.reconcile(entry(spark, "AB", 9000), model(spark)).first()
    assert out.match_reason == "No base model candidates extracted from code"
    assert not out.success and out.failed_stage == "base_model_matching" and out.overall_confidence is None


def test_old_years_lose_connectivity(spark):
    specs = stages.year_updates(maps.literal_map({"connectivity": "gps", "display": "lcd"}), F.lit(2020))
    assert spark.range(1).select(specs).first()[0] == {"display": "analog_gauge"}


def test_options_keep_the_best_of_equal_descriptions(spark):
    made = F.array(stages.option("t", "Cobra", 0.5, "a"), stages.option("s", "Fox", 0.9, "b"), stages.option("t", "COBRA", 0.7, "c"),
                   stages.option("u", "X", 0.7, "d"))
    out = spark.range(1).select(stages.rank_options(made)).first()[0]
    assert [(o.description, o.method) for o in out] == [("Fox", "b"), ("COBRA", "c"), ("X", "d")]


def test_listing_row(spark):
    fields = {"Id": "MXZ-X-600R-2025", "Price": "2500000", "Year": "2025", "Power": "165", "EngineCapacity": "849", "PersonCapacity": "2",
              "TrackWidth": "406", "Model": "Summit X", "Images": "https://x/a.jpg", "Unknown": "?"}
    df = spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} string" for k in fields)).withColumns(
        {"listing_id": F.lit(1), "listed": F.lit(True), "similar": F.lit(None).cast("string")})
    done = rules.listing_summary(rules.check_listings(df, list(fields), 2026)).first()
    assert done.is_valid and done.total_checks == 9 and done.summary == "VALIDATION PASSED: 9/9 checks passed"
    bad = df.withColumns({"Price": F.lit("2,500,000"), "Year": F.lit("25"), "Power": F.lit("165 hp"), "PersonCapacity": F.lit("4"),
                          "Images": F.lit("ftp://x"), "listed": F.lit(False), "similar": F.lit("Summit X 850")})
    rows = {r.field: r for r in rules.check_rows(rules.check_listings(bad, list(fields), 2026)).collect()}
    assert {f for f, r in rows.items() if not r.valid} == {"Price", "Year", "Power", "PersonCapacity", "Images", "Model"}
    assert rows["Model"].fix == "Did you mean: Summit X 850?" and rows["Power"].fix == "Use format: 165 (not 165 hp)"


def test_strict_and_lenient_layers(spark):
    df = spark.createDataFrame([(1,)], "x int")
    layers = [([], True), ([rules.error("late", F.col("x") == 1, "bad")], False)]
    assert not rules.layered(df, layers, strict=True).first().success
    lenient = rules.layered(df, layers, strict=False).first()
    assert lenient.success and lenient.confidence == 0.0 and lenient.errors == ["bad"]


def test_price_parsers(spark):
    texts = ["22 310,00 €", "22 310,00 €", "12.345,50", "25110", "", "N/A"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(prices.price_digits(F.col("t")), prices.price_number(F.col("t")), prices.price_number(F.col("t"), "fi")).collect()
    assert [r[0] for r in got] == [22310.0, 22310.0, 0.0, 25110.0, 0.0, 0.0]
    assert [r[1] for r in got] == [22310.0, 22310.0, None, 25110.0, None, None]
    assert [r[2] for r in got] == [22310.0, 22310.0, 12345.5, 25110.0, None, None]


PAGE = ("S U M M I T   X\nwhat's new\n• New bodywork\nFEATURES\n• LED\n• led!\noverall length 3040 mm\noverall length 3050 mm\n"
        "dry weight 240 kg\n850 E-TEC® TURBO R\nliquid-cooled two-stroke\n82.0 x 80.4 mm\n800 - 849.7 cc\nfuel tank 36 L\nRotax")


def test_specification_page(spark):
    pages = spark.createDataFrame([("book", 9, PAGE, "SKI-DOO", 2026), ("book", 10, "no model here", "SKI-DOO", 2026)],
                                  "doc string, page int, text string, brand string, model_year int")
    rows = specbook.extract_pages(pages).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.sku == "SKI-DOO-SUMMIT-X-2026" and r.category == "deep-snow"
    assert [e.name for e in r.specifications.engines] == ["850 E-TEC TURBO R", "850 E-TEC"]
    assert r.specifications.engines[0].turbo and r.specifications.engines[0].displacement == 849
    assert r.specifications.engines[0].bore_stroke == "82.0 x 80.4 mm" and r.specifications.engines[0].type == "2-stroke"
    assert r.specifications.dimensions.overall.length_mm == 3050 and r.min_dry_weight_kg == 240
    assert r.whats_new == ["New bodywork"] and r.feature_list == ["LED"] and r.has_turbo and r.engine_count == 2


def test_spaced_title_with_lookahead(spark):
    df = spark.createDataFrame([("S U M M I T X with expert package",), ("SUMMIT X expert kit",), ("Adventure LX",), ("Adventure 900",)], "t string")
    got = [r[0] for r in df.select(text.page_title(F.col("t"))["configuration"]).collect()]
    assert got == ["Expert Package", None, "Base", "Base"]


def test_flat_specification_has_all_columns(spark):
    assert len(jsons.spec_paths()) == 57
    df = spark.createDataFrame([('{"basicInfo":{"brand":"LYNX"},"engines":[{"name":"600"}],"colors":[]}',)], "j string")
    r = df.select(*jsons.flatten_spec(F.col("j"))).first()
    assert r.basic_info_brand == "LYNX" and r.engines == '[{"name":"600"}]' and r.colors is None and r.full_llm_json.startswith("{")


def test_broken_responses_give_nothing(spark):
    texts = ['[{"a":"1"}]', '```json\n[{"a":"1"},{"a":"2"}]\n```', '{"articles":[{"a":"1"}]}', 'text [{"a":"1"}] text', '[{"a":', 'none']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(F.size(jsons.response_items(F.col("t")))).collect()] == [1, 2, 1, 1, 0, 0]


def test_scores_below_use_go_to_the_suggestion_or_fail(spark):
    """0.5 for the equal id, 0.1 for the brand in the code, 0.1 for equal letters: 0.7 is no structured match."""
    models = spark.createDataFrame([("LTTA", "Nordic", "LT", 2024, 1), ("OTHER", "Other", "LT", 2024, 2)],
                                   "base_model_id string, model_name string, brand string, model_year int, position long").withColumns(
        {"base_specs": F.when(F.col("base_model_id") == "OTHER", maps.literal_map({"track_type": "trail"})).otherwise(maps.literal_map({"track_type": "sport"})),
         "inheritance_base": F.lit(0.9)})
    rows = entry(spark, "LTTA", 12000, brand="LT")
    alone = stages.reconcile(rows, models).first()
    assert (alone.matching_method, alone.matched_base_model_id, alone.match_confidence, alone.failed_stage) == ("failed", None, 0.0, "base_model_matching")
    assert alone.match_reason == "Best match confidence 0.70 below threshold 0.8"
    suggested = spark.createDataFrame([(1, "other", 0.9), (2, "LTTA", 1.0)], "entry_id long, suggested_id string, suggested_confidence double")
    helped = stages.reconcile(rows, models, suggestions=suggested).first()
    assert (helped.matching_method, helped.matched_base_model_id, helped.match_confidence) == ("semantic", "OTHER", 0.9)
    assert helped.inherited_specs["track_type"] == "trail" and helped.failed_stage is None
    wrong = spark.createDataFrame([(1, "nowhere", 0.9)], "entry_id long, suggested_id string, suggested_confidence double")
    assert stages.reconcile(rows, models, suggestions=wrong).first().matching_method == "failed"


def test_stage_hooks(spark):
    rows = spark.createDataFrame([(1, "x"), (None, "x")], "a int, b string")
    out = stages.run_stages(rows, [
        ("one", lambda df: df, ["a", "b"], {"success": True, "confidence": True}),
        ("two", lambda df: df, [], {"confidence": F.lit(7.0)}),
        ("three", lambda df: df, [], {"confidence": True})]).orderBy("a").collect()
    assert [(r.one_success, r.one_confidence, r.two_confidence, r.three_confidence) for r in out] == [(False, 0.0, 1.0, 0.8), (True, 1.0, 1.0, 0.8)]


def test_long_numbers_are_above_the_limit(spark):
    values = ["99999999999999999999", "2500000", "00000000000000000002500000", "000", "9" * 400, "25e5", ""]
    rows = spark.createDataFrame([(v,) * 5 for v in values], "Price string, Power string, EngineCapacity string, PersonCapacity string, TrackWidth string")
    checks = rules.check_listings(rows, ["Price", "Power", "EngineCapacity", "PersonCapacity", "TrackWidth"], 2026).collect()
    price = [next(c.outcome.error for c in r.checks if c.field == "Price") for r in checks]
    high, low = "Price seems too high for a snowmobile (maximum 5,000,000 rubles)", "Price seems too low for a snowmobile (minimum 100,000 rubles)"
    assert price == [high, None, None, low, high, "Price must contain only numbers (no currency symbols, commas, or spaces)", "Price is required"]
    for r in (checks[0], checks[4]):
        assert not any(c.outcome.valid for c in r.checks)


def test_date_fields_by_the_feeds_own_names(spark):
    rows = spark.createDataFrame([("junk", "2025-01-01")], "ShopDateBegin string, ShopDateEnd string")
    checks = rules.check_listings(rows, ["ShopDateBegin", "ShopDateEnd"], 2026, "ShopDateBegin", "ShopDateEnd").first().checks
    assert [(c.field, c.outcome.valid) for c in checks] == [("ShopDateBegin", False), ("ShopDateEnd", True)]


def test_tracks_of_long_texts(spark):
    words = "snow " * 20_000
    pages = spark.createDataFrame([(1, words), (2, words + "Cobra 137x 15 x 1.6mm next Ripper: 154 x16x 3.0"), (3, "1 " * 20_000 + "x 2"), (4, None)], "page long, text string")
    made = {r.page: r.t for r in pages.select("page", specbook.track_options(F.col("text")).alias("t")).collect()}
    assert made[1] == [] and made[3] == [] and made[4] is None
    # the longest name that leaves a size behind it wins, so the last size of a run of words and all but its last digit
    assert [(t.name == (words + "Cobra 13").strip(), t.length_inch, t.width_inch) for t in made[2]] == [(True, 7, 15), (False, 154, 16)]


def test_track_scan_is_the_track_line(spark):
    draw = random.Random(5)
    texts = [("".join(draw.choice(["x", "x", " ", " ", "1", "2", "ä", "b", ":", ".", "\n", ">", " 1x2x3", "4 x 5 x 6.7", "\u00a0"]) for _ in range(draw.randint(1, 40))),)
             for _ in range(20_000)]
    found = spark.createDataFrame(texts, "text string").select("text", *[
        F.regexp_extract_all("text", F.lit(p), F.lit(i)).alias(f"{n}{i}") for n, p in (("line", "(?U)" + fixed.TRACK_LINE), ("scan", fixed.TRACK_SCAN))
        for i in range(1, 5)])
    same = [F.col(f"line{i}") == F.col(f"scan{i}") for i in range(1, 5)]
    assert found.filter(~(same[0] & same[1] & same[2] & same[3])).count() == 0
    assert found.filter(F.size("line1") > 1).count() > 100


def test_specification_of_long_pages(spark):
    long = spark.createDataFrame([(1, "SUMMIT X\n850 E-TEC\n" + "snow " * 20_000), (2, "SUMMIT X\n850 E-TEC\n" + "snow " * 20_000 + "154 x 16 x 3.0")], "page long, text string")
    made = specbook.extract_pages(long.withColumns({"doc": F.lit("d"), "brand": F.lit("LYNX"), "model_year": F.lit(2026)})).collect()
    assert sorted((r.source_page, len(r.specifications.tracks)) for r in made) == [(1, 0), (2, 1)]


def test_numbers_that_no_int_holds_are_null_in_specifications(spark):
    body = "\n".join(["S U M M I T   X   N E O", "Rotax cylinders", "displacement 1 - 99999999999.5 cc", "fuel tank 99999999999 L", "dry weight 240 kg",
                      "PowderMax: 99999999999 x 16 x 3.0", "PowderMax: 154 x 16 x 3.0"])
    pages = spark.createDataFrame([(1, "a.pdf", "LYNX", 2026, body)], "page long, doc string, brand string, model_year int, text string")
    got = specbook.extract_pages(pages).select("specifications.*").first()
    assert got.dimensions.dry_weight_kg == 240 and [t.length_inch for t in got.tracks] == [None, 154]
    assert [(e.displacement, e.fuel_tank_l) for e in got.engines] == [(None, None)]
