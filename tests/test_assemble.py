"""Price-list tables and continuation rows."""

import random

import pytest

from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.operators import assemble
from catalign.plans import feed

HEADER = ["", "", "Malli", "Paketti", "Moottori", "Telamatto", "", "Käynnistin", "Mittaristo", "Kevätoptiot", "Väri", ""]
SHEET = [
    ["", "", "S U O S I T U S", "", "", "", "", "", "", "", "", ""],
    ["", "Tuote-", "", "", "", "", "", "", "", "", "", "Suositushinta,"],
    HEADER,
    ["", "nro", "", "", "", "", "", "", "", "", "", "sis ALV:n"],
    ["", "Deep Snow", "", "", "", "", "", "", "", "", "", ""],
    ["", "", "", "", "", "146in", "", "", "", "", "", ""],
    ["", "VBTA", "Freeride", "Standard", "850 E-TEC", "2.5in 64mm PowderMax", "", "SHOT", "4.5 in. Digital Display", "", "Scandi Blue", "22 310,00 €"],
    ["", "", "", "", "", "3700mm", "", "", "", "", "", ""],
    ["", "VBTB", "Freeride", "Standard", "850 E-TEC", "", "", "SHOT", "", "", "Scandi Blue", "23 560,00 €"],
    ["", "", "Freeride", "", "", "154in", "", "", "", "opt", "", ""],
]


def sheet(spark):
    rows = [("list", 1, 1, i, cells) for i, cells in enumerate(SHEET)]
    return spark.createDataFrame(rows, "doc string, table_no int, page long, row_no long, cells array<string>")


def test_raw_records_of_a_sheet(spark):
    out = {r.row_no: r for r in assemble.raw_records(sheet(spark)).collect()}
    assert 2 not in out and 3 not in out
    assert out[4].model_code == "Deep Snow" and out[5].telamatto == "146in"
    assert out[6].vari == "Scandi Blue" and out[6].price_value == 22310.0
    assert out[6].normalized_malli == "freeride" and out[6].normalized_mittaristo == "4 5 in  digital display"


def test_merged_products_of_a_sheet(spark):
    rows = assemble.raw_records(sheet(spark))
    out = {r.model_code: r for r in assemble.merge_continuations(rows, keep=["price_value"]).collect()}
    assert set(out) == {"VBTA", "VBTB"}
    assert out["VBTA"].telamatto == "2.5in 64mm PowderMax 3700mm" and out["VBTA"].price_value == 22310.0
    assert out["VBTB"].telamatto == "154in" and out["VBTB"].malli == "Freeride" and out["VBTB"].kevatoptiot == "opt"


def naive_merge(rows):
    products, current = [], None
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        code = (r[3] or "").strip()
        if len(code) == 4:
            current = {"code": code, "malli": (r[4] or "").strip(), "vari": (r[5] or "").strip()}
            products.append(current)
        elif current and ((code and code not in fixed.CATEGORY_ROWS) or r[4] or r[5]):
            for field, new in (("malli", r[4]), ("vari", r[5])):
                new = (new or "").strip()
                if new and current[field] and current[field] != new:
                    current[field] += " " + new
                elif new and not current[field]:
                    current[field] = new
    return [(p["code"], p["malli"], p["vari"]) for p in products]


def test_merge_equals_a_loop_in_any_input_order(spark):
    rng = random.Random(11)
    rows = [("d", p, i, rng.choice(["ABCD", "EFGH", "", "Deep Snow", "long one", None]), rng.choice(["m", "n", "", None]), rng.choice(["red", "", None]))
            for p in range(12) for i in range(9)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "doc string, page long, row_no long, model_code string, malli string, vari string")
    for parts in (1, 6):
        out = assemble.merge_continuations(df.repartition(parts), fields=["malli", "vari"], useful=["malli", "vari"]).orderBy("product_no").collect()
        assert [(r.model_code, r.malli, r.vari) for r in out] == naive_merge(rows)


def test_keyword_header_needs_three_words(spark):
    rows = [("d", 1, 1, i, c) for i, c in enumerate([["Malli", "x", "y"], ["Tuotenro", "Malli", "Hinta"], ["AAAA", "Summit", "10 €"], ["", "z", ""]])]
    df = spark.createDataFrame(rows, "doc string, table_no int, page long, row_no long, cells array<string>")
    out = assemble.keyword_records(df).collect()
    assert [(r.model_code, r.model_name, r.price_eur) for r in out] == [("AAAA", "Summit", "10 €")]


def test_feed_of_a_sheet(spark):
    catalog = spark.createDataFrame([("FREERIDE 850 ETEC SKI-DOO", 1, "SKI-DOO")], "search_text string, position long, brand string")
    out = feed.feed(sheet(spark), catalog, F.lit("SKI-DOO"), F.lit(2026)).collect()
    assert {r.listing_id for r in out} == {"SKI-DOO_VBTA_2026", "SKI-DOO_VBTB_2026"}
    first = [r for r in out if r.model_code == "VBTA"][0]
    assert first.roubles == 2231000 and "<Title>SKI-DOO Freeride 2026 Standard</Title>" in first.xml and first.matched


@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_products_are_numbered_across_partitions(spark, parts):
    """One hot document over many partitions of the sort, small ones between, rows without document, no rows."""
    rng = random.Random(int(parts))
    rows = [("hot", p, r) for p in range(30) for r in range(12)] + [(f"d{i}", 0, r) for i in range(25) for r in range(rng.randrange(1, 4))] + [(None, 1, r) for r in range(9)]
    rows = [(*r, rng.choice(["ABCD", " EFGH ", "x", "", None])) for r in rows]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        frame = spark.createDataFrame(rng.sample(rows, len(rows)), "doc string, page long, row_no long, model_code string")
        got = {(r.doc, r.page, r.row_no): r.product_no for r in assemble.number_products(frame).collect()}
        assert assemble.number_products(frame.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    seen, want = {}, {}
    for doc, page, row, code in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        seen[doc] = seen.get(doc, 0) + (len((code or "").strip()) == 4)
        want[(doc, page, row)] = seen[doc]
    assert got == want
