"""Pairs of specifications and prices are whole, and written ones take little room."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalign.operators import joins

SPECS = "spec_id long, brand string, model string, engines array<string>, track_mm double"
PRICES = "sku string, brand string, model string, engine string, track_mm double"


def tier(spec_engine, price_engine, spec_mm, price_mm):
    gap = None if spec_mm is None or price_mm is None else abs(spec_mm - price_mm) / spec_mm
    if gap is None:
        return "medium"
    return "perfect" if gap == 0 and spec_engine == price_engine and spec_engine else "high" if gap <= 0.05 else "low"


@pytest.mark.parametrize("price_rows", [None, 30])
def test_pairs_of_classes_blocks_and_slices(spark, monkeypatch, price_rows):
    """More alike ids than a block, more prices of a key than a task, repeats and nulls."""
    monkeypatch.setattr(joins, "CLASS_IDS", 2)
    monkeypatch.setattr(joins, "TASK_PRICES", 3)
    specs = [(i, "Lynx", "Rave", ["850 E-TEC", "900 ACE"], 3900.0) for i in range(5)] + [
        (4, "LYNX", "rave", ["850 E-TEC", "850 E-TEC"], 3500.0), (None, "Lynx", "Rave", ["850 e-tec"], None), (7, "Lynx", "Rave", None, 3900.0),
        (8, None, "Rave", ["850 E-TEC"], 3900.0), (9, "Lynx", "Xtrim", ["900 ACE"], 3900.0), (10, "Lynx", "Rave", [], 3900.0)]
    prices = [(f"s{i}", "lynx", "RAVE", "850 E-TEC with Kit" if i % 2 else "850 E-TEC", [3900.0, None, 3800.0, 100.0][i % 4]) for i in range(20)] + [
        ("s1", "lynx", "RAVE", "850 E-TEC", 3900.0), (None, "lynx", "RAVE", "850 E-TEC", 3900.0), ("n", "lynx", "RAVE", None, 3900.0),
        ("m", None, "RAVE", "850 E-TEC", 3900.0), ("x", "Lynx", "Xtrim", "900 ACE", 3700.0), ("y", "Lynx", "Ranger", "900 ACE", 3700.0)]
    key = lambda b, m, e: b and (b.upper(), m.upper(), (e or "").split(" with ")[0].upper())
    want = Counter((i, sku, se, pe, tier(se, pe, mm, price_mm)) for i, b, m, engines, mm in specs for se in engines or [None]
                   for sku, pb, pm, pe, price_mm in prices if key(b, m, se) and key(b, m, se) == key(pb, pm, pe))
    out = joins.spec_price_join(spark.createDataFrame(specs, SPECS), spark.createDataFrame(prices, PRICES), price_rows=price_rows)["matches"]
    assert out.columns == ["spec_id", "sku", "spec_engine", "price_engine", "tier", "confidence"]
    rows = out.withColumn("task", F.spark_partition_id()).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    assert price_rows is None or len({r.task for r in rows if r.spec_id == 0}) > 1


def test_written_pairs_take_little_room(spark, tmp_path):
    """40 keys, each of 200 specifications and 200 prices that stand apart: 1.6 million pairs."""
    names = [F.lit("Lynx").alias("brand"), F.concat(F.lit("Rave "), F.col("id") % 40).alias("model")]
    specs = spark.range(8000).select(F.col("id").alias("spec_id"), *names, F.array(F.lit("900 ACE")).alias("engines"), (F.col("id") % 7 + 3000.0).alias("track_mm"))
    prices = spark.range(8000).select(F.concat(F.lit("sku-of-a-price-"), "id").alias("sku"), *names, F.lit("900 ACE").alias("engine"),
                                      (F.col("id") % 5 + 3000.0).alias("track_mm"))
    joins.spec_price_join(specs, prices)["matches"].select("spec_id", "sku", "tier").write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40 * 200 * 200
    size = sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet"))
    assert size < 0.6 * 1_600_000, size / 1_600_000


def test_patterns_are_taken_of_distinct_engines(spark):
    """No row of either side goes through the patterns; odd names and rows without one keep their keys."""
    names = [None, "", " with Kit", "850 E-TEC®", "850 e tec with Kit WITH more", "E-TEC 850", "Turbo R and 900", "TURBO  R 900", "\x00" "17"]
    specs = spark.createDataFrame([(i, "Lynx", "Rave", [n, n], 3900.0) for i, n in enumerate(names)], SPECS)
    prices = spark.createDataFrame([(f"s{i}", "LYNX", "rave", n, 3900.0) for i, n in enumerate(names)], PRICES)
    out = joins.spec_price_join(specs, prices)
    assert "regexp_replace" not in out["matches"]._jdf.queryExecution().optimizedPlan().toString()
    keyed = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i long, n string").withColumn("e", joins.engine_suffix_free(F.col("n")))
    keys = [r.e for r in keyed.orderBy("i").collect()]
    want = Counter((i, f"s{j}") for i, a in enumerate(keys) for j, b in enumerate(keys) for _ in range(2) if a == b)
    assert Counter((r.spec_id, r.sku) for r in out["matches"].collect()) == want and len(set(keys)) < len(keys)
    none = joins.spec_price_join(specs, prices.filter("false"))
    assert none["matches"].count() == 0 and none["unmatched_specs"].count() == len(names) and none["unmatched_pricing"].count() == 0
