"""Block scans equal plain loops, whatever the block size, key skew or input order."""

import random

import pytest
from pyspark.sql import functions as F

from catalign.operators import keep, scans


@pytest.mark.parametrize("fan,depth", [(2, 1), (3, 2), (7, 3), (1000, 1), (5, 0)])
def test_exclusive_sum(spark, fan, depth):
    rng = random.Random(fan)
    data = [(k, p, rng.randrange(5)) for k in "ab" for p in rng.sample(range(200), 60 if k == "a" else 5)]
    out = scans.exclusive_scan(spark.createDataFrame(data, "k string, p long, v long").repartition(5), ["k"], "p", "v", "before",
                               fan=fan, depth=depth)
    for r in out.collect():
        assert r.before == sum(v for k, p, v in data if k == r.k and p < r.p)


def test_exclusive_last_skips_nulls(spark):
    data = [("a", p, p if p % 4 == 0 else None) for p in range(50)]
    out = scans.exclusive_scan(spark.createDataFrame(data, "k string, p long, v long"), ["k"], "p", "v", "b", "last", fan=3, depth=2)
    for r in out.collect():
        assert r.b == (None if r.p == 0 else (r.p - 1) // 4 * 4)


def test_ordinal_over_two_keys_with_a_hot_key(spark):
    keys = [(1, t) for t in range(300)] + [(c, t) for c in range(2, 40) for t in range(c % 4)]
    out = scans.ordinal(spark.createDataFrame(keys, "c long, t long").repartition(7), ["c", "t"], "n", fan=8, depth=2)
    assert [r.n for r in out.orderBy("c", "t").collect()] == list(range(len(keys)))


def test_previous_value_crosses_blocks(spark):
    rng = random.Random(3)
    rows = [("hot", i, rng.random()) for i in range(100)] + [("rare", 5, 0.1)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    for size in (1, 7, 1000):
        out = scans.previous_value(df, ["k"], ["i"], "v", "prev", F.floor(F.col("i") / size))
        got = {(r.k, r.i): r.prev for r in out.collect()}
        assert got[("rare", 5)] is None and got[("hot", 0)] is None
        assert all(got[("hot", i)] == rows[i - 1][2] for i in range(1, 100))


def test_top_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 2)
    top = keep.top_per_key(df, ["k"], [F.desc("id")])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r.id for r in top.collect()) == [998, 999]


def test_upsert_and_dedup_do_not_depend_on_input_order(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 0, "p"), ("a", 2, "q"), ("c", 1, "z")], "k string, n int, v string")
    for parts in (1, 4):
        rows = keep.upsert(old.repartition(parts), new.repartition(parts), ["k"], ["n"]).collect()
        assert {(r.k, r.v) for r in rows} == {("a", "q"), ("b", "y"), ("c", "z")}
    items = spark.sql("SELECT array('New bodywork', 'LED', 'new  BODYWORK!', 'led') AS a")
    from catalign.functions.text import item_text
    assert items.select(keep.dedup_array(F.col("a"), item_text)).first()[0] == ["New bodywork", "LED"]
