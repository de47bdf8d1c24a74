import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from catalign.functions import blocks


def _pairs(seed, n, letters, longest):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices(letters, k=rnd.randrange(0, longest)))
    out = []
    for _ in range(n):
        a = word()
        b = "".join(c for c in a if rnd.random() < 0.8) + word()[: rnd.randrange(0, 6)] if rnd.random() < 0.6 else word()
        out.append((a, b))
    return out


def _ratio(a, b):
    return SequenceMatcher(None, a.lower(), b.lower()).ratio() if a and b else 0.0


def test_equal_to_the_library_on_many_pairs(spark):
    pairs = _pairs(1, 8_500, "abcdE ", 22) + _pairs(2, 1_200, "abcdefghijklmnop é日😀", 40)
    rnd = random.Random(3)
    for _ in range(300):  # at and beyond 200 letters frequent ones begin no block
        b = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", weights=[30, 20, 5] + [1] * 33, k=rnd.randrange(195, 260)))
        at = rnd.randrange(0, 100)
        pairs.append((b[at:at + rnd.randrange(5, 60)] + "".join(rnd.choices("abcxyz", k=10)), b))
    pairs += [("", "a"), ("a", ""), ("a" * 30, "a" * 300), ("ab" * 120, "ab" * 130), ("x", "y")]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string").repartition(8)
    got = {r.i: r.r for r in frame.select("i", blocks.block_ratio(F.col("a"), F.col("b")).alias("r")).collect()}
    wrong = [(a, b, got[i], _ratio(a, b)) for i, (a, b) in enumerate(pairs) if abs(got[i] - _ratio(a, b)) > 1e-12]
    assert len(pairs) >= 10_000 and not wrong, wrong[:3]


def test_nulls_and_the_plan(spark):
    frame = spark.createDataFrame([(None, "a"), ("a", None), ("Ab", "aB")], "a string, b string").select(blocks.block_ratio(F.col("a"), F.col("b")).alias("r"))
    assert [r.r for r in frame.collect()] == [0.0, 0.0, 1.0]
    assert "Python" not in frame._jdf.queryExecution().toString() and "Pandas" not in frame._jdf.queryExecution().toString()
