"""Latest timings in keyed state against the batch form."""

import random
from datetime import datetime, timedelta

from catalign.operators import stats
from catalign.streaming import monitors, timings

SCHEMA = "run_id long, ts timestamp, stage string, ms double"


def _runs(seed, n, start, hot="match"):
    rnd = random.Random(seed)
    at = [start + timedelta(seconds=rnd.randrange(0, 3600)) for _ in range(n)]
    return [(seed * 100_000 + i, at[i], hot if i % 3 else rnd.choice(["a", "b", "c", None]), None if i % 17 == 0 else float(rnd.randrange(1000))) for i in range(n)]


def _rows(df):
    return {r.stage: (r["count"], None if r.avg_ms is None else round(r.avg_ms, 9), r.min_ms, r.max_ms, r.total_ms) for r in df.collect()}


def _brute(runs, size):
    out = {}
    for stage in {r[2] for r in runs}:
        own = sorted((r for r in runs if r[2] == stage), key=lambda r: (r[1], r[0]))
        ms = [r[3] for r in own[-size:] if r[3] is not None]
        out[stage] = (len(own), round(sum(ms) / len(ms), 9) if ms else None, min(ms, default=None), max(ms, default=None), sum(ms) if ms else None)
    return out


def test_stream_equals_batch_after_a_restart(spark, tmp_path):
    base, start = str(tmp_path), datetime(2024, 1, 1)
    all_runs = []
    for k, hour in enumerate([2, 0, 1]):  # the second and third folder bring older rows
        part = _runs(k, 700, start + timedelta(hours=hour))
        all_runs += part
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(base + "/in")
        stream = monitors.file_stream(spark, base + "/in", SCHEMA, per_trigger=1)
        timings.monitor(stream, base + "/rows", base + "/c", "stage", "ms", "ts", "run_id", shards=3)
        assert _rows(timings.timings(spark, base + "/rows")) == _brute(all_runs, 100)
    batch = stats.operation_timing(spark.createDataFrame(all_runs, SCHEMA).filter("stage IS NOT NULL"), "stage", "ms", ["ts", "run_id"])
    mine = _rows(timings.timings(spark, base + "/rows"))
    assert {k: v for k, v in mine.items() if k is not None} == _rows(batch)
    timings.compact(spark, base + "/rows", base + "/short")
    assert _rows(timings.timings(spark, base + "/short")) == mine


def test_late_rows_and_idle_stages(spark, tmp_path):
    base, day = str(tmp_path), datetime(2024, 1, 1)
    files = [[(1, day, "x", 5.0), (2, day, "y", 1.0)], [(3, day + timedelta(days=2), "y", 3.0)],
             [(4, day + timedelta(hours=1), "y", 9.0), (5, day + timedelta(days=2), "y", 7.0)], [(6, day + timedelta(days=3), "x", 11.0)]]
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(base + "/in")
        stream = monitors.file_stream(spark, base + "/in", SCHEMA, per_trigger=1)
        timings.monitor(stream, base + "/rows", base + "/c", "stage", "ms", "ts", "run_id", late="1 hour", idle_ms=12 * 3600 * 1000, shards=1)
    closed = {(r.stage, r.seen) for r in spark.read.parquet(base + "/rows").filter("closed").collect()}
    assert ("x", 1) in closed
    # row 4 lies behind the watermark; the second life of x adds to the first
    assert {k: v[0] for k, v in _rows(timings.timings(spark, base + "/rows")).items()} == {"x": 2, "y": 3}
    assert _rows(timings.timings(spark, base + "/rows"))["x"][4] == 16.0
