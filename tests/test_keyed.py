"""Keyed tables: what a change rewrites, what readers see."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalign.sources import keyed
from catalign.streaming import monitors


def _folders(spark, path):
    return keyed.manifest(spark, path)["folders"]


def _files(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def _table(spark, path, n=2000, parts=64):
    keyed.create(spark.range(n).select("id", F.lit(0).alias("v")), path, ["id"], ["v"], parts)


def test_an_upsert_of_one_percent_rewrites_only_touched_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, path)
    before, files = _folders(spark, path), _files(path)
    new = spark.createDataFrame([(i, 1) for i in range(0, 200, 10)] + [(5000, 7), (5000, 9)], "id long, v int")
    touched = keyed.upsert(new, path, ["v"])
    after = _folders(spark, path)
    assert 0 < len(touched) <= 21 and {p for p in after if after[p] != before.get(p)} == set(touched)
    assert files <= _files(path) and len(_files(path) - files) == len(touched)
    got = {r.id: r.v for r in keyed.read(spark, path).collect()}
    assert got == {i: 1 if i < 200 and i % 10 == 0 else 0 for i in range(2000)} | {5000: 9}
    keyed.upsert(new, path, ["v"])
    assert {r.id: r.v for r in keyed.read(spark, path).collect()} == got
    assert keyed.read(spark, path, 1).filter("v > 0").count() == 0


def test_delete_retain_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(400).select("id", F.expr("CASE WHEN id < 3 THEN TIMESTAMP_NTZ '2024-01-01 00:00:00' ELSE TIMESTAMP_NTZ '2024-02-01 00:00:00' END").alias("at"))
    keyed.create(rows, path, ["id"], ["at"], 64)
    assert len(keyed.delete(spark.createDataFrame([(7,), (8,), (99999,)], "id long"), path)) <= 3
    assert keyed.read(spark, path).count() == 398
    touched = keyed.retain(spark, path, "at", F.lit("2024-02-10 00:00:00").cast("timestamp_ntz"), 30)
    assert 1 <= len(touched) <= 3 and keyed.read(spark, path).agg(F.min("id")).first()[0] == 3
    assert keyed.versions(spark, path) == [1, 2, 3]
    keyed.vacuum(spark, path, 1)
    assert keyed.versions(spark, path) == [3] and keyed.read(spark, path).count() == 395


def test_a_lost_job_changes_nothing_and_the_second_writer_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    _table(spark, path, 100, 8)
    commit = keyed._commit
    monkeypatch.setattr(keyed, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        keyed.upsert(spark.createDataFrame([(1, 5)], "id long, v int"), path, ["v"])
    monkeypatch.setattr(keyed, "_commit", commit)
    assert keyed.read(spark, path).filter("v = 5").count() == 0
    stale = keyed.manifest(spark, path)
    keyed.upsert(spark.createDataFrame([(1, 6)], "id long, v int"), path, ["v"])
    with pytest.raises(RuntimeError):
        keyed._commit(spark, path, 2, stale)
    assert keyed.read(spark, path).filter("v = 6").count() == 1


def test_empty_changes_null_keys_and_extra_order(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create(spark.createDataFrame([(None, 1), (1, 1)], "id long, v int"), path, ["id"], ["v"], 4)
    assert keyed.upsert(spark.createDataFrame([], "id long, v int"), path, ["v"]) == []
    keyed.upsert(spark.createDataFrame([(2, None)], "v int, id long"), path, ["v"])
    assert sorted((r.v, r.id) for r in keyed.read(spark, path).filter("id IS NULL").collect()) == [(1, None), (2, None)]
    keyed.delete(spark.createDataFrame([(1,)], "id long"), path)
    assert keyed.read(spark, path).count() == 2
    keyed.create(spark.createDataFrame([], "id long, v int"), path + "0", ["id"], ["v"], 4)
    assert keyed.read(spark, path + "0").count() == 0 and keyed.read(spark, path + "0").columns == ["id", "v"]
    keyed.upsert(spark.createDataFrame([(3, 4)], "id long, v int"), path + "0", ["v"])
    assert [tuple(r) for r in keyed.read(spark, path + "0").collect()] == [(3, 4)]


def test_a_stream_keeps_a_keyed_table(spark, tmp_path):
    base = str(tmp_path)
    for k in range(3):
        spark.createDataFrame([(1, k), (10 + k, k)], "id long, v int").coalesce(1).write.mode("append").parquet(base + "/in")
    stream = monitors.file_stream(spark, base + "/in", "id long, v int", per_trigger=1)
    monitors.ingest_keyed(stream, base + "/t", base + "/c", ["id"], ["v"], 8)
    got = {r.id: r.v for r in keyed.read(spark, base + "/t").collect()}
    assert set(got) == {1, 10, 11, 12} and got[10] == 0 and got[12] == 2 and len(keyed.versions(spark, base + "/t")) == 3
