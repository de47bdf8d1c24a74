"""Large tables that change: parts by key hash, and a manifest that says which folder holds each part.

A change rewrites the parts it touches into a new folder and then adds one manifest; every other part stays where it is. Readers follow the
newest manifest, so they see a change whole or not at all: a job lost before its manifest leaves the table as it was, and folders that
no manifest names are only unused. Of two writers that start from the same manifest the second fails. Old folders stay until ``vacuum``.

Defined results: null keys are a key like any other for the part they lie in, but as in SQL they match nothing, so rows with null keys are only added; of
repeated new rows of a key the last by ``order`` stays; an empty change adds a manifest with the same parts; a read of no rows keeps the schema.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalign.operators import history, keep

PART = "_part"


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path, as the session's own configuration resolves them."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed manifests, oldest first."""
    files, where, _ = _files(spark, path + "/manifest")
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """``parts``, ``keys``, ``schema`` and ``folders`` (part to folder) of a version, the newest by default."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"no keyed table at {path}")
    text = spark.read.text(f"{path}/manifest/{known[-1] if version is None else version}.json", wholetext=True).first()[0]
    found = json.loads(text)
    return found | {"folders": {int(p): f for p, f in found["folders"].items()}}


def _commit(spark: SparkSession, path: str, version: int, content: dict) -> None:
    files, folder, new_path = _files(spark, path + "/manifest")
    files.mkdirs(folder)
    draft, final = new_path(folder, f"_{uuid.uuid4().hex}"), new_path(folder, f"{version}.json")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"version {version} of {path} was written by another job")


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _write(rows: DataFrame, path: str, keys: Sequence[str], parts: int) -> str:
    """Rows by part in a new folder; Spark splits a part that grew large over several tasks and files."""
    folder = f"data/{uuid.uuid4().hex}"
    rows.withColumn(PART, part_of(keys, parts)).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{path}/{folder}")
    return folder


def _kept_parts(spark: SparkSession, path: str, folder: str) -> set[int]:
    files, where, _ = _files(spark, f"{path}/{folder}")
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return {int(n.removeprefix(PART + "=")) for n in names if n.startswith(PART + "=")}


def create(rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], parts: int = 256) -> None:
    """A new keyed table: the last row per key by ``order``; ``parts`` is fixed from then on (aim at about 128 MB each)."""
    spark = rows.sparkSession
    folder = _write(keep.keep_last(rows, keys, order), path, keys, parts)
    held = dict.fromkeys(sorted(_kept_parts(spark, path, folder)), folder)
    _commit(spark, path, 1, {"parts": parts, "keys": list(keys), "schema": rows.schema.jsonValue(), "folders": held})


def _rows(spark: SparkSession, path: str, found: dict, only: Sequence[int] | None = None) -> DataFrame:
    """One scan of the folders of the wanted parts."""
    wanted = [f"{path}/{f}/{PART}={p}" for p, f in sorted(found["folders"].items()) if only is None or p in only]
    schema = StructType.fromJson(found["schema"])
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*wanted)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest by default."""
    return _rows(spark, path, manifest(spark, path, version))


def _changed(spark: SparkSession, path: str, touched: Sequence[int] | None, change: Callable[[DataFrame, dict], DataFrame]) -> list[int]:
    """Rewrite the touched parts (None: all) and commit; returns the parts."""
    number = versions(spark, path)[-1]
    found = manifest(spark, path, number)
    touched = sorted(found["folders"]) if touched is None else sorted(touched)
    folders = found["folders"]
    if touched:
        folder = _write(change(_rows(spark, path, found, touched), found), path, found["keys"], found["parts"])
        folders = {p: f for p, f in folders.items() if p not in touched} | dict.fromkeys(_kept_parts(spark, path, folder), folder)
    _commit(spark, path, number + 1, found | {"folders": dict(sorted(folders.items()))})
    return touched


def _parts_of(rows: DataFrame, found: dict) -> list[int]:
    """The parts that rows fall into: at most as many numbers as the table has parts."""
    return [r[0] for r in rows.select(part_of(found["keys"], found["parts"]).alias(PART)).distinct().collect()]


def upsert(new: DataFrame, path: str, order: Sequence[str]) -> list[int]:
    """New rows win, later ones by ``order`` beat earlier ones; returns the rewritten parts. The same change twice gives the same table."""
    spark = new.sparkSession
    found = manifest(spark, path)
    return _changed(spark, path, _parts_of(new, found), lambda old, m: keep.upsert(old, new.select(old.columns), m["keys"], order))


def delete(keys: DataFrame, path: str) -> list[int]:
    """Rows of the given keys go; returns the rewritten parts."""
    spark = keys.sparkSession
    found = manifest(spark, path)
    touched = set(_parts_of(keys, found)) & set(found["folders"])
    return _changed(spark, path, touched, lambda old, m: keep.delete_keys(old, keys, m["keys"]))


def retain(spark: SparkSession, path: str, created: str, as_of: Column, days: int = 30) -> list[int]:
    """Rows older than ``days`` go; only parts that hold such rows are rewritten."""
    found = manifest(spark, path)
    rows = _rows(spark, path, found)
    limit = as_of - F.make_dt_interval(F.lit(days))
    touched = _parts_of(rows.filter(~F.coalesce(F.col(created) >= limit, F.lit(False))), found)
    return _changed(spark, path, touched, lambda old, _: history.retain(old, created, as_of, days))


def vacuum(spark: SparkSession, path: str, keep_versions: int = 2) -> int:
    """Delete manifests before the newest ``keep_versions`` and the folders that only they name; returns the folders deleted.

    Folders of jobs that still run are named by no manifest either, so run it while nothing writes.
    """
    known = versions(spark, path)
    kept = {f for v in known[-keep_versions:] for f in manifest(spark, path, v)["folders"].values()}
    files, data, new_path = _files(spark, path + "/data")
    for v in known[:-keep_versions]:
        files.delete(new_path(f"{path}/manifest/{v}.json"), False)
    unused = [s.getPath() for s in files.listStatus(data) if f"data/{s.getPath().getName()}" not in kept]
    for folder in unused:
        files.delete(folder, True)
    return len(unused)
