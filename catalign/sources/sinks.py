"""Writers: append, upsert, delete, retention, XML feed, JSON splits, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalign.operators import history, keep


def append_rows(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def append_results(df: DataFrame, path: str, json_columns: Sequence[str]) -> None:
    """Append validation or match results, nested columns as JSON text."""
    append_rows(df.withColumns({c: F.to_json(c) for c in json_columns}), path)


def upsert_table(new: DataFrame, path: str, target: str, keys: Sequence[str], order: Sequence[str],
                 partitions: Sequence[str] = ()) -> None:
    """Merge ``new`` into the table at ``path`` and write the result to ``target``.

    Plain parquet has no transaction: readers are pointed at ``target`` after the write, and the old
    folder stays until then, so a lost job leaves the table as it was.
    """
    merged = keep.upsert(new.sparkSession.read.parquet(path), new, keys, order)
    writer = merged.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(target)


def delete_from(path: str, target: str, keys: DataFrame, on: Sequence[str]) -> None:
    keep.delete_keys(keys.sparkSession.read.parquet(path), keys, on).write.mode("errorifexists").parquet(target)


def retain_tables(spark: SparkSession, tables: dict[str, tuple[str, str]], created: str, as_of: Column,
                  days: int = 30) -> DataFrame:
    """Rewrite each ``name: (path, target)`` without old rows; returns deleted and kept counts."""
    counts = None
    for name, (path, target) in tables.items():
        df = spark.read.parquet(path)
        history.retain(df, created, as_of, days).write.mode("errorifexists").parquet(target)
        one = history.retention_counts(df, name, created, as_of, days)
        counts = one if counts is None else counts.unionByName(one)
    return counts


def listing_xml(fields: dict[str, Column]) -> Column:
    """XML text of one listing."""
    return F.to_xml(F.struct(*[c.alias(n) for n, c in fields.items()]), {"rowTag": "Ad"})


def write_feed(listings: DataFrame, path: str, root: str = "Ads", row: str = "Ad") -> None:
    """XML feed: one document part per output file."""
    listings.write.mode("errorifexists").format("xml").option("rootTag", root).option("rowTag", row).save(path)


def well_formed(xml: Column, schema: str) -> Column:
    """Whether a text parses as XML."""
    parsed = F.from_xml(xml, f"{schema}, _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return parsed.isNotNull() & parsed["_corrupt_record"].isNull()


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """JSON lines, one folder per split."""
    df.write.mode("errorifexists").partitionBy(split).json(path)


def write_report(stats: DataFrame, path: str, kind: str = "json") -> None:
    writer = stats.write.mode("errorifexists")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)
