"""Lazy access to a folder of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """``t.part`` reads ``<folder>/part.parquet``; nothing is read before an action."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def select(self, sql: str) -> DataFrame:
        """Run a SELECT whose ``{table}`` marks stand for tables of the folder."""
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in sql}
        return self.spark.sql(sql, **used)
