"""File discovery and checks; only names and sizes are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalign.functions.text import file_brand, file_year

MAX_BYTES = 100 * 1024 * 1024


def discover(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files of a folder with name, size and time; contents are never loaded."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def price_list_files(files: DataFrame) -> DataFrame:
    return files.withColumns({"brand": file_brand(F.col("name")), "year": file_year(F.col("name"))})


def reject_reason(length: Column, limit: int = MAX_BYTES) -> Column:
    return F.when(length == 0, "empty file").when(length > limit, "file too large")


def checked(files: DataFrame, limit: int = MAX_BYTES, expected: DataFrame | None = None) -> DataFrame:
    """Files with the reason they are rejected, null for valid ones.

    Spark lists no empty files; with ``expected(name)`` a named file that was not found is reported.
    """
    done = files.withColumn("reject_reason", reject_reason(F.col("length"), limit))
    if expected is None:
        return done
    absent = expected.join(files.select("name"), "name", "left_anti").withColumn("reject_reason", F.lit("missing or empty file"))
    return done.unionByName(absent, allowMissingColumns=True)
