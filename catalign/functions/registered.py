"""SQL functions and views for use from ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(spark: SparkSession) -> None:
    """Temporary SQL functions: lookup key and completion percentage."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION base_model_lookup_key(brand STRING, family STRING, year INT)
                 RETURNS STRING RETURN brand || '_' || replace(family, ' ', '_') || '_' || CAST(year AS STRING)""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION completion_percentage(done BIGINT, expected BIGINT)
                 RETURNS DOUBLE RETURN CASE WHEN coalesce(expected, 0) = 0 THEN 0.0D ELSE round(done / expected * 100, 2) END""")


def report_view(df: DataFrame, name: str) -> DataFrame:
    """Make a report available to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df
