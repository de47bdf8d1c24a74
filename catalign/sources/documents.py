"""JSON sources: price entries, reports, whitelist, field constraints, schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalign.functions.text import validation_hints

ENTRY = ("model_code string, brand string, model_name string, price double, currency string, market string, model_year int, "
         "source_file string, page_number int, extraction_confidence double")
REPORTS = "reports_list struct<reports:array<struct<id:long,started_at:string,finished_at:string,status:string>>>"
CONSTRAINTS = ("fields array<struct<tag:string,label:string,descriptions:string,"
               "content:array<struct<required:boolean,field_type:string>>>>")
SCHEDULE = "schedule array<struct<rate:int,weekdays:array<int>,time_slots:array<int>>>"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parsed(text: Column, schema: str) -> Column:
    return F.from_json(text, f"struct<{schema}>" if not schema.startswith("array") else schema)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, ENTRY)


def entry_problem(code: Column, year: Column, page: Column, price: Column) -> Column:
    """Reason to quarantine a price entry; null for a valid one."""
    return (F.when(F.coalesce(code, F.lit("")) == "", "missing code").when(~F.coalesce(year.between(2020, 2030), F.lit(False)), "year out of range")
            .when(page < 1, "page below 1").when(F.coalesce(price, F.lit(-1.0)) < 0, "negative price"))


def product_problem(code: Column, year: Column) -> Column:
    """Reason to quarantine a product row; null for a valid one."""
    return (F.when(F.coalesce(F.length(code), F.lit(0)) != 4, "code is not 4 characters")
            .when((year != 0) & ~year.between(2015, 2030), "year out of range"))


def report_rows(df: DataFrame, column: str = "reports_list") -> DataFrame:
    return df.select(F.explode(f"{column}.reports").alias("r")).select("r.*")


def whitelist(df: DataFrame, column: str = "brp_models") -> DataFrame:
    return df.select(F.posexplode(column).alias("position", "name"))


def constraint_rows(df: DataFrame, column: str = "fields") -> DataFrame:
    """One row per field: tag, label, required, type and hints from its description."""
    first = F.get("f.content", F.lit(0))
    return df.select(F.explode(column).alias("f")).select(
        F.coalesce("f.tag", F.lit("Unknown")).alias("tag"), F.coalesce("f.label", F.lit("")).alias("label"),
        F.coalesce(first["required"], F.lit(False)).alias("required"), F.coalesce(first["field_type"], F.lit("text")).alias("type"),
        validation_hints(F.col("f.descriptions")).alias("hints"))


def schedule_rows(df: DataFrame, column: str = "schedule", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per weekday and hour of a nested schedule."""
    days = df.select(*keys, F.explode(column).alias("s")).select(*keys, "s.rate", "s.time_slots", F.explode("s.weekdays").alias("weekday"))
    return days.select(*keys, "rate", "weekday", F.explode("time_slots").alias("hour"))
