"""Updates, audit rows, retention and upload history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import bands, clock
from catalign.operators.keep import top_per_key
from catalign.operators.scans import previous_value


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Most recent row per key."""
    return top_per_key(df, keys, [F.col(c).desc() for c in order])


def update_by_key(df: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace columns by the update's non-null values; ``updates`` has one row per key."""
    fresh = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return df.join(fresh, list(keys), "left").withColumns(
        {c: F.coalesce(f"_new_{c}", c) for c in columns}).drop(*[f"_new_{c}" for c in columns])


def update_confidence(products: DataFrame, updates: DataFrame, key: str, user: str = "system") -> tuple[DataFrame, DataFrame]:
    """New product rows and the audit rows of the same update.

    ``updates(key, new_confidence, stage)``: level follows the new confidence.
    """
    joined = products.join(updates.select(key, "new_confidence", "stage"), key, "left")
    touched = F.col("new_confidence").isNotNull()
    audit = joined.filter(touched).select(
        key, "stage", F.lit("confidence_updated").alias("action"),
        F.to_json(F.struct(F.col("overall_confidence").alias("confidence"))).alias("before_data"),
        F.to_json(F.struct(F.col("new_confidence").alias("confidence"))).alias("after_data"),
        (F.col("new_confidence") - F.col("overall_confidence")).alias("confidence_change"), F.lit(user).alias("user_id"))
    score = F.coalesce("new_confidence", "overall_confidence")
    fresh = joined.withColumns({"confidence_level": bands.level3(score), "overall_confidence": score}).drop("new_confidence", "stage")
    return fresh, audit


def created_audit(products: DataFrame, key: str, user: str = "system") -> DataFrame:
    """One ``product_created`` audit row per product, with the whole product as JSON."""
    return products.select(key, F.lit("final_validation").alias("stage"), F.lit("product_created").alias("action"),
                           F.to_json(F.struct(*products.columns)).alias("after_data"), F.lit(user).alias("user_id"))


def confidence_changes(audit: DataFrame, key: str, order: Sequence[str], value: str, ts: str, block_seconds: int = 60) -> DataFrame:
    """Change against the key's previous value in time; keys are scanned in blocks of time."""
    out = previous_value(audit, [key], order, value, "_previous", F.floor(clock.micros(F.col(ts)) / (block_seconds * 1_000_000)))
    return out.withColumn("confidence_change", F.col(value) - F.col("_previous")).drop("_previous")


def retain(df: DataFrame, created: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows not older than ``days``."""
    return df.filter(F.col(created) >= as_of - F.make_dt_interval(F.lit(days)))


def retention_counts(df: DataFrame, table: str, created: str, as_of: Column, days: int = 30) -> DataFrame:
    old = F.col(created) < as_of - F.make_dt_interval(F.lit(days))
    return df.agg(F.count_if(old).alias("deleted"), F.count_if(~old).alias("kept")).select(F.lit(table).alias("table_name"), "*")


def upload_history(uploads: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    return uploads.orderBy(*[F.col(c).desc() for c in order]).limit(limit)


def pending_uploads(uploads: DataFrame, ts: str, success: Column, as_of: Column) -> DataFrame:
    """Successful uploads whose processing window has not closed at ``as_of``."""
    due = clock.expected_completion(F.col(ts))
    return (uploads.filter(success).withColumn("expected_completion", due).filter(F.col("expected_completion") > as_of)
            .withColumn("hours_until_completion", clock.minutes_between(as_of, F.col("expected_completion")) / 60))


def remaining_seconds(done: Column, total: Column, elapsed: Column) -> Column:
    speed = done / F.greatest(F.lit(1), elapsed)
    return F.when(done > 0, (total - done) / speed)
