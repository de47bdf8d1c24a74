"""Structured Streaming jobs: ingest, monitors, audit and duplicate suppression.

State is kept in the checkpoint folder of each query, so a lost executor resumes from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalign.operators import keep
from catalign.sources import keyed


def file_stream(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", glob: str = "*", per_trigger: int | None = None) -> DataFrame:
    """Every file of a folder once, in arrival order."""
    reader = spark.readStream.format(kind).schema(schema).option("pathGlobFilter", glob)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(folder)


def run_to_end(writer) -> StreamingQuery:
    """Start, take in all that is there, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return run_to_end(stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))


def ingest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Append each micro-batch once, last write per key within it; readers keep the last batch per key.

    Each batch goes to its own folder and is overwritten on a retry, so a repeated batch is not doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        keep.keep_last(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run_to_end(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def ingest_keyed(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], parts: int = 256) -> StreamingQuery:
    """Merge every micro-batch into a keyed table; only the parts it touches are rewritten, and a repeated batch changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if keyed.versions(batch.sparkSession, path):
            keyed.upsert(batch, path, order)
        else:
            keyed.create(batch, path, keys, order, parts)

    return run_to_end(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def ingested(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current rows of an ingested table."""
    return keep.keep_last(spark.read.parquet(path), keys, ["batch_id"]).drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """Write the current rows of an ingested table to ``target``, under its last batch number, so reads stay short.

    The old folder stays as it is; ingest goes on in ``target`` with the same checkpoint once readers have moved.
    """
    last = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    ingested(spark, path, keys).write.mode("errorifexists").parquet(f"{target}/batch_id={last}")


def audit_batches(stream: DataFrame, path: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Audit rows of every micro-batch, one folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run_to_end(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def error_rates(df: DataFrame, ts: str, is_error: Column, width: str = "1 day", slide: str | None = None, late: str | None = None,
                key: str | None = None) -> DataFrame:
    """Attempts, errors and error rate per window (and key); with ``late`` a watermark drops older rows."""
    rows = df.withWatermark(ts, late) if late else df
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    grouped = rows.groupBy(window.alias("w"), *([key] if key else []))
    out = grouped.agg(F.count("*").alias("attempts"), F.count_if(is_error).alias("errors"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *([key] if key else []), "attempts", "errors",
                      (F.col("errors") / F.col("attempts")).alias("error_rate"))


def health_alerts(df: DataFrame, ts: str, stage: str, success: Column, least: float = 0.95, width: str = "1 day", slide: str = "12 hours",
                  late: str | None = None) -> DataFrame:
    """Sliding windows of a stage whose success rate falls below ``least``."""
    rates = error_rates(df, ts, ~success, width, slide, late, stage)
    return rates.withColumn("success_rate", F.lit(1.0) - F.col("error_rate")).filter(F.col("success_rate") < least)


def first_uploads(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """First row per key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)
