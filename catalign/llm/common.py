"""Shared folder, written tables and joins that a hot key cannot hold up."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys are marked in a set of at most this many bucket numbers, so the set is small enough to broadcast at any input size.
MARK_BUCKETS = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where it is unset and the session is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="catalign-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here, and lost executors cost no recomputation before it.

    A given path is written over; the frame must not read it.
    """
    path = path or fresh_path(frame.sparkSession, name)
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def gathered(frame: DataFrame, rows: int, per_task: int = 200_000) -> DataFrame:
    """The frame in tasks of about `per_task` rows, where its `rows` (a bound) need fewer than the session's partitions."""
    parts = -(-max(rows, 1) // per_task)
    return frame.coalesce(parts) if parts < int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) else frame


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(MARK_BUCKETS))


def marked(keys: DataFrame, key: str) -> DataFrame:
    """Bucket numbers of the keys: never more than MARK_BUCKETS rows."""
    return keys.select(bucket(F.col(key)).alias("_bucket")).distinct()


def routed(frame: DataFrame, key: Column, buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be marked, rows whose key surely is not), both without a shuffle.

    `buckets` comes from `marked`; its size bound makes the broadcast safe. Null keys are never marked.
    """
    with_bucket = frame.withColumn("_bucket", bucket(key)).withColumn("_known", key.isNotNull())
    side = F.broadcast(buckets)
    on = with_bucket["_known"] & (with_bucket["_bucket"] == side["_bucket"])
    return (with_bucket.join(side, on, "left_semi").drop("_bucket", "_known"),
            with_bucket.join(side, on, "left_anti").drop("_bucket", "_known"))


def text_marks(text: str) -> list[Column]:
    """h0, h1: 128 bits of a text (null as empty), which with the doc_id tell rows apart that share or lack an id."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("h0"), F.xxhash64(F.lit(1), whole).alias("h1")]


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows as one column `row`, so that no name of theirs can clash, and more columns beside it; `row.*` gives them back."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *more)


def keep_one(docs: DataFrame, each: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The documents, one of each group: that of the smallest doc_id (null last), then text mark; rows that repeat its doc_id and text stay with it.

    `each` has one row (doc_id, h0, h1, root) per document; equal texts have one root. Rows outside groups are found by their text
    mark alone, whatever their doc_id, and mostly without a shuffle.
    """
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("h0"), F.col("h1"))
    groups = each.groupBy("root").agg(F.count("*").alias("n"), F.min(first).alias("best")).filter("n > 1").select("root", "best")
    chosen = saved(each.join(groups, "root").select("h0", "h1", "best").distinct(), "chosen")
    rows = packed(docs, F.col(f"`{doc_id}`").alias("id"), *text_marks(f"`{text}`"))
    suspects, clean = routed(rows, F.col("h0"), marked(chosen, "h0"))
    found = suspects.join(chosen, ["h0", "h1"], "left")
    stays = F.col("best").isNull() | (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("h0") == F.col("best.h0")) & (F.col("h1") == F.col("best.h1")))
    return clean.select("row").unionByName(found.filter(stays).select("row")).select("row.*")


def partitions_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions of about `per_task` rows each, at least the session's number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def small_side(frame: DataFrame, most_rows: int = 50_000) -> DataFrame:
    """The frame, to be broadcast if it is counted to be small; beyond that Spark joins it by shuffles with skew splitting."""
    return F.broadcast(frame) if frame.limit(most_rows + 1).count() <= most_rows else frame
