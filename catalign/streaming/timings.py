"""The latest timings of every stage as a stream, kept in keyed state.

A key is split over shards by the hash of its order columns, so a stage with a third of all rows is no single task. Each shard keeps the
number of rows it has seen and a ring of the latest ``keep`` of them by the order columns; the latest of the stage are among the rings of its
shards, so readers merge rings and have the same figures as the batch form, whatever the order in which rows came.

Every batch gives one row for each shard it reached, written to its own folder and overwritten on a retry. A shard without a row for
``idle`` gives a last row, marked ``closed``, and its state goes; rows that come later begin a new life of the shard, and readers add the lives
up. With ``late`` rows behind the watermark are left out; without it none is, but nothing closes either.

Defined results: a null stage is a stage; null durations count as rows but not in means or sums; of rows with equal order columns all
count, and which of them stays in a full ring is not defined (give a unique last column); no rows give no stages.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from catalign.operators import keep, stats

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHARDS = 16


class LatestRuns(StatefulProcessor):
    """State of a shard: a count, the life's number and a ring of the latest rows, oldest first."""

    def __init__(self, size: int, idle_ms: int | None) -> None:
        self.size, self.idle_ms = size, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n long")
        self.ring = handle.getListState("ring", "at long, tie long, ms double")

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.ring.get()]

    def _row(self, key, seen: int, ring: list[tuple], closed: bool) -> pd.DataFrame:
        stage, shard = key
        runs = [{"at": a, "tie": t, "ms": None if m != m else m} for a, t, m in ring]
        return pd.DataFrame({"stage": [stage], "shard": [shard], "seen": [seen], "closed": [closed], "first_at": [ring[0][0]], "runs": [runs]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = self.seen.get()[0] if self.seen.exists() else 0
        ring = self._held()
        for chunk in rows:
            seen += len(chunk)
            fresh = chunk[["at", "tie", "ms"]].nlargest(self.size, ["at", "tie"])
            ring = sorted([*ring, *fresh.itertuples(index=False, name=None)], key=lambda r: r[:2])[-self.size:]
        ring = [(int(a), int(t), float("nan") if m is None else float(m)) for a, t, m in ring]
        self.seen.update((seen,))
        self.ring.put(ring)
        if self.idle_ms is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            # never behind the watermark, or rows of the first batch would close their own shard
            due = max(ring[-1][0] // 1000, timerValues.getCurrentWatermarkInMs()) + self.idle_ms
            self.handle.registerTimer(due)
        yield self._row(key, seen, ring, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            yield self._row(key, self.seen.get()[0], self._held(), True)
            self.seen.clear()
            self.ring.clear()

    def close(self) -> None:
        pass


SHARD_ROWS = "stage string, shard int, seen long, closed boolean, first_at long, runs array<struct<at: long, tie: long, ms: double>>"


def latest_runs(stream: DataFrame, stage: str, duration: str, ts: str, run_id: str, *, size: int = 100, late: str | None = None,
                idle_ms: int | None = None, shards: int = SHARDS) -> DataFrame:
    """Shard rows of every batch; ``ts`` is a timestamp and ``run_id`` a long that tells runs of one instant apart."""
    if idle_ms is not None and late is None:
        raise ValueError("idle shards close by the watermark: give late, too")
    shaped = stream.select(
        F.col(stage).cast("string").alias("stage"), F.pmod(F.xxhash64(ts, run_id), F.lit(shards)).cast("int").alias("shard"), F.col(ts).alias("_ts"),
        F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(1 << 62))).alias("at"), F.coalesce(F.col(run_id).cast("long"), F.lit(-(1 << 62))).alias("tie"),
        F.col(duration).cast("double").alias("ms"))
    if late:
        shaped = shaped.withWatermark("_ts", late)
    mode = "EventTime" if late else "None"
    return shaped.groupBy("stage", "shard").transformWithStateInPandas(LatestRuns(size, idle_ms), SHARD_ROWS, "Update", mode)


def monitor(stream: DataFrame, path: str, checkpoint: str, stage: str, duration: str, ts: str, run_id: str, **options) -> StreamingQuery:
    """Take in all that is there; one folder of shard rows per batch under ``path``."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # keyed state of this kind needs it; a query keeps what it began with
    try:
        query = (latest_runs(stream, stage, duration, ts, run_id, **options).writeStream.outputMode("update")
                 .foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return query


def timings(spark: SparkSession, path: str, size: int = 100) -> DataFrame:
    """Count of all runs, and mean, least, greatest and total time of the latest ``size`` runs of every stage, as ``stats.operation_timing`` gives them."""
    rows = spark.read.schema(SHARD_ROWS + ", batch_id long").parquet(path)
    life = ["stage", "shard"]
    # of an open life the last batch tells all; a closed one is whole in its closing row
    closed = rows.filter("closed")
    last = keep.top_per_key(rows, life, [F.desc("batch_id"), F.desc("closed")]).filter("NOT closed")
    whole = closed.unionByName(last)
    whole = whole.withColumn("key", F.struct("stage"))  # a struct joins null stages, too
    counts = whole.groupBy("key").agg(F.sum("seen").alias("count"))
    runs = whole.select("key", F.explode("runs").alias("r")).select("key", "r.*")
    latest = stats.operation_timing(runs, "key", "ms", ["at", "tie"], size).drop("count")
    return counts.join(latest, "key").select("key.stage", "count", "avg_ms", "min_ms", "max_ms", "total_ms")


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write what ``timings`` needs to ``target`` under the last batch number, so reads stay short; the old folder stays until readers have moved."""
    rows = spark.read.schema(SHARD_ROWS + ", batch_id long").parquet(path)
    last = rows.agg(F.max("batch_id")).first()[0]
    needed = rows.filter("closed").unionByName(keep.top_per_key(rows, ["stage", "shard"], [F.desc("batch_id"), F.desc("closed")]).filter("NOT closed"))
    needed.drop("batch_id").write.mode("errorifexists").parquet(f"{target}/batch_id={last}")
