"""Corpus cleaning: toxicity, exact copies, near copies, benchmark leaks, source mix.

Every stage takes (spark, docs, sf_dir) and returns the columns of `documents`; the last adds `copy`. Each works on all that the
stage before kept. The rounding of the mix and the classifier have no SQL form, so ORACLE_SQL is None and the tests compare with
brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalign.llm import common, decontaminate, exact_dedup, mixing, near_copies as near, toxicity

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from all labelled documents."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the one with the smallest doc_id stays.

    SimHash fingerprints of the shingles link first, by vantage-point trees; every link is verified, and a prefix filter finds the rest."""
    return near.drop_near(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, numbered by `copy`."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", toxic), ("exact_dedup", exact_copies), ("simhash_dedup", near_copies), ("decontamination", benchmark_leaks),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return docs
