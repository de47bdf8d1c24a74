"""Statistics over products, runs, options and messages: one aggregate per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.functions import bands
from catalign.operators.keep import top_per_key


def rate(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``part / whole * scale``, 0 for an empty whole."""
    return F.when(whole > 0, part / whole * scale).otherwise(F.lit(0.0))


def catalog_totals(df: DataFrame, brand: str, year: str, code: str) -> DataFrame:
    return df.agg(F.count("*").alias("total_products"), F.countDistinct(brand).alias("unique_brands"),
                  F.countDistinct(year).alias("unique_years"), F.countDistinct(code).alias("unique_models"))


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(*keys)


def outcome_totals(df: DataFrame, success: Column, confidence: str) -> DataFrame:
    """Total, successes and mean confidence; no row for an empty input."""
    return df.agg(F.count("*").alias("total"), F.count_if(success).alias("successful"),
                  F.avg(confidence).alias("avg_confidence")).filter(F.col("total") > 0)


def grouped_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grand total and one count per value of each key, in a single pass over grouping sets."""
    shaped = df.select(*[F.col(k).cast("string").alias(k) for k in keys])
    sets = shaped.groupingSets([[], *[[F.col(k)] for k in keys]], *keys)
    found = sets.agg(F.count("*").alias("count"), *[F.grouping(k).alias(f"_{k}") for k in keys])
    kind = F.coalesce(*[F.when(F.col(f"_{k}") == 0, F.lit(k)) for k in keys], F.lit("total"))
    value = F.coalesce(*[F.when(F.col(f"_{k}") == 0, F.col(k)) for k in keys])
    return found.select(kind.alias("dimension"), value.alias("value"), "count")


def level_totals(df: DataFrame, level: Column) -> DataFrame:
    tagged = df.select(level.alias("level"))
    return tagged.agg(F.count("*").alias("total"), *[
        F.count_if(F.col("level") == x).alias(x) for x in ("high", "medium", "low")])


def confidence_distribution(df: DataFrame, confidence: str, brand: str | None = None, value: str | None = None) -> DataFrame:
    rows = df if value is None else df.filter(F.col(brand) == value)
    return (rows.groupBy(bands.distribution_band(F.col(confidence)).alias("confidence_range"))
            .agg(F.count("*").alias("product_count")).orderBy("confidence_range"))


def option_stats(options: DataFrame, kind: str, verified: Column, confidence: str) -> DataFrame:
    return (options.groupBy(F.col(kind).alias("option_type"))
            .agg(F.count("*").alias("total_count"), F.count_if(verified).alias("verified_count"),
                 F.avg(confidence).alias("avg_confidence")).orderBy(F.desc("total_count"), "option_type"))


def quality_dashboard(products: DataFrame, mappings: DataFrame, on: Column, keys: Sequence[str]) -> DataFrame:
    """Per key: high-confidence, auto-accepted and review counts, mean confidence and time, calls.

    Products with several mappings count once per mapping, as the joined view does.
    """
    return products.join(mappings, on, "left").groupBy(*keys).agg(
        F.count("*").alias("total_products"), F.count_if(F.col("confidence_score") >= 0.95).alias("high_confidence"),
        F.count_if("auto_accepted").alias("auto_accepted"),
        F.count_if(F.col("validation_status") == "requires_review").alias("requiring_review"),
        F.avg("confidence_score").alias("avg_confidence"), F.avg("duration_ms").alias("avg_time_ms"),
        F.sum("api_calls").alias("total_calls"))


def completion(processed: Column, total: Column, empty: float | None = None) -> Column:
    """Percentage with two decimals; null (view) or ``empty`` (function) when nothing is expected."""
    share = F.round(processed / F.nullif(total, F.lit(0)) * 100, 2)
    return share if empty is None else F.coalesce(share, F.lit(empty))


def similarity_statistics(results: DataFrame, score: str, matched: Column) -> DataFrame:
    s = F.col(score)
    return results.agg(
        F.count("*").alias("total_matches"), F.count_if(matched).alias("successful_matches"),
        (F.count_if(matched) / F.count("*") * 100).alias("success_rate"), F.avg(s).alias("avg_similarity"),
        F.coalesce(F.avg(F.when(matched, s)), F.lit(0.0)).alias("avg_successful_similarity"),
        F.min(s).alias("min_similarity"), F.max(s).alias("max_similarity")).filter(F.col("total_matches") > 0)


def validation_summary(df: DataFrame) -> DataFrame:
    n = F.count("*")
    return df.agg(
        n.alias("total_validated"), F.count_if("success").alias("successful"),
        F.round(F.count_if("success") * 100.0 / n, 6).alias("success_rate"),
        F.count_if(F.size("warnings") > 0).alias("with_warnings"), F.count_if(F.size("errors") > 0).alias("with_errors"),
        F.round(F.avg("confidence"), 6).alias("average_confidence")).filter(F.col("total_validated") > 0)


def common_issues(df: DataFrame, issues: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """Most frequent messages; those seen first win ties."""
    return (df.select(*order, F.posexplode(issues).alias("_pos", "issue"))
            .groupBy("issue").agg(F.count("*").alias("count"), F.min(F.struct(*order, "_pos")).alias("_first"))
            .orderBy(F.desc("count"), "_first").limit(n).select("issue", "count"))


def stage_stats(runs: DataFrame, stage: str, success: Column) -> DataFrame:
    out = runs.groupBy(stage).agg(F.count("*").alias("total_processed"), F.count_if(success).alias("successful"))
    good = rate(F.col("successful"), F.col("total_processed"))
    return out.withColumns({"failed": F.col("total_processed") - F.col("successful"), "success_rate": good,
                            "failure_rate": F.lit(100.0) - good})


def operation_timing(runs: DataFrame, name: str, duration: str, order: Sequence[str], keep: int = 100) -> DataFrame:
    """Overall count, and mean, least, greatest and total time of the latest ``keep`` runs."""
    latest = top_per_key(runs, [name], [F.col(c).desc() for c in order], keep).groupBy(name).agg(
        F.avg(duration).alias("avg_ms"), F.min(duration).alias("min_ms"), F.max(duration).alias("max_ms"),
        F.sum(duration).alias("total_ms"))
    return runs.groupBy(name).agg(F.count("*").alias("count")).join(latest, name)


def job_statistics(jobs: DataFrame, status: str, items: str, good: str, bad: str, seconds: Column) -> DataFrame:
    state, n = F.col(status), F.greatest(F.lit(1), F.count("*"))
    return jobs.agg(
        F.count("*").alias("total_jobs"), F.count_if(state == "completed").alias("completed_jobs"),
        F.count_if(state == "failed").alias("failed_jobs"), F.count_if(state == "processing").alias("active_jobs"),
        (F.count_if(state == "completed") / n).alias("success_rate"), F.sum(items).alias("total_items"),
        F.sum(good).alias("successful_items"), F.sum(bad).alias("failed_items"),
        (F.sum(good) / F.greatest(F.lit(1), F.sum(items))).alias("item_success_rate"),
        F.coalesce(F.avg(seconds), F.lit(0.0)).alias("average_job_seconds"))


def recent_runs(runs: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """Means over the latest runs; runs without products stay in every denominator."""
    latest = runs.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    share = F.when(F.col("processed") > 0, F.col("validated") / F.col("processed") * 100).otherwise(0.0)
    recent = latest.agg((F.sum("seconds") / F.count("*")).alias("average_processing_time"),
                        (F.sum("processed") / F.count("*")).alias("average_products_processed"),
                        (F.sum(share) / F.count("*")).alias("average_validation_rate"),
                        F.count("*").alias("recent_executions"))
    overall = runs.agg(F.count("*").alias("total_executions"), F.count_if("success").alias("successful_executions"))
    both = overall.unionByName(recent, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "success_rate", F.col("successful_executions") / F.col("total_executions") * 100)


def weighted_confidence(scores: dict[str, Column], weights: Sequence[tuple[str, float]]) -> Column:
    total = F.lit(0.0)
    for stage, weight in weights:
        if stage in scores:
            total = total + F.coalesce(scores[stage], F.lit(0.0)) * weight
    return total


def metric_rows(totals: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per metric of an aggregate row."""
    return totals.unpivot(list(keys), list(metrics), "metric_name", "measured_value")


def population_metrics(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Speed, success, confidence, acceptance and cost per product, as metric rows."""
    n, good = F.count("*"), F.count_if("success")
    totals = runs.groupBy(*keys).agg(
        n.cast("double").alias("sample_size"),
        (good * 60000.0 / F.sum("duration_ms")).alias("processing_speed_products_per_minute"),
        (good / n).alias("pipeline_success_rate"), F.avg("confidence").alias("average_confidence_score"),
        (F.count_if(F.col("confidence") >= 0.95) / n).alias("auto_acceptance_rate"),
        F.try_divide(F.sum("cost"), good).alias("cost_per_product_usd"),
        F.try_divide(F.sum("calls"), good).alias("api_calls_per_product"))
    return metric_rows(totals, keys, [c for c in totals.columns if c not in keys])


def below(df: DataFrame, value: str, limit: float) -> DataFrame:
    return df.filter(F.col(value) < limit)


def over_limit(df: DataFrame, key: str, value: str, limits: dict[str, float]) -> DataFrame:
    """Rows whose value passes the limit of their key."""
    limit = F.coalesce(*[F.when(F.col(key) == k, F.lit(v)) for k, v in limits.items()])
    return df.withColumn("limit", limit).filter(F.col(value) > F.col("limit"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def data_quality(df: DataFrame, year: str, required: Sequence[str]) -> DataFrame:
    return df.agg(F.count_if((F.col(year) < 2015) | (F.col(year) > 2030)).alias("invalid_years"), *[
        F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(f"empty_{c}") for c in required])


def success_rates(runs: DataFrame, key: str, success: Column) -> DataFrame:
    return runs.groupBy(key).agg(F.avg(success.cast("double")).alias("success_rate"), F.count("*").alias("documents"))


def option_usage(applied: DataFrame, name: str, success: Column, score: str, promote: float = 0.85) -> DataFrame:
    """Usage and effectiveness of each option, and whether it is promoted to validated."""
    out = applied.groupBy(name).agg(F.count("*").alias("times_applied"), F.avg(success.cast("double")).alias("success_rate"),
                                    F.avg(score).alias("effectiveness"))
    return out.withColumn("validated", F.col("effectiveness") >= promote)


def report_summary(reports: DataFrame, status: str, started: str) -> DataFrame:
    bad = F.count_if(F.col(status) == "error")
    return reports.agg(F.count("*").alias("total"), bad.alias("failed"), F.min(started).alias("first_started"),
                       F.max(started).alias("last_started"), (bad / F.count("*") * 100).alias("failure_rate"))


def spec_pivot(specs: DataFrame, engine: str, fields: Sequence[str], engines: Sequence[str]) -> DataFrame:
    """Spec fields as rows and engines as columns; missing values show as a dash."""
    long = specs.select(engine, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(
        [engine], list(fields), "specification", "value")
    wide = long.groupBy("specification").pivot(engine, list(engines)).agg(F.first("value", ignorenulls=True))
    shown = {e: F.coalesce(F.nullif(F.col(f"`{e}`"), F.lit("")), F.lit("—")) for e in engines}
    return wide.withColumns(shown)


def usage_statistics(df: DataFrame, tokens: str, cost: str) -> DataFrame:
    thousands = F.greatest(F.lit(1), F.floor(F.sum(tokens) / 1000))
    return df.agg(F.sum(tokens).alias("total_tokens"), F.sum(cost).cast("double").alias("total_cost"),
                  (F.sum(cost).cast("double") / thousands).alias("average_cost_per_request"))


def tokens_per_minute(df: DataFrame, ts: str, tokens: Column, limit: int) -> DataFrame:
    return (df.groupBy(F.date_trunc("minute", ts).alias("minute")).agg(F.sum(tokens).alias("tokens"))
            .withColumn("over_limit", F.col("tokens") > limit))


def engine_price_order(products: DataFrame, model: str, engine: str, price: str) -> DataFrame:
    """Mean price per model and engine rank, and whether it rises with the rank.

    A model has at most three ranked rows, so the window stays small whatever the input.
    """
    name = F.col(engine)
    rank = F.when(name.contains("Turbo R"), 3).when(name.contains("850"), 2).when(name.contains("600R"), 1)
    means = (products.select(F.coalesce(F.col(model), F.lit("")).alias("model"), rank.alias("engine_rank"), F.col(price).alias("price"))
             .filter(F.col("engine_rank").isNotNull()).groupBy("model", "engine_rank").agg(F.avg("price").alias("price")))
    ordered = Window.partitionBy("model").orderBy("engine_rank")
    return means.withColumn("in_order", F.col("price") > F.lag("price").over(ordered))
