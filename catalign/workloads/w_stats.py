"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import bands, clock, fixed, prices, text
from catalign.operators import stats
from catalign.workloads import query
from catalign.workloads.standins import BASE_MODELS, ENTRIES, PRODUCTS, RUN_LOG, plain
from catalign.workloads.w_matching import boost_sql

E, P, B, R = plain(ENTRIES), plain(PRODUCTS), plain(BASE_MODELS), plain(RUN_LOG)


@query("a01_catalog_totals", f"""
SELECT count(*) AS total_products, count(DISTINCT brand) AS unique_brands, count(DISTINCT model_year) AS unique_years,
 count(DISTINCT model_code) AS unique_models FROM ({E}) e""")
def _(t):
    return stats.catalog_totals(t.select(ENTRIES), "brand", "model_year", "model_code")


@query("a02_brand_year_counts", f"SELECT brand, model_year, count(*) AS count FROM ({E}) e GROUP BY 1, 2")
def _(t):
    return stats.counts(t.select(ENTRIES), "brand", "model_year")


@query("a03_outcome_totals", f"""
SELECT count(*) AS total, count(*) FILTER (success) AS successful, round(avg(duration_ms), 4) AS avg_confidence FROM ({R}) r""")
def _(t):
    return stats.outcome_totals(t.select(RUN_LOG), F.col("success"), "duration_ms").withColumn(
        "avg_confidence", F.round("avg_confidence", 4))


@query("a04_grouped_counts", f"""
SELECT 'total' AS dimension, NULL AS value, count(*) AS count FROM ({E}) e
UNION ALL SELECT 'brand', brand, count(*) FROM ({E}) e GROUP BY 2
UNION ALL SELECT 'model_year', CAST(model_year AS VARCHAR), count(*) FROM ({E}) e GROUP BY 2
UNION ALL SELECT 'currency', currency, count(*) FROM ({E}) e GROUP BY 2""")
def _(t):
    return stats.grouped_counts(t.select(ENTRIES), ["brand", "model_year", "currency"])


@query("a05_level_totals", f"""
SELECT count(*) AS total, count(*) FILTER (extraction_confidence >= 0.9) AS high,
 count(*) FILTER (extraction_confidence >= 0.7 AND extraction_confidence < 0.9) AS medium,
 count(*) FILTER (extraction_confidence < 0.7) AS low FROM ({E}) e""")
def _(t):
    return stats.level_totals(t.select(ENTRIES), bands.level3(F.col("extraction_confidence")))


_band = "CASE WHEN extraction_confidence >= 0.9 THEN 'high (>=0.9)' WHEN extraction_confidence >= 0.7 THEN 'medium (0.7-0.89)' ELSE 'low (<0.7)' END"


@query("a06_confidence_distribution", f"""
SELECT {_band} AS confidence_range, count(*) AS product_count FROM ({E}) e WHERE brand = 'Ski-Doo' GROUP BY 1""")
def _(t):
    return stats.confidence_distribution(t.select(ENTRIES), "extraction_confidence", "brand", "Ski-Doo")


@query("a07_option_stats", """
SELECT event_type AS option_type, count(*) AS total_count, count(*) FILTER (value > 50) AS verified_count,
 round(avg(value), 4) AS avg_confidence FROM events GROUP BY 1""")
def _(t):
    return stats.option_stats(t.events, "event_type", F.col("value") > 50, "value").withColumn(
        "avg_confidence", F.round("avg_confidence", 4))


@query("a08_quality_dashboard", f"""
SELECT brand, model_year, count(*) AS total_products, count(*) FILTER (confidence_score >= 0.95) AS high_confidence,
 count(*) FILTER (confidence_score >= 0.9 AND currency = 'EUR') AS auto_accepted,
 count(*) FILTER (currency = 'RUB') AS requiring_review, round(avg(confidence_score), 6) AS avg_confidence,
 round(avg(l_quantity), 4) AS avg_time_ms, CAST(sum(l_linenumber) AS BIGINT) AS total_calls
FROM (SELECT *, extraction_confidence AS confidence_score FROM ({E}) e) p LEFT JOIN lineitem ON l_partkey = entry_id GROUP BY 1, 2""")
def _(t):
    rows = t.select(ENTRIES).select(
        "entry_id", "brand", "model_year", F.col("extraction_confidence").alias("confidence_score"),
        ((F.col("extraction_confidence") >= 0.9) & (F.col("currency") == "EUR")).alias("auto_accepted"),
        F.when(F.col("currency") == "RUB", "requires_review").otherwise("passed").alias("validation_status"))
    mappings = t.lineitem.select("l_partkey", F.col("l_quantity").alias("duration_ms"), F.col("l_linenumber").alias("api_calls"))
    out = stats.quality_dashboard(rows, mappings, F.col("entry_id") == F.col("l_partkey"), ["brand", "model_year"])
    return out.withColumns({"avg_confidence": F.round("avg_confidence", 6), "avg_time_ms": F.round("avg_time_ms", 4)})


@query("a09_completion", """
SELECT l_orderkey, round(count(*) FILTER (l_linestatus = 'F') / nullif(count(*) FILTER (l_returnflag <> 'N'), 0) * 100, 2) AS completion_view,
 coalesce(round(count(*) FILTER (l_linestatus = 'F') / nullif(count(*) FILTER (l_returnflag <> 'N'), 0) * 100, 2), 0.0) AS completion_function
FROM lineitem GROUP BY 1""")
def _(t):
    done, due = F.count_if(F.col("l_linestatus") == "F"), F.count_if(F.col("l_returnflag") != "N")
    sums = t.lineitem.groupBy("l_orderkey").agg(done.alias("done"), due.alias("due"))
    return sums.select("l_orderkey", stats.completion(F.col("done"), F.col("due")).alias("completion_view"),
                       stats.completion(F.col("done"), F.col("due"), 0.0).alias("completion_function"))


_sim = boost_sql("coalesce(malli, '') || ' ' || coalesce(moottori, '')", "'summit rave expedition 850 900 ace turbo'")


@query("a10_similarity_statistics", f"""
SELECT count(*) AS total_matches, count(*) FILTER (s >= 0.15) AS successful_matches,
 round(count(*) FILTER (s >= 0.15) / count(*) * 100, 6) AS success_rate, round(avg(s), 6) AS avg_similarity,
 round(coalesce(avg(s) FILTER (s >= 0.15), 0), 6) AS avg_successful_similarity, round(min(s), 6) AS min_similarity,
 round(max(s), 6) AS max_similarity FROM (SELECT {_sim} AS s FROM ({P}) p) q""")
def _(t):
    from catalign.functions.similarity import domain_boost
    left = F.concat(F.coalesce("malli", F.lit("")), F.lit(" "), F.coalesce("moottori", F.lit("")))
    scored = t.select(PRODUCTS).select(domain_boost(left, F.lit("summit rave expedition 850 900 ace turbo")).alias("s"))
    out = stats.similarity_statistics(scored, "s", F.col("s") >= 0.15)
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c not in ("total_matches", "successful_matches")})


@query("a13_stage_stats", f"""
SELECT stage, count(*) AS total_processed, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed,
 round(count(*) FILTER (success) / count(*) * 100, 6) AS success_rate, round(100 - count(*) FILTER (success) / count(*) * 100, 6) AS failure_rate
FROM ({R}) r GROUP BY 1""")
def _(t):
    out = stats.stage_stats(t.select(RUN_LOG), "stage", F.col("success"))
    return out.withColumns({"success_rate": F.round("success_rate", 6), "failure_rate": F.round("failure_rate", 6)})


@query("a14_operation_timing", f"""
SELECT a.stage, a.count, round(avg(duration_ms), 4) AS avg_ms, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, round(sum(duration_ms), 4) AS total_ms
FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, run_id DESC) AS rn FROM ({R}) r) l
JOIN (SELECT stage, count(*) AS count FROM ({R}) r GROUP BY 1) a ON a.stage = l.stage WHERE rn <= 100 GROUP BY 1, 2""")
def _(t):
    out = stats.operation_timing(t.select(RUN_LOG), "stage", "duration_ms", ["ts", "run_id"])
    return out.withColumns({"avg_ms": F.round("avg_ms", 4), "total_ms": F.round("total_ms", 4)})


@query("a15_job_statistics", """
SELECT count(*) AS total_jobs, count(*) FILTER (o_orderstatus = 'F') AS completed_jobs, count(*) FILTER (o_orderstatus = 'P') AS failed_jobs,
 count(*) FILTER (o_orderstatus = 'O') AS active_jobs, round(count(*) FILTER (o_orderstatus = 'F') / greatest(1, count(*)), 6) AS success_rate,
 CAST(sum(n) AS BIGINT) AS total_items, CAST(sum(good) AS BIGINT) AS successful_items, CAST(sum(n - good) AS BIGINT) AS failed_items,
 round(sum(good) / greatest(1, sum(n)), 6) AS item_success_rate, round(avg(CASE WHEN o_orderstatus <> 'O' THEN days * 1.0 END), 4) AS average_job_seconds
FROM (SELECT o_orderstatus, o_orderkey, count(l_orderkey) AS n, count(*) FILTER (l_linestatus = 'F') AS good,
 max(epoch(l_shipdate) - epoch(o_orderdate)) AS days FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) j""")
def _(t):
    seconds = (clock.micros(F.col("l_shipdate")) - clock.micros(F.col("o_orderdate"))) / 1000000
    jobs = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("o_orderkey", "o_orderstatus").agg(
        F.count("l_orderkey").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("good"), F.max(seconds).alias("seconds"))
    state = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("processing")
    jobs = jobs.withColumns({"status": state, "bad": F.col("n") - F.col("good")})
    out = stats.job_statistics(jobs, "status", "n", "good", "bad", F.when(F.col("status") != "processing", F.col("seconds")))
    return out.withColumns({"success_rate": F.round("success_rate", 6), "item_success_rate": F.round("item_success_rate", 6),
                            "average_job_seconds": F.round("average_job_seconds", 4)})


_daily = f"""SELECT CAST(ts AS DATE) AS day, count(*) AS processed, count(*) FILTER (event_type = 'purchase') AS validated,
 sum(duration_ms) AS seconds, count(*) FILTER (NOT success) * 5 < count(*) AS success FROM ({R}) r GROUP BY 1"""


@query("a16_recent_runs", f"""
WITH d AS ({_daily}), l AS (SELECT * FROM d ORDER BY day DESC LIMIT 10)
SELECT (SELECT count(*) FROM d) AS total_executions, (SELECT count(*) FROM d WHERE success) AS successful_executions,
 round((SELECT count(*) FROM d WHERE success) / (SELECT count(*) FROM d) * 100, 6) AS success_rate,
 round(sum(seconds) / count(*), 4) AS average_processing_time, round(sum(processed) / count(*), 6) AS average_products_processed,
 round(sum(validated / processed * 100) / count(*), 6) AS average_validation_rate, count(*) AS recent_executions FROM l""")
def _(t):
    daily = t.select(RUN_LOG).groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("processed"), F.count_if(F.col("event_type") == "purchase").alias("validated"),
        F.sum("duration_ms").alias("seconds"), (F.count_if(~F.col("success")) * 5 < F.count("*")).alias("success"))
    out = stats.recent_runs(daily, ["day"])
    return out.withColumns({"success_rate": F.round("success_rate", 6), "average_processing_time": F.round("average_processing_time", 4),
                            "average_products_processed": F.round("average_products_processed", 6),
                            "average_validation_rate": F.round("average_validation_rate", 6)})


@query("a17_weighted_confidence", f"""
SELECT entry_id, round(c * 0.3 + (1 - c) * 0.2 + c * c * 0.2 + 0.5 * 0.1 + c * 0.2, 6) AS overall,
 CASE WHEN c * 0.3 + (1 - c) * 0.2 + c * c * 0.2 + 0.5 * 0.1 + c * 0.2 >= 0.5 THEN 'up' ELSE 'down' END AS side
FROM (SELECT entry_id, extraction_confidence AS c FROM ({E}) e) x""")
def _(t):
    c = F.col("extraction_confidence")
    scores = dict(zip([s for s, _ in fixed.STAGE_WEIGHTS], [c, 1 - c, c * c, F.lit(0.5), c]))
    total = stats.weighted_confidence(scores, fixed.STAGE_WEIGHTS)
    return t.select(ENTRIES).select("entry_id", F.round(total, 6).alias("overall"),
                                    F.when(total >= 0.5, "up").otherwise("down").alias("side"))


@query("a19_population_metrics", f"""
WITH m AS (SELECT stage, CAST(count(*) AS DOUBLE) AS n, count(*) FILTER (success) AS good, sum(duration_ms) AS ms, avg(conf) AS conf,
  count(*) FILTER (conf >= 0.95) AS auto, sum(duration_ms) / 1000 AS cost, CAST(sum(user_id) AS DOUBLE) AS calls
 FROM (SELECT *, (run_id % 101) / 100 AS conf FROM ({R}) r) x GROUP BY 1)
SELECT stage, 'sample_size' AS metric_name, round(n, 4) AS measured_value FROM m
UNION ALL SELECT stage, 'processing_speed_products_per_minute', round(good * 60000.0 / ms, 4) FROM m
UNION ALL SELECT stage, 'pipeline_success_rate', round(good / n, 4) FROM m
UNION ALL SELECT stage, 'average_confidence_score', round(conf, 4) FROM m
UNION ALL SELECT stage, 'auto_acceptance_rate', round(auto / n, 4) FROM m
UNION ALL SELECT stage, 'cost_per_product_usd', round(cost / good, 4) FROM m
UNION ALL SELECT stage, 'api_calls_per_product', round(calls / good, 4) FROM m""")
def _(t):
    runs = t.select(RUN_LOG).withColumns({"confidence": (F.col("run_id") % 101) / 100, "cost": F.col("duration_ms") / 1000,
                                          "calls": F.col("user_id").cast("double")})
    return stats.population_metrics(runs, ["stage"]).withColumn("measured_value", F.round("measured_value", 4))


@query("a20_threshold_violations", f"""
SELECT stage, round(avg(CAST(success AS DOUBLE)), 6) AS success_rate FROM ({R}) r GROUP BY 1 HAVING avg(CAST(success AS DOUBLE)) < 0.95""")
def _(t):
    rates = stats.success_rates(t.select(RUN_LOG), "stage", F.col("success"))
    return stats.below(rates, "success_rate", 0.95).select("stage", F.round("success_rate", 6).alias("success_rate"))


@query("a20_slow_stages", f"""
SELECT stage, max(duration_ms) AS max_ms, CAST(CASE stage WHEN 'base_model_matching' THEN 3000.0 WHEN 'final_validation' THEN 5000.0 END AS DOUBLE) AS "limit"
FROM ({R}) r GROUP BY 1 HAVING max(duration_ms) > CASE stage WHEN 'base_model_matching' THEN 3000.0 WHEN 'final_validation' THEN 5000.0 END""")
def _(t):
    worst = t.select(RUN_LOG).groupBy("stage").agg(F.max("duration_ms").alias("max_ms"))
    return stats.over_limit(worst, "stage", "max_ms", {"base_model_matching": 3000.0, "final_validation": 5000.0})


@query("a21_duplicate_keys", f"""
SELECT model_code, brand, model_year, count(*) AS count FROM ({E}) e GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _(t):
    return stats.duplicate_keys(t.select(ENTRIES), ["model_code", "brand", "model_year"])


@query("a21_data_quality", f"""
SELECT count(*) FILTER (model_year < 2015 OR model_year > 2030) AS invalid_years, count(*) FILTER (coalesce(brand, '') = '') AS empty_brand,
 count(*) FILTER (coalesce(malli, '') = '') AS empty_malli FROM ({P}) p""")
def _(t):
    return stats.data_quality(t.select(PRODUCTS), "model_year", ["brand", "malli"])


@query("a23_parser_success", """
SELECT o_orderpriority AS parser, round(avg(CAST(o_orderstatus <> 'P' AS DOUBLE)), 6) AS success_rate, count(*) AS documents FROM orders GROUP BY 1""")
def _(t):
    return stats.success_rates(t.orders.withColumnRenamed("o_orderpriority", "parser"), "parser", F.col("o_orderstatus") != "P").withColumn(
        "success_rate", F.round("success_rate", 6))


@query("a24_option_usage", """
SELECT p_name, count(*) AS times_applied, round(avg(CAST(p_size > 10 AS DOUBLE)), 6) AS success_rate, round(avg(p_retailprice) / 1000, 6) AS effectiveness,
 avg(p_retailprice / 1000) >= 0.95 AS validated FROM part GROUP BY 1""")
def _(t):
    shaped = t.part.withColumn("score", F.col("p_retailprice") / 1000)
    return stats.option_usage(shaped, "p_name", F.col("p_size") > 10, "score", 0.95).withColumns(
        {"success_rate": F.round("success_rate", 6), "effectiveness": F.round("effectiveness", 6)})


@query("a25_report_summary", """
SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS failed, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_started,
 strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_started, round(count(*) FILTER (event_type = 'error') / count(*) * 100, 6) AS failure_rate FROM events""")
def _(t):
    out = stats.report_summary(t.events, "event_type", "ts")
    return out.withColumns({"first_started": F.date_format("first_started", "yyyy-MM-dd HH:mm:ss"),
                            "last_started": F.date_format("last_started", "yyyy-MM-dd HH:mm:ss"),
                            "failure_rate": F.round("failure_rate", 6)})


@query("a26_distinct_brands", f"SELECT DISTINCT brand FROM ({B}) b")
def _(t):
    return t.select(BASE_MODELS).select("brand").distinct().orderBy("brand")


@query("a26_distinct_years", f"SELECT DISTINCT model_year FROM ({B}) b")
def _(t):
    return t.select(BASE_MODELS).select("model_year").distinct().orderBy(F.desc("model_year"))


@query("a26_model_count", f"SELECT count(*) AS models FROM ({B}) b")
def _(t):
    return t.select(BASE_MODELS).agg(F.count("*").alias("models"))


TYPES = ["STANDARD", "PROMO", "LARGE", "ECONOMY", "MEDIUM", "SMALL"]


@query("a27_spec_pivot", f"""
WITH s AS (SELECT p_type, CAST(max(p_size) AS VARCHAR) AS size, CAST(count(DISTINCT p_brand) AS VARCHAR) AS brands,
  CASE WHEN p_type <> 'PROMO' THEN min(p_name) END AS name FROM part GROUP BY 1)
{' UNION ALL '.join("SELECT '" + f + "' AS specification, " + ', '.join(f"coalesce(max({f}) FILTER (p_type = '{x}'), '—') AS {chr(34)}{x}{chr(34)}" for x in TYPES) + ' FROM s' for f in ('size', 'brands', 'name'))}""")
def _(t):
    specs = t.part.groupBy("p_type").agg(
        F.max("p_size").alias("size"), F.countDistinct("p_brand").alias("brands"), F.min("p_name").alias("name")).withColumn(
        "name", F.when(F.col("p_type") != "PROMO", F.col("name")))
    return stats.spec_pivot(specs, "p_type", ["size", "brands", "name"], TYPES)


@query("a28_usage_statistics", """
SELECT CAST(sum(floor(length(text) / 4)) AS BIGINT) AS total_tokens, round(sum(floor(length(text) / 4)) * 0.25 / 1000000, 6) AS total_cost,
 round(sum(floor(length(text) / 4)) * 0.25 / 1000000 / greatest(1, floor(sum(floor(length(text) / 4)) / 1000)), 9) AS average_cost_per_request FROM conversations""")
def _(t):
    used = t.conversations.select(text.token_estimate(F.col("text")).alias("tokens"))
    used = used.withColumn("cost", prices.usage_cost(F.col("tokens"), F.lit(0)))
    return stats.usage_statistics(used, "tokens", "cost").withColumns(
        {"total_cost": F.round("total_cost", 6), "average_cost_per_request": F.round("average_cost_per_request", 9)})


@query("a29_tokens_per_minute", """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, CAST(sum(floor(value)) AS BIGINT) AS tokens, sum(floor(value)) > 100 AS over_limit FROM events GROUP BY 1""")
def _(t):
    return stats.tokens_per_minute(t.events, "ts", F.floor("value"), 100).withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))
