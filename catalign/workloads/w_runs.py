"""Sources, sinks, history, composite plans, streams and extension points."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import clock, registered, text
from catalign.operators import history, keep, scans
from catalign.plans import enrichment, feed, training
from catalign.session import shared_dir
from catalign.sources import documents, extractors, files, keyed, sinks
from catalign.streaming import monitors, timings
from catalign.workloads import query
from catalign.workloads.standins import BASE_MODELS, ENTRIES, PRODUCTS, RUN_LOG, plain
from catalign.workloads.w_joins import REGISTRY
from catalign.workloads.w_specbook import cells
from catalign.workloads.w_matching import text_catalog

E, P, B, R = plain(ENTRIES), plain(PRODUCTS), plain(BASE_MODELS), plain(RUN_LOG)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


# --- sources -------------------------------------------------------------------------------------------
@query("s01_discovered_files")
def _(t):
    return files.price_list_files(files.discover(t.spark, t.folder, "*.parquet")).select("name", "length", "brand", "year")


@query("s02_checked_files")
def _(t):
    return files.checked(files.discover(t.spark, t.folder, "*.parquet"), 1000000).select("name", "length", "reject_reason")


@query("s02_size_check", """
SELECT doc_id, CASE WHEN n_chars = 0 THEN 'empty file' WHEN n_chars > 5000 THEN 'file too large' END AS reject_reason FROM documents""")
def _(t):
    return files.checked(t.documents.select("doc_id", F.col("n_chars").alias("length")), 5000).select("doc_id", "reject_reason")


@query("s08_price_entries", f"""
SELECT entry_id, model_code, price, model_year, CASE WHEN model_year < 2020 THEN 'year out of range' END AS problem FROM ({E}) e""")
def _(t):
    rows = t.select(ENTRIES)
    as_text = rows.select("entry_id", F.to_json(F.struct("model_code", "brand", "price", "model_year", "page_number")).alias("j"))
    read = as_text.select("entry_id", documents.parsed(F.col("j"), documents.ENTRY).alias("r")).select("entry_id", "r.*")
    problem = documents.entry_problem(F.col("model_code"), F.col("model_year"), F.col("page_number"), F.col("price"))
    return read.select("entry_id", "model_code", "price", "model_year", problem.alias("problem"))


@query("s08_quarantined_products", f"""
SELECT product_id, CASE WHEN coalesce(length(model_code), 0) <> 4 THEN 'code is not 4 characters' ELSE 'year out of range' END AS problem FROM ({P}) p
WHERE coalesce(length(model_code), 0) <> 4 OR model_year NOT BETWEEN 2015 AND 2030""")
def _(t):
    rows = t.select(PRODUCTS).withColumn("problem", documents.product_problem(F.col("model_code"), F.col("model_year")))
    return rows.filter(F.col("problem").isNotNull()).select("product_id", "problem")


@query("s09_report_rows", "SELECT event_id AS id, event_type AS status FROM events")
def _(t):
    doc = F.concat(F.lit('{"reports_list":{"reports":['), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("status"))), F.lit("]}}"))
    read = t.events.select(documents.parsed(doc, documents.REPORTS).alias("d")).select("d.*")
    return documents.report_rows(read).select("id", "status")


@query("s10_whitelist_rows", "SELECT p_partkey, CAST(i AS INT) AS position, CASE i WHEN 0 THEN p_name ELSE p_brand END AS name FROM part CROSS JOIN (VALUES (0), (1)) v(i)")
def _(t):
    read = t.part.select("p_partkey", F.from_json(F.to_json(F.struct(F.array("p_name", "p_brand").alias("brp_models"))), "brp_models array<string>").alias("d"))
    return read.select("p_partkey", F.posexplode("d.brp_models").alias("position", "name"))


@query("s11_constraint_rows", """
SELECT event_type AS tag, user_id % 2 = 0 AS required, CASE WHEN user_id % 3 = 0 THEN 'text' ELSE 'number' END AS type, 'url|range' AS hints, count(*) AS n FROM events GROUP BY 1, 2, 3""")
def _(t):
    kind = F.when(F.col("user_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("number"))
    doc = F.to_json(F.struct(F.array(F.struct(F.col("event_type").alias("tag"), F.lit("a link from here").alias("descriptions"), F.array(F.struct(
        (F.col("user_id") % 2 == 0).alias("required"), kind.alias("field_type"))).alias("content"))).alias("fields")))
    rows = documents.constraint_rows(t.events.select(documents.parsed(doc, documents.CONSTRAINTS).alias("d")).select("d.*"))
    return rows.groupBy("tag", "required", "type", F.array_join("hints", "|").alias("hints")).agg(F.count("*").alias("n"))


@query("s12_schedule_rows", """
SELECT p_partkey, CAST(p_size AS INT) AS rate, CAST(w AS INT) AS weekday, CAST(h AS INT) AS hour FROM part CROSS JOIN (VALUES (0), (3)) a(w) CROSS JOIN (VALUES (10), (14), (18)) b(h)""")
def _(t):
    doc = F.concat(F.lit('{"schedule":[{"rate":'), F.col("p_size").cast("string"), F.lit(',"weekdays":[0,3],"time_slots":[18,10,14]}]}'))
    read = t.part.select("p_partkey", documents.parsed(doc, documents.SCHEDULE).alias("d")).select("p_partkey", "d.*")
    return documents.schedule_rows(read, keys=("p_partkey",))


# --- sinks ---------------------------------------------------------------------------------------------
@query("w02_keep_last", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def _(t):
    return keep.keep_last(t.events, ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id", "value")


@query("k01_upsert", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY fresh DESC, event_id DESC) AS rn FROM (
 SELECT user_id, event_id, event_type, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS fresh FROM events) x) y WHERE rn = 1""")
def _(t):
    rows = t.events.select("user_id", "event_id", "event_type")
    new = F.col("event_type") == "purchase"
    path = shared_dir(t.spark, "upsert")
    sinks.append_rows(keep.keep_last(rows.filter(~new), ["user_id"], ["event_id"]), path)
    sinks.upsert_table(rows.filter(new), path, path + "-next", ["user_id"], ["event_id"])
    return t.spark.read.parquet(path + "-next")


@query("k01_keyed_upsert", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY fresh DESC, event_id DESC) AS rn FROM (
 SELECT user_id, event_id, event_type, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS fresh FROM events) x) y WHERE rn = 1""")
def _(t):
    rows = t.events.select("user_id", "event_id", "event_type")
    new = F.col("event_type") == "purchase"
    path = shared_dir(t.spark, "keyed")
    keyed.create(rows.filter(~new), path, ["user_id"], ["event_id"], 16)
    keyed.upsert(rows.filter(new), path, ["event_id"])
    return keyed.read(t.spark, path)


@query("k02_result_rows", f"SELECT run_id, '[\"' || stage || '\"]' AS errors, success FROM ({R}) r")
def _(t):
    path = shared_dir(t.spark, "results")
    rows = t.select(RUN_LOG).select("run_id", F.array("stage").alias("errors"), "success")
    sinks.append_results(rows, path, ["errors"])
    return t.spark.read.parquet(path)


@query("k03_update_with_audit", """
SELECT event_id, round(coalesce(n.c, 0.5), 6) AS overall_confidence, CASE WHEN coalesce(n.c, 0.5) >= 0.9 THEN 'high' WHEN coalesce(n.c, 0.5) >= 0.7 THEN 'medium' ELSE 'low' END AS confidence_level
FROM events LEFT JOIN (SELECT event_id AS id, CAST(least(1.0, value / 100) AS DOUBLE) AS c FROM events WHERE event_type = 'click') n ON n.id = event_id""")
def _(t):
    products = t.events.select("event_id", F.lit(0.5).alias("overall_confidence"))
    news = t.events.filter(F.col("event_type") == "click").select(
        "event_id", F.least(F.lit(1.0), F.col("value") / 100).alias("new_confidence"), F.lit("final_validation").alias("stage"))
    fresh, _audit = history.update_confidence(products, news, "event_id")
    return fresh.select("event_id", F.round("overall_confidence", 6).alias("overall_confidence"), "confidence_level")


@query("k03_audit_rows", """
SELECT event_id, 'confidence_updated' AS action, '{"confidence":0.5}' AS before_data, round(CAST(least(1.0, value / 100) AS DOUBLE) - 0.5, 6) AS confidence_change FROM events WHERE event_type = 'click'""")
def _(t):
    products = t.events.select("event_id", F.lit(0.5).alias("overall_confidence"))
    news = t.events.filter(F.col("event_type") == "click").select(
        "event_id", F.least(F.lit(1.0), F.col("value") / 100).alias("new_confidence"), F.lit("final_validation").alias("stage"))
    _fresh, audit = history.update_confidence(products, news, "event_id")
    return audit.select("event_id", "action", "before_data", F.round("confidence_change", 6).alias("confidence_change"))


@query("k04_retention", """
SELECT 'events' AS table_name, count(*) FILTER (ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY) AS deleted, count(*) FILTER (ts >= TIMESTAMP '2024-01-31' - INTERVAL 14 DAY) AS kept FROM events
UNION ALL SELECT 'errors', count(*) FILTER (ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY), count(*) FILTER (ts >= TIMESTAMP '2024-01-31' - INTERVAL 14 DAY) FROM events WHERE event_type = 'error'""")
def _(t):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    both = [("events", t.events), ("errors", t.events.filter(F.col("event_type") == "error"))]
    first, second = (history.retention_counts(df, name, "ts", as_of, 14) for name, df in both)
    return first.unionByName(second)


@query("k04_keyed_retention", """
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) x
WHERE rn = 1 AND ts >= TIMESTAMP '2024-01-31' - INTERVAL 2 DAY""")
def _(t):
    path = shared_dir(t.spark, "keyed")
    keyed.create(t.events.select("user_id", "event_id", "ts"), path, ["user_id"], ["event_id"], 16)
    keyed.retain(t.spark, path, "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), 2)
    return keyed.read(t.spark, path).select("user_id", "event_id")


@query("k05_feed_rows", f"""
SELECT product_id, '<Ad> <Id>' || product_id || '</Id> <Year>' || model_year || '</Year> </Ad>' AS xml FROM ({P}) p""")
def _(t):
    xml = sinks.listing_xml({"Id": F.col("product_id"), "Year": F.col("model_year")})
    return t.select(PRODUCTS).select("product_id", F.trim(F.regexp_replace(xml, r"\s+", " ")).alias("xml"))


@query("v16_well_formed", """
SELECT event_id, event_type <> 'error' AS well_formed FROM events""")
def _(t):
    xml = F.concat(F.lit("<Ad><Id>"), F.col("event_id").cast("string"), F.when(F.col("event_type") == "error", "</Ad>").otherwise("</Id></Ad>"))
    return t.events.select("event_id", sinks.well_formed(xml, "Id STRING").alias("well_formed"))


@query("k06_split_files", """
SELECT CASE WHEN doc_id % 100 < 80 THEN 'train' WHEN doc_id % 100 < 90 THEN 'validation' ELSE 'test' END AS split, count(*) AS rows FROM documents GROUP BY 1""")
def _(t):
    path = shared_dir(t.spark, "splits")
    sinks.write_splits(t.documents.select("doc_id", "lang", training.split_name(F.col("doc_id")).alias("split")), path)
    return t.spark.read.schema("doc_id long, lang string, split string").json(path).groupBy("split").agg(F.count("*").alias("rows"))


@query("k08_report_export", f"SELECT stage, count(*) AS runs FROM ({R}) r GROUP BY 1")
def _(t):
    path = shared_dir(t.spark, "report")
    sinks.write_report(t.select(RUN_LOG).groupBy("stage").agg(F.count("*").alias("runs")), path, "csv")
    return t.spark.read.schema("stage string, runs long").option("header", True).csv(path)


@query("k09_delete_keys", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)")
def _(t):
    gone = t.lineitem.filter(F.col("l_quantity") > 48).select(F.col("l_partkey").alias("p_partkey"))
    return keep.delete_keys(t.part, gone, ["p_partkey"]).select("p_partkey")


# --- history -------------------------------------------------------------------------------------------
@query("w04_most_recent", """
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1""")
def _(t):
    return history.latest(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("w08_batches", """
SELECT conv_id, turn, CAST(floor((row_number() OVER (ORDER BY conv_id, turn) - 1) / 5) AS BIGINT) AS batch_no FROM conversations""")
def _(t):
    return scans.batches(t.conversations.select("conv_id", "turn"), ["conv_id", "turn"], 5)


@query("w09_confidence_change", """
SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS confidence_change FROM events""")
def _(t):
    out = history.confidence_changes(t.events, "user_id", ["ts", "event_id"], "value", "ts")
    return out.select("event_id", F.round("confidence_change", 6).alias("confidence_change"))


@query("w10_upload_history", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def _(t):
    return history.upload_history(t.events, ["ts", "event_id"], 50).select("event_id")


@query("w10_pending_uploads", """
SELECT event_id FROM (SELECT *, coalesce(CASE WHEN d + INTERVAL 3 HOUR > ts THEN d + INTERVAL 3 HOUR END, CASE WHEN d + INTERVAL 11 HOUR > ts THEN d + INTERVAL 11 HOUR END,
  CASE WHEN d + INTERVAL 19 HOUR > ts THEN d + INTERVAL 19 HOUR END, d + INTERVAL 27 HOUR) + INTERVAL 60 MINUTE AS due FROM (SELECT *, date_trunc('day', ts) AS d FROM events) x) y
WHERE event_type <> 'error' AND due > TIMESTAMP '2024-01-20 10:00:00'""")
def _(t):
    as_of = F.lit("2024-01-20 10:00:00").cast("timestamp_ntz")
    return history.pending_uploads(t.events, "ts", F.col("event_type") != "error", as_of).select("event_id")


# --- composite plans -----------------------------------------------------------------------------------
@query("t08_marketplace_feed")
def _(t):
    catalog = text_catalog(t)
    made = feed.feed(cells(t), catalog, F.lit("SKI-DOO"), F.lit(2026))
    return made.select("doc", "product_no", "listing_id", "title", "roubles", "matched", F.round("score", 6).alias("score"), "xml")


@query("t08_listed_products", f"""
SELECT product_id, brand || '_' || model_code || '_' || model_year AS listing_id, CASE WHEN price > 0 THEN CAST(round_even(CASE WHEN currency = 'EUR' THEN price * 100 ELSE price END, 0) AS BIGINT) END AS roubles FROM ({P}) p
WHERE regexp_matches(model_code, '^[A-Z]{{4}}$') AND brand IN ('BRP', 'LYNX', 'SKI-DOO') AND model_year BETWEEN 2015 AND 2030
 AND (price IS NULL OR (currency IN ('EUR', 'RUB') AND price <= 10000000 AND price > 0 AND CASE WHEN currency = 'EUR' THEN price * 100 ELSE price END BETWEEN 100000 AND 10000000))""")
def _(t):
    made = feed.listings(feed.validate_products(t.select(PRODUCTS), "rub"))
    return made.select("product_id", "listing_id", "roubles")


@query("t10_extraction_run", """
WITH f AS (SELECT DISTINCT source AS file_name FROM documents), a AS (SELECT source, count(*) AS n FROM documents WHERE n_chars > 25000 GROUP BY 1), b AS (SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY 1)
SELECT file_name, CASE WHEN a.n > 0 THEN 'page_by_page' WHEN b.n > 0 THEN 'camelot_stream' END AS extraction_method, coalesce(a.n, b.n, 0) AS articles_count,
 CASE WHEN coalesce(a.n, b.n, 0) > 0 THEN 'completed' ELSE 'failed' END AS status FROM f LEFT JOIN a ON a.source = file_name LEFT JOIN b ON b.source = file_name WHERE file_name NOT IN ('src1', 'src2')""")
def _(t):
    docs = t.documents.withColumnRenamed("source", "file_name")
    log = docs.filter(F.col("file_name").isin("src1", "src2")).select("file_name")
    _rows, run = feed.extraction_run(docs.select("file_name").distinct(), log, [
        ("page_by_page", docs.filter(F.col("n_chars") > 25000).select("file_name", "doc_id")),
        ("camelot_stream", docs.filter(F.col("lang") == "en").select("file_name", "doc_id"))])
    return run.select("file_name", "extraction_method", "articles_count", "status")


@query("t10_extracted_rows", """
WITH n AS (SELECT source, count(*) FILTER (n_chars > 25000) AS a FROM documents GROUP BY 1)
SELECT source AS file_name, doc_id FROM documents JOIN n USING (source) WHERE source NOT IN ('src1', 'src2') AND CASE WHEN n.a > 0 THEN n_chars > 25000 ELSE lang = 'en' END""")
def _(t):
    """The rows that the run yields: each file's, from its winning method only."""
    docs = t.documents.withColumnRenamed("source", "file_name")
    log = docs.filter(F.col("file_name").isin("src1", "src2")).select("file_name")
    rows, _run = feed.extraction_run(docs.select("file_name").distinct(), log, [
        ("page_by_page", docs.filter(F.col("n_chars") > 25000).select("file_name", "doc_id")),
        ("camelot_stream", docs.filter(F.col("lang") == "en").select("file_name", "doc_id"))])
    return rows.select("file_name", "doc_id")


_reg = " UNION ALL ".join(f"SELECT {i} AS position, '{n}' AS name, {'NULL' if b is None else repr(b)} AS b, {'NULL' if f is None else repr(f)} AS f" for i, n, b, f in REGISTRY)
_steps = f"""
WITH e AS (SELECT product_id, brand, malli AS family, moottori AS engine, coalesce(paketti, '') AS options, brand || '_' || replace(malli, ' ', '_') || '_' || model_year AS k FROM ({P}) p WHERE malli IS NOT NULL),
 m AS (SELECT k, min(product_id) AS base_id FROM e WHERE trim(options) = '' GROUP BY 1),
 o AS (SELECT DISTINCT options, brand, family FROM e WHERE trim(options) <> ''),
 h AS (SELECT o.*, list(r.name ORDER BY position) FILTER (r.name IS NOT NULL) AS names FROM o LEFT JOIN ({_reg}) r ON (r.b IS NULL OR r.b = o.brand) AND (r.f IS NULL OR r.f = o.family) AND contains(lower(o.options), lower(r.name)) GROUP BY ALL),
 r AS (SELECT options, brand, family, trim(regexp_replace(list_reduce(list_concat([lower(options)], coalesce(names, [])), lambda a, n: replace(a, lower(n), '')), '[\\s,;]+', ' ', 'g')) AS rest FROM h),
 s AS (SELECT e.product_id, m.base_id, greatest(0.0, CASE WHEN m.base_id IS NULL THEN 0.0 ELSE 0.98 END - CASE WHEN m.base_id IS NOT NULL AND coalesce(e.engine, '') = '900 ACE' THEN 0 ELSE 0.1 END
   - CASE WHEN coalesce(r.rest, '') <> '' THEN 0.05 ELSE 0 END)::DOUBLE AS score FROM e LEFT JOIN m ON m.k = e.k LEFT JOIN r ON r.options = e.options AND r.brand = e.brand AND r.family = e.family)
SELECT product_id AS entry_id, CASE WHEN base_id IS NULL THEN 'semantic' ELSE 'exact_lookup' END AS processing_method, round(score, 6) AS final_score,
 CASE WHEN base_id IS NULL THEN 'requires_review' WHEN score < 0.85 THEN 'failed' ELSE 'passed' END AS validation_status, base_id IS NOT NULL AND score >= 0.95 AS auto_accepted FROM s"""


@query("t11_documented_steps", _steps)
def _(t):
    rows = t.select(PRODUCTS).filter(F.col("malli").isNotNull()).select(
        F.col("product_id").alias("entry_id"), "brand", F.col("malli").alias("model_family"), "model_year", F.col("moottori").alias("engine"),
        F.coalesce("paketti", F.lit("")).alias("options_text"))
    models = rows.filter(F.trim("options_text") == "").groupBy(text.lookup_key(F.col("brand"), F.col("model_family"), F.col("model_year")).alias("lookup_key")).agg(
        F.min("entry_id").alias("base_model_id"))
    engines = models.select("base_model_id", F.lit("900 ACE").alias("engine"), F.lit(899).alias("displacement"))
    registry = t.spark.createDataFrame(REGISTRY, "position long, name string, brand string, family string")
    done = feed.documented_steps(rows, models, engines, registry)
    return done.select("entry_id", "processing_method", F.round("final_score", 6).alias("final_score"), "validation_status", "auto_accepted")


FILES = ["LYNX 2026 SPEC BOOK.pdf", "SKI-DOO_2025-PRICE_LIST.pdf", "notes.pdf"]
EXAMPLES = f"""
SELECT doc_id, i AS example_no, doc_type, CASE WHEN doc_type = 'price_list' THEN 'Extract all model names and prices from this ' || brand || ' ' || year || ' price list:'
  WHEN i = 0 THEN 'Extract all snowmobile model information from this ' || brand || ' ' || year || ' specification page:' ELSE 'List all technical specifications with their values:' END AS instruction, text
FROM (SELECT doc_id, trim(regexp_replace(text, '\\n\\s*\\n', chr(10) || chr(10), 'g')) AS text, CASE WHEN doc_id % 3 = 0 THEN 'spec_book' ELSE 'price_list' END AS doc_type, CASE WHEN doc_id % 3 = 0 THEN 'LYNX' ELSE 'SKIDOO' END AS brand,
  CASE doc_id % 3 WHEN 0 THEN '2026' WHEN 1 THEN '2025' ELSE 'unknown' END AS year FROM documents) d CROSS JOIN (VALUES (0), (1)) v(i) WHERE length(text) > 50 AND (i = 0 OR doc_type = 'spec_book')"""


def examples(t):
    names = F.element_at(F.array(*[F.lit(f) for f in FILES]), (F.col("doc_id") % 3 + 1).cast("int"))
    return training.instruction_rows(t.documents.select("doc_id", "text").withColumn("file", names))


@query("f32_instruction_messages", f"SELECT doc_id, example_no, instruction || chr(10) || chr(10) || text AS user_content FROM ({EXAMPLES}) e")
def _(t):
    return examples(t).select("doc_id", "example_no", F.get("messages", F.lit(0))["content"].alias("user_content"))


@query("f31_split_names", """
SELECT doc_id, CASE WHEN doc_id % 100 < 80 THEN 'train' WHEN doc_id % 100 < 90 THEN 'validation' ELSE 'test' END AS split FROM documents""")
def _(t):
    return t.documents.select("doc_id", training.split_name(F.col("doc_id")).alias("split"))


@query("t12_training_set", f"""
SELECT doc_type, CASE WHEN doc_id % 100 < 80 THEN 'train' WHEN doc_id % 100 < 90 THEN 'validation' ELSE 'test' END AS split, count(*) AS examples FROM ({EXAMPLES}) e GROUP BY 1, 2""")
def _(t):
    return examples(t).groupBy("doc_type", training.split_name(F.col("doc_id")).alias("split")).agg(F.count("*").alias("examples"))


_numbered = """SELECT *, CAST(floor((row_number() OVER (ORDER BY conv_id, turn) - 1) / 5) AS BIGINT) AS batch_no FROM conversations"""
_prompts = f"""SELECT batch_no, CAST(count(*) AS INT) AS expected, 'Batch Snowmobile Product Enrichment - complete' || chr(10) || chr(10) || 'Process the following ' || count(*) || ' products:' || chr(10) || chr(10) ||
 string_agg('Product ' || rn || ':' || chr(10) || '- Model Code: ' || role || chr(10) || '- Brand: ' || role || chr(10) || '- Specifications: ' || text, chr(10) || chr(10) ORDER BY rn) || chr(10) || chr(10) ||
 'Task: Perform complete enrichment for each product.' || chr(10) || chr(10) || 'Respond with JSON array containing results for each product in order.' AS prompt
 FROM (SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY conv_id, turn) AS rn FROM ({_numbered}) n) m GROUP BY 1"""


@query("t13_batch_requests", f"""
SELECT batch_no, expected, CAST(floor(length(prompt) / 4) AS BIGINT) + 2000 AS tokens, CAST((floor(length(prompt) / 4) + 2000) * 0.25 / 1000000 AS DECIMAL(18,8)) AS estimated_cost, prompt FROM ({_prompts}) p""")
def _(t):
    return enrichment.batch_requests(t.conversations, ["conv_id", "turn"], "role", "role", "text").select(
        "batch_no", "expected", "tokens", "estimated_cost", "prompt")


@query("t13_matching_prompts", f"""
SELECT e.entry_id, CASE WHEN l.lines IS NULL THEN 0 ELSE length(l.lines) END + length('Snowmobile Base Model Matching Task:' || chr(10) || '- Model Code: ' || model_code || chr(10) || '- Brand: ' || e.brand || chr(10) || '- Model Year: ' || e.model_year || chr(10) || '- Price: ' || price || ' ' || currency || chr(10) || 'Available Base Models:' || chr(10)) AS n_chars
FROM ({E}) e LEFT JOIN (SELECT brand, model_year, string_agg(rn || '. ' || base_model_id || ' - ' || model_name || ' | Category: ' || category || ' | Engine: ' || coalesce(displacement, 'N/A'), chr(10) ORDER BY rn) AS lines FROM (
 SELECT *, row_number() OVER (PARTITION BY brand, model_year ORDER BY model_name, position) AS rn FROM ({B}) b) x WHERE rn <= 10 GROUP BY 1, 2) l ON l.brand = e.brand AND l.model_year = e.model_year""")
def _(t):
    made = enrichment.matching_prompts(t.select(ENTRIES), t.select(BASE_MODELS))
    return made.select("entry_id", F.length("prompt").cast("long").alias("n_chars"))


@query("t13_option_prompts", f"""
SELECT entry_id, 'Snowmobile Spring Options Analysis:' || chr(10) || '- Model Code: ' || model_code || chr(10) || '- Brand: ' || brand || chr(10) || '- Model Name: ' || model_name || chr(10) || '- Category: N/A' || chr(10) || 'Base Model Specifications:' || chr(10) || '{{}}' || chr(10) || 'Current Product Specifications:' || chr(10) || '{{}}' AS prompt FROM ({E}) e""")
def _(t):
    none = F.lit(None).cast("string")
    return t.select(ENTRIES).select("entry_id", enrichment.option_prompt(F.col("model_code"), F.col("brand"), F.col("model_name"), none, none, none).alias("prompt"))


@query("t13_taken_in_results", f"""
SELECT batch_no, CAST(i AS INT) AS item_no, expected = 5 AS success, expected <> 5 AS needs_single_request, CASE WHEN expected = 5 THEN 20 ELSE 0 END AS tokens
FROM (SELECT batch_no, expected, unnest(range(0, expected)) AS i FROM ({_prompts}) p) q""")
def _(t):
    asked = enrichment.batch_requests(t.conversations, ["conv_id", "turn"], "role", "role", "text").select("batch_no", "expected")
    replies = asked.select("batch_no", F.lit("[" + ",".join(['{"enrichment_result":"ok","confidence":0.9}'] * 5) + "]").alias("response"),
                           F.lit(100).alias("used_tokens"), F.lit(0.5).alias("used_cost"))
    return enrichment.take_in(asked, replies).select("batch_no", "item_no", "success", "needs_single_request", F.col("tokens").cast("int").alias("tokens"))


# --- streams -------------------------------------------------------------------------------------------
def events_stream(t):
    return monitors.file_stream(t.spark, t.folder, EVENTS, glob="events.parquet").withColumn("ts", clock.utc_instant(F.col("ts")))


@query("g01_incremental_ingest", """
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def _(t):
    path = shared_dir(t.spark, "ingest")
    monitors.ingest(events_stream(t), path + "/rows", path + "/checkpoint", ["user_id", "event_type"], ["event_id"])
    return monitors.ingested(t.spark, path + "/rows", ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


@query("g01_keyed_ingest", """
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def _(t):
    path = shared_dir(t.spark, "ingest")
    monitors.ingest_keyed(events_stream(t), path + "/rows", path + "/checkpoint", ["user_id", "event_type"], ["event_id"], 16)
    return keyed.read(t.spark, path + "/rows").select("user_id", "event_type", "event_id")


_day = "date_trunc('day', ts)"


@query("g02_error_rate_batch", f"""
SELECT strftime({_day}, '%Y-%m-%d') AS day, count(*) AS attempts, count(*) FILTER (event_type = 'error') AS errors, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate FROM events GROUP BY 1""")
def _(t):
    out = monitors.error_rates(t.events, "ts", F.col("event_type") == "error")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "attempts", "errors", F.round("error_rate", 6).alias("error_rate"))


@query("g02_error_rate_by_slot", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, CASE WHEN hour(ts) < 3 OR hour(ts) >= 19 THEN '03:00' WHEN hour(ts) < 11 THEN '11:00' ELSE '19:00' END AS slot,
 count(*) AS attempts, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2""")
def _(t):
    slot = F.substring(clock.next_window_name(F.col("ts")), 1, 5)
    out = monitors.error_rates(t.events.withColumn("slot", slot), "ts", F.col("event_type") == "error", key="slot")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "slot", "attempts", "errors")


@query("g02_error_rate_stream", f"""
SELECT strftime({_day}, '%Y-%m-%d') AS day, count(*) AS attempts, count(*) FILTER (event_type = 'error') AS errors FROM events
GROUP BY 1, {_day} HAVING {_day} + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def _(t):
    path = shared_dir(t.spark, "monitor")
    rates = monitors.error_rates(events_stream(t), "ts", F.col("event_type") == "error", late="1 hour")
    monitors.to_table(rates, path + "/rows", path + "/checkpoint")
    day = F.date_format(clock.utc_wall(F.col("window_start")), "yyyy-MM-dd")
    return t.spark.read.parquet(path + "/rows").select(day.alias("day"), "attempts", "errors")


_slots = "unnest([make_timestamp(CAST(floor(epoch(ts) / 43200) * 43200 AS BIGINT) * 1000000), make_timestamp(CAST(floor(epoch(ts) / 43200) * 43200 - 43200 AS BIGINT) * 1000000)])"
ALERTS = f"""
SELECT strftime(w, '%Y-%m-%d %H') AS window_start, event_type, count(*) AS attempts FROM (SELECT *, {_slots} AS w FROM events) x
GROUP BY w, 1, 2 HAVING count(*) FILTER (value < 60) / count(*) < 0.6"""


@query("g03_health_alerts", ALERTS)
def _(t):
    out = monitors.health_alerts(t.events, "ts", "event_type", F.col("value") < 60, 0.6)
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("window_start"), "event_type", "attempts")


@query("g03_health_alert_stream", ALERTS + " AND w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def _(t):
    path = shared_dir(t.spark, "health")
    alerts = monitors.health_alerts(events_stream(t), "ts", "event_type", F.col("value") < 60, 0.6, late="1 hour")
    monitors.to_table(alerts, path + "/rows", path + "/checkpoint")
    start = F.date_format(clock.utc_wall(F.col("window_start")), "yyyy-MM-dd HH")
    return t.spark.read.parquet(path + "/rows").select(start.alias("window_start"), "event_type", "attempts")


@query("g03_stage_timings", f"""
SELECT a.stage, a.count, round(avg(duration_ms), 4) AS avg_ms, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, round(sum(duration_ms), 4) AS total_ms
FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, run_id DESC) AS rn FROM ({R}) r) l
JOIN (SELECT stage, count(*) AS count FROM ({R}) r GROUP BY 1) a ON a.stage = l.stage WHERE rn <= 100 GROUP BY 1, 2""")
def _(t):
    path = shared_dir(t.spark, "timings")
    names = ["base_model_matching", "specification_inheritance", "customization_processing", "spring_options_enhancement", "final_validation"]
    runs = events_stream(t).withColumns({"stage": F.get(F.array(*map(F.lit, names)), (F.col("user_id") % 5).cast("int")), "duration_ms": F.col("value") * 10})
    timings.monitor(runs, path + "/rows", path + "/checkpoint", "stage", "duration_ms", "ts", "event_id")
    out = timings.timings(t.spark, path + "/rows")
    return out.withColumns({"avg_ms": F.round("avg_ms", 4), "total_ms": F.round("total_ms", 4)})


@query("g04_audit_stream", "SELECT event_id, 'product_created' AS action FROM events")
def _(t):
    path = shared_dir(t.spark, "audit")
    monitors.audit_batches(events_stream(t), path + "/rows", path + "/checkpoint", lambda b: history.created_audit(b, "event_id"))
    return t.spark.read.parquet(path + "/rows").select("event_id", "action")


@query("g05_duplicate_uploads", "SELECT sha256(text) AS file_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def _(t):
    return t.documents.groupBy(monitors.content_hash(F.col("text")).alias("file_hash")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("g05_duplicate_upload_stream", "SELECT DISTINCT sha256(event_type || (user_id % 50)) AS file_hash FROM events")
def _(t):
    path = shared_dir(t.spark, "uploads")
    hashed = events_stream(t).withColumn("file_hash", monitors.content_hash(F.concat("event_type", (F.col("user_id") % 50).cast("string"))))
    monitors.to_table(monitors.first_uploads(hashed, "file_hash", "ts", "60 days").select("file_hash"), path + "/rows", path + "/checkpoint")
    return t.spark.read.parquet(path + "/rows")


# --- extension points ----------------------------------------------------------------------------------
@query("x05_user_extractor", r"SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS n_lines FROM documents")
def _(t):
    def parser(batch):
        return batch.assign(n_lines=batch["text"].str.count("\n") + 1)[["doc_id", "n_lines"]]
    return extractors.extract(t.documents.select("doc_id", "text"), parser, "doc_id long, n_lines long")


@query("x07_sql_functions", """
SELECT p_partkey, p_brand || '_' || replace(p_name, ' ', '_') || '_' || p_size AS lookup_key, round(p_size / 50 * 100, 2) AS completion FROM part""")
def _(t):
    registered.register(t.spark)
    return t.part.selectExpr("p_partkey", "base_model_lookup_key(p_brand, p_name, p_size) AS lookup_key",
                             "completion_percentage(CAST(p_size AS BIGINT), 50L) AS completion")


@query("x08_report_view", f"SELECT brand, count(*) AS n FROM ({E}) e GROUP BY 1")
def _(t):
    registered.report_view(t.select(ENTRIES).groupBy("brand").agg(F.count("*").alias("n")), "brand_counts")
    return t.spark.sql("SELECT brand, n FROM brand_counts")
