"""Search, paging and joins."""

from __future__ import annotations

from pyspark.sql import functions as F


from catalign.operators import history, joins, keep, search
from catalign.operators.matching import mutual_containment
from catalign.workloads import query
from catalign.workloads.standins import BASE_MODELS, ENTRIES, PRODUCTS, RUN_LOG, pick, plain
from catalign.workloads.w_text import rewrite_sql

E, P, B, R = plain(ENTRIES), plain(PRODUCTS), plain(BASE_MODELS), plain(RUN_LOG)


@query("s06_load_products", f"SELECT product_id, model_code FROM ({P}) p WHERE brand = 'LYNX' AND model_year = 2024")
def _(t):
    rows = search.equal_filters(t.select(PRODUCTS), brand="LYNX", model_year=2024, market=None)
    return rows.orderBy("brand", "model_year", "model_code", "product_id").select("product_id", "model_code")


@query("s07_list_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def _(t):
    rows = search.equal_filters(t.orders, o_orderstatus="F")
    return search.page(rows, [F.col("o_orderkey")], 50, 100).select("o_orderkey", "o_totalprice")


@query("s07_count_and_exists", "SELECT count(*) AS n, count(*) > 0 AS present FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    rows = search.equal_filters(t.orders, o_orderstatus="F")
    return rows.agg(F.count("*").alias("n"), (F.count("*") > 0).alias("present"))


@query("p01_equality_filters", f"SELECT entry_id, model_code FROM ({E}) e WHERE brand = 'Lynx' AND model_year = 2020 AND currency = 'EUR'")
def _(t):
    return search.equal_filters(t.select(ENTRIES), brand="Lynx", model_year=2020, model_code=None, currency="EUR").select("entry_id", "model_code")


@query("p01_models_by_brand", f"SELECT base_model_id, model_year FROM ({B}) b WHERE brand = 'Lynx'")
def _(t):
    return search.equal_filters(t.select(BASE_MODELS), brand="Lynx").select("base_model_id", "model_year")


@query("p02_product_search", f"""
SELECT entry_id, price, extraction_confidence FROM ({E}) e WHERE brand = 'Ski-Doo' AND price <= 20000 AND extraction_confidence >= 0.3
ORDER BY extraction_confidence DESC, entry_id LIMIT 40 OFFSET 40""")
def _(t):
    found = search.product_search(t.select(ENTRIES), "extraction_confidence", "entry_id", brand="Ski-Doo", model_year=None,
                                  min_price=0, max_price=20000, min_confidence=0.3, page_no=2, size=40)
    return found.select("entry_id", "price", "extraction_confidence")


@query("p03_containment", f"SELECT base_model_id, model_name, model_year, brand FROM ({B}) b WHERE model_name ILIKE '%mxz_trail%'")
def _(t):
    return search.containing(t.select(BASE_MODELS), "model_name", "mxz_trail").select("base_model_id", "model_name", "model_year", "brand")


@query("p04_word_search", r"""
SELECT p_partkey FROM part WHERE list_contains(regexp_split_to_array(lower(p_name || ' ' || p_brand), '[^\p{L}\p{N}]+'), 'red')
 AND list_contains(regexp_split_to_array(lower(p_name || ' ' || p_brand), '[^\p{L}\p{N}]+'), '12')""")
def _(t):
    return search.word_search(t.part, ["p_name", "p_brand"], "Red #12").select("p_partkey")


@query("p04_document_search", r"""
SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'the') AND list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'with')
ORDER BY n_chars DESC, doc_id LIMIT 50""")
def _(t):
    hits = search.word_search(t.documents, ["text"], "the with")
    return search.page(hits, [F.desc("n_chars"), F.col("doc_id")], 50).select("doc_id")


@query("p05_mutual_containment", """
SELECT p_partkey, contains(upper(p_name), upper(p_type)) OR contains(upper(p_type), upper(p_name)) AS same FROM part WHERE p_name <> ''""")
def _(t):
    return t.part.filter("p_name <> ''").select("p_partkey", mutual_containment(F.col("p_name"), F.col("p_type")).alias("same"))


@query("p06_review_queue_keyset", f"""
SELECT run_id, ts FROM ({R}) r WHERE event_type = 'error' AND (ts > TIMESTAMP '2024-01-05 00:00:00' OR (ts = TIMESTAMP '2024-01-05 00:00:00' AND run_id > 0)) ORDER BY ts, run_id LIMIT 100""")
def _(t):
    rows = search.equal_filters(t.select(RUN_LOG), event_type="error")
    start = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return search.page_after(rows, ["ts", "run_id"], [start, 0], 100).select("run_id", "ts")


@query("p06_review_queue", f"SELECT run_id FROM ({R}) r WHERE event_type = 'error' ORDER BY ts DESC, run_id DESC LIMIT 100 OFFSET 20")
def _(t):
    rows = search.equal_filters(t.select(RUN_LOG), event_type="error")
    return search.page(rows, [F.desc("ts"), F.desc("run_id")], 100, 20).select("run_id")


@query("p07_quality_gate", f"""
SELECT product_id FROM ({P}) p WHERE product_id % 100 >= 45 AND currency = 'EUR' AND coalesce(moottori, '') <> '' AND coalesce(telamatto, '') <> '' AND model_year > 2020
 AND (coalesce(paketti, '') = '' OR vari IS NOT NULL)""")
def _(t):
    confidence = F.when(F.col("product_id") % 100 >= 45, 0.97).otherwise(0.5)
    status = F.when(F.col("currency") == "EUR", "passed").otherwise("failed")
    gate = search.quality_gate(confidence, status, [F.col("moottori") != "", F.col("telamatto") != ""], F.col("model_year") > 2020,
                               F.col("paketti"), F.col("vari").isNotNull())
    return t.select(PRODUCTS).filter(gate).select("product_id")


@query("p08_live_rows", f"SELECT product_id FROM ({P}) p WHERE malli IS NULL")
def _(t):
    return search.live(t.select(PRODUCTS), "malli").select("product_id")


@query("p10_useful_rows", f"SELECT product_id FROM ({P}) p WHERE coalesce(nullif(malli, ''), nullif(paketti, ''), nullif(vari, '')) IS NOT NULL")
def _(t):
    return search.useful(t.select(PRODUCTS), ["malli", "paketti", "vari"]).select("product_id")


@query("p13_option_rows", f"SELECT product_id FROM ({P}) p WHERE trim(paketti) <> ''")
def _(t):
    return search.with_options_text(t.select(PRODUCTS), "paketti").select("product_id")


@query("o01_brand_year_code_order", f"SELECT brand, model_year, model_code, entry_id FROM ({E}) e")
def _(t):
    return t.select(ENTRIES).orderBy("brand", "model_year", "model_code").select("brand", "model_year", "model_code", "entry_id")


@query("o02_first_model", f"SELECT base_model_id, brand, model_name, model_year FROM ({B}) b ORDER BY brand, model_name, model_year DESC, position LIMIT 1")
def _(t):
    ordered = t.select(BASE_MODELS).orderBy("brand", "model_name", F.desc("model_year"), "position")
    return ordered.limit(1).select("base_model_id", "brand", "model_name", "model_year")


@query("o03_paging", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25 OFFSET 75")
def _(t):
    return search.page(t.part, [F.desc("p_retailprice"), F.col("p_partkey")], 25, 75).select("p_partkey")


@query("o04_top_candidates", f"""
SELECT brand, model_year, string_agg(base_model_id, '|' ORDER BY position) AS models FROM (
 SELECT *, row_number() OVER (PARTITION BY brand, model_year ORDER BY position) AS rn FROM ({B}) b) x WHERE rn <= 10 GROUP BY 1, 2""")
def _(t):
    top = keep.top_per_key(t.select(BASE_MODELS), ["brand", "model_year"], [F.col("position")], 10)
    packed = top.groupBy("brand", "model_year").agg(F.array_sort(F.collect_list(F.struct("position", "base_model_id"))).alias("m"))
    return packed.select("brand", "model_year", F.array_join(F.transform("m", lambda x: x["base_model_id"]), "|").alias("models"))


@query("o05_groups_by_count", "SELECT p_type, count(*) AS n FROM part GROUP BY 1")
def _(t):
    return t.part.groupBy("p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_type")


@query("u02_ordered_dedup", """
SELECT l_orderkey, min_by(l_returnflag, pos) AS l_returnflag, min(l_linenumber) AS first_line FROM (
 SELECT l_orderkey, l_returnflag, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS pos FROM lineitem) x
GROUP BY l_orderkey, upper(l_returnflag)""")
def _(t):
    placed = t.lineitem.withColumn("position", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    out = keep.dedup_first(placed, ["l_orderkey"], "l_returnflag", "position", F.upper("l_returnflag"))
    return out.select("l_orderkey", "l_returnflag", F.col("position.l_linenumber").alias("first_line"))


@query("x06_normalizer_argument", r"""
SELECT source, min_by(line, (doc_id, pos)) AS line, count(*) AS times FROM (
 SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) x
GROUP BY source, trim(regexp_replace(lower(line), '\s+', ' ', 'g'))""")
def _(t):
    lines = t.documents.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    placed = lines.withColumn("position", F.struct("doc_id", "pos"))
    normal = F.trim(F.regexp_replace(F.lower("line"), r"\s+", " "))
    return keep.dedup_first(placed, ["source"], "line", "position", normal, times="times").select("source", "line", "times")


@query("u04_set_overlap", """
SELECT doc_id, CAST(len(list_intersect(a, b)) AS INT) AS shared, CAST(len(list_distinct(list_concat(a, b))) AS INT) AS joint FROM (
 SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS a, list_distinct(string_split(lower(source || ' the and le la der'), ' ')) AS b FROM documents) x""")
def _(t):
    a = F.array_distinct(F.split(F.lower("text"), " "))
    b = F.array_distinct(F.split(F.lower(F.concat("source", F.lit(" the and le la der"))), " "))
    return t.documents.select("doc_id", F.size(F.array_intersect(a, b)).alias("shared"), F.size(F.array_union(a, b)).alias("joint"))


# specifications per part brand and type against price rows per line item
SPECS = f"""
SELECT p_partkey AS spec_id, p_brand AS brand, p_name AS model, CAST(3000 + p_size * 20 AS DOUBLE) AS track_mm,
 {pick('p_partkey', ['850 E-TEC Turbo R', '600R E-TEC', '900 ACE'])} AS engine_a, {pick('p_size', ['850 E-TEC', '900 ACE Turbo', '600 EFI with WIS'])} AS engine_b FROM {{part}}"""
PRICING = f"""
SELECT l_orderkey * 10 + l_linenumber AS sku_no, p_brand AS brand, p_name AS model, {pick('l_orderkey', ['850 E-TEC Turbo R with Competition Pkg', '850 E-TEC', '600 EFI', '900 ACE Turbo', 'E-TEC 600R'])} AS engine,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(3000 + (l_linenumber * l_suppkey % 60) * 20 AS DOUBLE) END AS track_mm, l_partkey, l_suppkey
FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey"""


def spec_frames(t):
    specs = t.select(SPECS).withColumn("engines", F.array("engine_a", "engine_b"))
    pricing = t.select(PRICING).withColumn("sku", F.concat_ws("-", "sku_no", "l_partkey", "l_suppkey"))
    return specs, pricing


def _bare(c: str) -> str:
    return rewrite_sql(f"regexp_replace({c}, ' with .*$', '', 'i')")


PAIRS = f"""
WITH v AS (SELECT spec_id, track_mm, upper(brand) AS b, upper(model) AS m, engine, {_bare('engine')} AS e FROM (
  SELECT spec_id, track_mm, brand, model, unnest([engine_a, engine_b]) AS engine FROM ({plain(SPECS)}) s) x),
 p AS (SELECT sku_no || '-' || l_partkey || '-' || l_suppkey AS sku, track_mm, upper(brand) AS b, upper(model) AS m, engine, {_bare('engine')} AS e FROM ({plain(PRICING)}) r),
 j AS (SELECT v.spec_id, p.sku, v.engine AS spec_engine, p.engine AS price_engine, abs(v.track_mm - p.track_mm) / v.track_mm AS gap FROM v JOIN p ON v.b = p.b AND v.m = p.m AND v.e = p.e)"""


@query("j12_spec_price_match", f"""{PAIRS}
SELECT spec_id, sku, CASE WHEN spec_engine = price_engine AND gap = 0 THEN 'perfect' WHEN gap <= 0.05 THEN 'high' WHEN gap IS NULL THEN 'medium' ELSE 'low' END AS tier FROM j""")
def _(t):
    return joins.spec_price_join(*spec_frames(t), price_rows=t.lineitem.count())["matches"].select("spec_id", "sku", "tier")


@query("u05_unmatched_both_sides", f"""{PAIRS}
SELECT side, n FROM (SELECT 'spec' AS side, count(*) AS n FROM (SELECT DISTINCT spec_id FROM v WHERE spec_id NOT IN (SELECT spec_id FROM j)) a
UNION ALL SELECT 'price', count(*) FROM p WHERE sku NOT IN (SELECT sku FROM j)) b WHERE n > 0""")
def _(t):
    out = joins.spec_price_join(*spec_frames(t))
    sides = (out["unmatched_specs"].select(F.lit("spec").alias("side")).unionByName(out["unmatched_pricing"].select(F.lit("price").alias("side"))))
    return sides.groupBy("side").agg(F.count("*").alias("n"))


@query("j13_engine_inheritance", f"""
WITH s AS (SELECT brand, model, max(spec_id) AS spec_id FROM ({plain(SPECS)}) s GROUP BY 1, 2),
 e AS (SELECT s.brand, s.model, unnest([x.engine_a, x.engine_b]) AS engine, s.spec_id FROM s JOIN ({plain(SPECS)}) x ON x.spec_id = s.spec_id)
SELECT sku_no || '-' || l_partkey || '-' || l_suppkey AS sku, 600 + e.spec_id % 300 AS displacement, e.engine LIKE '%Turbo%' AS turbo, CASE WHEN r.engine = '850 E-TEC Turbo R' THEN 1 ELSE 0 END
 + CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS n_highlights FROM ({plain(PRICING)}) r LEFT JOIN e ON e.brand = r.brand AND e.model = r.model AND e.engine = r.engine""")
def _(t):
    specs, pricing = spec_frames(t)
    latest = keep.keep_last(specs, ["brand", "model"], ["spec_id"])
    shaped = latest.select("brand", "model", F.transform("engines", lambda e: F.struct(
        e.alias("name"), (F.lit(600) + F.col("spec_id") % 300).alias("displacement"), e.contains("Turbo").alias("turbo"), F.lit(200).alias("weight"))).alias("engines"))
    rows = pricing.withColumns({"track": F.when(F.col("l_suppkey") % 3 == 0, "137in 3500mm 1.5in 38mm Ice Ripper XT").otherwise("Cobra"),
                                "display": F.lit("4.5 in. Digital Display")})
    out = joins.inherit_engine(rows, shaped)
    return out.select("sku", "displacement", "turbo", F.size("highlights").alias("n_highlights"))


@query("j07_product_360", """
SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def _(t):
    out = joins.product_360(
        t.orders.withColumnRenamed("o_custkey", "sku"),
        t.customer.select(F.col("c_custkey").alias("sku"), "c_name", F.col("c_nationkey").alias("model_code")),
        t.nation.select(F.col("n_nationkey").alias("model_code"), "n_name", F.col("n_regionkey").alias("base_model_id")),
        t.region.select(F.col("r_regionkey").alias("base_model_id"), "r_name"))
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@query("j08_child_rows", """
SELECT o_orderkey, c_name, l_linenumber, l_partkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def _(t):
    parents = t.orders.withColumnRenamed("o_orderkey", "order_id")
    children = t.lineitem.withColumnRenamed("l_orderkey", "order_id")
    out = joins.child_rows(parents, t.customer, F.col("o_custkey") == F.col("c_custkey"), children, "order_id")
    return out.select(F.col("order_id").alias("o_orderkey"), "c_name", "l_linenumber", "l_partkey")


@query("j09_update_by_key", """
SELECT o_orderkey, coalesce(CASE WHEN s.n >= 3 THEN 'A' END, o_orderstatus) AS o_orderstatus, coalesce(s.q, o_totalprice) AS o_totalprice
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) s ON l_orderkey = o_orderkey""")
def _(t):
    news = t.lineitem.filter(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.when(F.count("*") >= 3, "A").alias("o_orderstatus"), F.max("l_quantity").alias("o_totalprice"))
    return history.update_by_key(t.orders, news, ["o_orderkey"], ["o_orderstatus", "o_totalprice"]).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("j10_unseen_files", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return joins.unseen(t.documents.select("doc_id"), t.labels, "doc_id")


@query("j11_seen_products", "SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')")
def _(t):
    return joins.seen(t.part, t.lineitem.filter(F.col("l_returnflag") == "R").withColumnRenamed("l_partkey", "p_partkey"), "p_partkey").select("p_partkey")


@query("j16_option_usage_in_text", """
SELECT o.option_id, o.name, o.option_type, count(d.doc_id) AS recent_usage_count
FROM (SELECT item_id AS option_id, text AS name, CASE WHEN length(text) > 250 THEN 'long' ELSE 'short' END AS option_type FROM benchmark WHERE text NOT LIKE 'The %') o
LEFT JOIN documents d ON d.text LIKE '%' || o.name || '%' AND DATE '2025-01-01' + CAST(d.n_chars % 90 AS INT) >= DATE '2025-03-01' - 30 GROUP BY 1, 2, 3""")
def _(t):
    options = t.benchmark.select(
        F.col("item_id").alias("option_id"), F.col("text").alias("name"), F.when(F.length("text") > 250, "long").otherwise("short").alias("option_type"),
        F.when(F.col("text").startswith("The "), F.lit("2025-02-01").cast("date")).alias("deleted_at"))
    texts = t.documents.select("doc_id", "text", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("n_chars") % 90).cast("int")).alias("created_at"))
    return joins.option_usage_in_text(options, texts, ["doc_id"], F.lit("2025-03-01").cast("date"))


REGISTRY = [(1, "Standard", None, None), (2, "Expert Package", "SKI-DOO", None), (3, "Competition", None, "Ranger"), (4, "with WIS", "LYNX", None), (5, "X", "BRP", "Summit X")]
_reg = " UNION ALL ".join(f"SELECT {i} AS position, '{n}' AS name, {('NULL' if b is None else repr(b))} AS b, {('NULL' if f is None else repr(f))} AS f" for i, n, b, f in REGISTRY)


@query("j17_known_options", f"""
SELECT product_id, string_agg(r.name, '|' ORDER BY position) AS known FROM ({P}) p LEFT JOIN ({_reg}) r
 ON (r.b IS NULL OR p.brand = r.b) AND (r.f IS NULL OR coalesce(p.malli, '') = r.f) AND contains(lower(p.paketti), lower(r.name)) GROUP BY 1""")
def _(t):
    registry = t.spark.createDataFrame(REGISTRY, "position long, name string, brand string, family string")
    rows = t.select(PRODUCTS).select("product_id", F.col("paketti").alias("text"), "brand", F.coalesce("malli", F.lit("")).alias("family"))
    found = joins.known_options(rows, registry, ["product_id"])
    return found.select("product_id", F.when(F.size("known") > 0, F.array_join("known", "|")).alias("known"))


@query("j17_new_options", f"""
WITH e AS (SELECT product_id, brand, coalesce(malli, '') AS family, trim(paketti) AS options FROM ({P}) p WHERE trim(coalesce(paketti, '')) <> ''),
 o AS (SELECT DISTINCT options, brand, family FROM e),
 h AS (SELECT o.*, list(r.name ORDER BY position) FILTER (r.name IS NOT NULL) AS names FROM o LEFT JOIN ({_reg}) r ON (r.b IS NULL OR r.b = o.brand) AND (r.f IS NULL OR r.f = o.family) AND contains(lower(o.options), lower(r.name)) GROUP BY ALL),
 x AS (SELECT options, brand, family, trim(regexp_replace(list_reduce(list_concat([lower(options)], coalesce(names, [])), lambda a, n: replace(a, lower(n), '')), '[\\s,;]+', ' ', 'g')) AS rest FROM h)
SELECT rest AS name, min(product_id) AS first_seen, count(*) AS times_seen, false AS validated FROM e JOIN x ON x.options = e.options AND x.brand = e.brand AND x.family = e.family WHERE rest <> '' GROUP BY 1""")
def _(t):
    registry = t.spark.createDataFrame(REGISTRY, "position long, name string, brand string, family string")
    rows = t.select(PRODUCTS).select("product_id", F.col("paketti").alias("text"), "brand", F.coalesce("malli", F.lit("")).alias("family"))
    return joins.new_registry_rows(joins.known_options(rows, registry, ["product_id"]), ["product_id"])


@query("j19_dimension_join", """
SELECT s_name, n_name, r_name, s_acctbal FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def _(t):
    out = joins.dimension_join(t.supplier.withColumnRenamed("s_nationkey", "n_nationkey"),
                               t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, "n_nationkey", "r_regionkey")
    return out.orderBy("s_acctbal").select("s_name", "n_name", "r_name", "s_acctbal")


@query("j20_per_language", "SELECT p_partkey, l.lang AS language, l.cur AS language_currency FROM part CROSS JOIN (VALUES ('fi', 'EUR'), ('en', 'EUR'), ('se', 'SEK')) l(lang, cur)")
def _(t):
    return joins.per_language(t.part, ["fi", "en", "se"]).select("p_partkey", "language", "language_currency")


@query("j21_verify_inventory", """
SELECT CAST(a.c_custkey AS VARCHAR) AS name, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.len <> b.n THEN 'size_mismatch' ELSE 'verified' END AS state
FROM (SELECT c_custkey, CAST(10 + c_custkey % 7 AS BIGINT) AS len FROM customer) a LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) b ON b.o_custkey = a.c_custkey""")
def _(t):
    local = t.customer.select(F.col("c_custkey").cast("string").alias("name"), (10 + F.col("c_custkey") % 7).alias("length"))
    remote = t.orders.groupBy(F.col("o_custkey").cast("string").alias("name")).agg(F.count("*").alias("length"))
    return joins.verify_inventory(local, remote).select("name", "state")


@query("u06_unknown_fields", """
SELECT k AS field, count(*) AS occurrences FROM (SELECT unnest([l_returnflag, l_linestatus, 'N' || l_linenumber]) AS k FROM lineitem) x
WHERE k NOT IN ('A', 'N', 'O', 'N1') GROUP BY 1""")
def _(t):
    named = F.map_from_arrays(F.array_distinct(F.array("l_returnflag", F.concat(F.lit("N"), F.col("l_linenumber").cast("string")))),
                              F.array(F.lit("x"), F.lit("y")))
    both = F.map_concat(named, F.create_map("l_linestatus", F.lit("z")))
    return joins.unknown_fields(t.lineitem.select(both.alias("fields")), "fields", ["A", "N", "O", "N1"])
