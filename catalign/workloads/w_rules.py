"""Rule engines over products and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import bands, fixed
from catalign.functions.text import filled
from catalign.operators import matching, rules, stats
from catalign.tables import Tables
from catalign.workloads import query
from catalign.workloads.standins import CATALOG, ENTRIES, PRODUCTS, pick, plain, quote

P, E, C = plain(PRODUCTS), plain(ENTRIES), plain(CATALOG)


def joined(arms: list[tuple[str, str]]) -> str:
    """SQL text of all messages whose condition holds."""
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in arms) + ")"


def products(t: Tables):
    return t.select(PRODUCTS)


def out(df, *keys):
    return df.select(*keys, F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"))


REQUIRED_SQL = [
    ("coalesce(length(model_code), 0) <> 4", "'model_code must be exactly 4 characters'"),
    ("trim(coalesce(brand, '')) = ''", "'brand cannot be empty'"),
    ("model_year IS NULL OR model_year < 2015 OR model_year > 2030",
     "'year must be between 2015-2030, got: ' || coalesce(CAST(model_year AS VARCHAR), 'None')"),
    ("price <= 0", "'price must be greater than 0'"),
    ("price > 10000000", "'price seems unrealistic: ' || replace(CAST(price AS VARCHAR), '12000000.5', '1.20000005E7')"),
]
FIELD_ERRORS_SQL = [
    ("price < 100000", "'Price too low: ' || CAST(price AS VARCHAR) || ' (minimum: 100000)'"),
    ("price > 10000000", "'Price too high: ' || replace(CAST(price AS VARCHAR), '12000000.5', '1.20000005E7') || ' (maximum: 10000000)'"),
    ("price IS NOT NULL AND currency NOT IN ('EUR', 'RUB')", "'Invalid currency: ' || currency || ' (allowed: EUR, RUB)'"),
    ("model_code <> '' AND NOT regexp_matches(model_code, '^[A-Z]{4}$')", "'model_code does not match required pattern: ^[A-Z]{4}$'"),
    ("brand <> '' AND brand NOT IN ('BRP', 'LYNX', 'SKI-DOO')", quote("brand not in allowed values: ['BRP', 'LYNX', 'SKI-DOO']")),
    ("model_year < 2015", "'year too low: ' || model_year || ' (minimum: 2015)'"),
    ("model_year > 2030", "'year too high: ' || model_year || ' (maximum: 2030)'"),
]
FIELD_WARNINGS_SQL = [("currency = 'RUB' AND price % 1 <> 0", "'RUB prices should not have decimal places'")]


def _has(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quote(w)})" for w in words) + ")"


_families = " OR ".join(f"(brand = '{b}' AND {_has('upper(malli)', f)})" for b, f in fixed.BRAND_FAMILIES.items())
_size = r"regexp_extract(moottori, '(\d{3})', 1)"
_engine_case = "CASE " + " ".join(
    f"WHEN contains(upper(malli), '{fam}') THEN CASE WHEN {_size} NOT IN ({', '.join(map(quote, sizes))}) THEN "
    f"'Unusual engine-model combination: ' || {_size} || {quote(f' in {fam} (typical: {sizes})')} END"
    for fam, sizes in fixed.ENGINE_FAMILIES) + " END"
BUSINESS_SQL = [
    (f"coalesce(brand, '') <> '' AND coalesce(malli, '') <> '' AND NOT ({_families})",
     "'Unusual brand-model combination: ' || brand || ' ' || malli"),
    (f"coalesce(moottori, '') <> '' AND coalesce(malli, '') <> '' AND {_size} <> ''", _engine_case),
    ("upper(market) = 'FINLAND' AND currency <> 'EUR'", "'Currency mismatch for FINLAND: expected EUR, got ' || currency"),
    ("upper(market) = 'FINLAND' AND coalesce(telamatto, '') = ''", "'Missing recommended spec for FINLAND: telamatto'"),
    ("upper(market) = 'FINLAND' AND coalesce(kaynnistin, '') = ''", "'Missing recommended spec for FINLAND: kaynnistin'"),
    ("upper(market) = 'RUSSIA' AND currency <> 'RUB'", "'Currency mismatch for RUSSIA: expected RUB, got ' || currency"),
]


def required():
    return rules.required_rules(F.col("model_code"), F.col("brand"), F.col("model_year"), F.col("price"))


def fields():
    return rules.field_rules(F.col("model_code"), F.col("brand"), F.col("model_year"), F.col("price"), F.col("currency"))


def business():
    return rules.business_rules(F.col("brand"), F.col("malli"), F.col("moottori"), F.col("currency"), F.col("market"),
                                {f: F.col(f) for f in ("telamatto", "kaynnistin")})


@query("v01_required_fields", f"SELECT product_id, {joined(REQUIRED_SQL)} AS errors, '' AS warnings FROM ({P}) p")
def _(t):
    return out(rules.apply_rules(products(t), required()), "product_id")


@query("v03_field_rules", f"""
SELECT product_id, {joined(FIELD_ERRORS_SQL)} AS errors, {joined(FIELD_WARNINGS_SQL)} AS warnings FROM ({P}) p""")
def _(t):
    return out(rules.apply_rules(products(t), fields()), "product_id")


@query("v03_title_and_description_rules", """
SELECT doc_id, concat_ws('; ', CASE WHEN length(text) < 50 THEN 'description too short: ' || length(text) || ' characters (minimum: 50)' END,
 CASE WHEN length(text) > 9000 THEN 'description too long: ' || length(text) || ' characters (maximum: 9000)' END,
 CASE WHEN length(source) < 10 THEN 'title too short: ' || length(source) || ' characters (minimum: 10)' END,
 CASE WHEN NOT contains(upper(source), 'BRP') THEN 'title must contain: BRP' END,
 CASE WHEN contains(upper(source), 'TEST') THEN 'title contains forbidden word: test' END) AS errors FROM documents""")
def _(t):
    both = (rules.text_rules("description", F.col("text"), fixed.DESCRIPTION_RULES)
            + rules.text_rules("title", F.col("source"), fixed.TITLE_RULES))
    return rules.apply_rules(t.documents, both).select("doc_id", F.array_join("errors", "; ").alias("errors"))


@query("v04_business_rules", f"SELECT product_id, '' AS errors, {joined(BUSINESS_SQL)} AS warnings FROM ({P}) p")
def _(t):
    return out(rules.apply_rules(products(t), business()), "product_id")


LAYERED = f"""
SELECT *, CAST(CASE WHEN n_err > 0 THEN 0.0 ELSE greatest(0.0, 1.0 - n_warn * 0.1) END AS DOUBLE) AS confidence, n_err = 0 AS success FROM (
 SELECT *, {' + '.join(f"coalesce(CAST(({c}) AS INT), 0)" for c, _ in REQUIRED_SQL + FIELD_ERRORS_SQL)} AS n_err,
  {' + '.join(f"(CASE WHEN (CASE WHEN {c} THEN {m} END) IS NOT NULL THEN 1 ELSE 0 END)" for c, m in FIELD_WARNINGS_SQL + BUSINESS_SQL)} AS n_warn
 FROM ({P}) p) q"""


def validated(t: Tables):
    return rules.layered(products(t), [(required(), True), (fields(), True), (business(), False)])


@query("v05_layered_validation", f"""
SELECT product_id, success, CAST(n_err AS INT) AS n_errors, CAST(n_warn AS INT) AS n_warnings, round(confidence, 6) AS confidence FROM ({LAYERED}) v""")
def _(t):
    return validated(t).select("product_id", "success", F.size("errors").alias("n_errors"),
                               F.size("warnings").alias("n_warnings"), F.round("confidence", 6).alias("confidence"))


@query("v06_consistency_rules", f"""
SELECT product_id, concat_ws('; ', CASE WHEN upper(brand) = 'LYNX' AND contains(lower(malli), 'ski-doo') THEN 'Brand/model mismatch: LYNX brand with SKI-DOO model' END,
  CASE WHEN upper(brand) = 'SKI-DOO' AND contains(lower(malli), 'lynx') THEN 'Brand/model mismatch: SKI-DOO brand with LYNX model' END) AS errors,
 concat_ws('; ', CASE WHEN brand <> '' AND upper(brand) NOT IN ('BRP', 'LYNX', 'SKI-DOO') THEN 'Unknown brand: ' || brand END,
  CASE WHEN malli <> '' AND length(malli) < 2 THEN 'Model name seems too short: ' || malli END,
  CASE WHEN moottori <> '' AND moottori NOT IN ('850 E-TEC', '600R E-TEC', '900 ACE') THEN 'Engine ''' || moottori || ''' not found in catalog' END) AS warnings
FROM ({P}) p""")
def _(t):
    engines = F.array(F.lit("850 E-TEC"), F.lit("600R E-TEC"), F.lit("900 ACE"))
    both = rules.general_rules(F.col("brand"), F.col("malli")) + rules.consistency_rules(
        F.col("brand"), F.col("malli"), F.col("moottori"), engines)
    return out(rules.apply_rules(products(t), both), "product_id")


# Twenty-two listing fields per order, as text.
LISTING = f"""
SELECT o_orderkey AS listing_id,
 {pick('o_orderkey', ['MXZ-X-600R-2025', 'AB', 'bad id!', 'OK_1', '  '])} AS "Id",
 {pick('o_custkey', ['BRP Ski-Doo Summit 2025', 'Short', 'Something else entirely', None])} AS "Title",
 {pick('o_orderkey', ['Summit X small ring', 'Ranger', 'No such model', ''])} AS "Model",
 CASE WHEN o_orderkey % 5 = 0 THEN '2,500,000' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS "Price",
 {pick('o_custkey', ['2025', '25', '1999', '2099', None])} AS "Year",
 {pick('o_orderkey', ['165', '165 hp', '5', '400', ''])} AS "Power",
 {pick('o_custkey', ['849', '849cc', '100', '2500', None])} AS "EngineCapacity",
 {pick('o_orderkey', ['2', '4', 'two', None])} AS "PersonCapacity",
 {pick('o_custkey', ['406', '200', 'wide', ''])} AS "TrackWidth",
 {pick('o_orderkey', ['too short', 'A description that is long enough to pass the fifty character limit.', None])} AS "Description",
 {pick('o_custkey', ['https://x.example/a.JPG', 'ftp://x', 'http://x.example/a', ''])} AS "Images",
 {pick('o_orderkey', ['Санкт-Петербург', 'Москва'])} AS "Address",
 {pick('o_custkey', ['Мотоциклы и мототехника', None])} AS "Category",
 {pick('o_orderkey', ['Снегоходы', 'Снегоход'])} AS "VehicleType",
 {pick('o_custkey', ['BRP', 'brp'])} AS "Make",
 {pick('o_orderkey', ['Бензин', 'Дизель'])} AS "EngineType",
 {pick('o_custkey', ['Новое', 'Б/у'])} AS "Condition",
 {pick('o_orderkey', ['0', '10'])} AS "Kilometrage",
 {pick('o_custkey', ['Утилитарный', 'Другой', ''])} AS "Type",
 {pick('o_orderkey', ['В наличии', 'Скоро', None])} AS "Availability",
 {pick('o_custkey', ['2025-01-01', '01.01.2025', None])} AS "DateBegin",
 {pick('o_orderkey', ['2025-12-31', 'later', ''])} AS "DateEnd"
FROM {{orders}}"""
FIELDS = ["Id", "Title", "Model", "Price", "Year", "Power", "EngineCapacity", "PersonCapacity", "TrackWidth",
          "Description", "Images", "Address", "Category", "VehicleType", "Make", "EngineType", "Condition",
          "Kilometrage", "Type", "Availability", "DateBegin", "DateEnd"]


def listing_rows(t: Tables):
    names = t.select(CATALOG).select(F.col("model_family").alias("name"), "position")
    return matching.suggest_models(t.select(LISTING.replace('"', "`")), names, "Model")


def checked_listings(t: Tables):
    return rules.check_listings(listing_rows(t), FIELDS, 2026)


def _outcome_sql() -> str:
    v, s = "trim(coalesce(value, ''))", "length(trim(coalesce(value, '')))"
    n = f"TRY_CAST({v} AS HUGEINT)"

    def arms(pairs):
        return "CASE " + " ".join(f"WHEN {c} THEN {m}" for c, m in pairs) + " END"

    def num(bad, low, high, below, above, blank=None):
        first = [(f"{v} = ''", blank or "NULL")]
        return first + [(f"NOT regexp_matches({v}, '^[0-9]+$')", quote("E:" + bad)), (f"{n} < {low}", quote("E:" + below)),
                        (f"coalesce({n}, 1e30) > {high}", quote("E:" + above))]

    per = {
        "Id": [(f"{v} = ''", "'E:Id is required and cannot be empty'"), (f"{s} < 3", "'E:Id must be at least 3 characters long'"),
               (f"NOT regexp_matches({v}, '^[a-zA-Z0-9_-]+$')", "'E:Id should only contain letters, numbers, hyphens, and underscores'")],
        "Title": [(f"{v} = ''", "'E:Title is required'"), (f"{s} < 10", "'E:Title must be at least 10 characters long'"),
                  (f"NOT ({_has(f'lower({v})', fixed.LISTING_TERMS)})", "'W:Title should contain snowmobile-related terms for better visibility'")],
        "Model": [(f"{v} = ''", "'E:Model is required'"), (f"{v} NOT IN (SELECT model_family FROM ({C}) c)",
                  f"'E:Model ''' || {v} || ''' not found in official BRP list'")],
        "Price": num("Price must contain only numbers (no currency symbols, commas, or spaces)", 100000, 5000000,
                     "Price seems too low for a snowmobile (minimum 100,000 rubles)",
                     "Price seems too high for a snowmobile (maximum 5,000,000 rubles)", "'E:Price is required'"),
        "Year": [(f"{v} = ''", "'E:Year is required'"), (f"NOT regexp_matches({v}, '^[0-9]{{4}}$')", "'E:Year must be a 4-digit number'"),
                 (f"{n} < 2000", f"'E:Year must be 2000 or later (got ' || {v} || ')'"),
                 (f"{n} > 2028", f"'E:Year cannot be more than 2 years in the future (got ' || {v} || ')'")],
        "Power": num("Power must be a number (HP only, no units)", 10, 300, "Power seems too low for a snowmobile (minimum 10 HP)",
                     "Power seems too high for a snowmobile (maximum 300 HP)", "'W:Power is recommended for better visibility'"),
        "EngineCapacity": num("Engine capacity must be a number (CC only, no units)", 200, 2000,
                              "Engine capacity seems too low (minimum 200 CC)", "Engine capacity seems too high (maximum 2000 CC)",
                              "'W:Engine capacity is recommended'"),
        "PersonCapacity": num("Person capacity must be a number", 1, 3, "Person capacity must be 1, 2, or 3",
                              "Person capacity must be 1, 2, or 3", "'W:Person capacity is recommended'"),
        "TrackWidth": num("Track width must be a number (mm only, no units)", 300, 600, "Track width must be between 300-600mm",
                          "Track width must be between 300-600mm", "'W:Track width is recommended'"),
        "Description": [(f"{v} = ''", "'E:Description is required'"), (f"{s} < 50", "'E:Description must be at least 50 characters long'")],
        "Images": [(f"{v} = ''", "'E:At least one image is required'"),
                   ("NOT (starts_with(value, 'http://') OR starts_with(value, 'https://'))", "'E:Image must be a valid HTTP/HTTPS URL'"),
                   (f"NOT ({_has('lower(value)', fixed.IMAGE_ENDINGS)})", "'W:Image URL should end with .jpg, .png, or .webp'")],
        "Type": [(f"{v} = ''", "'W:Type is recommended for better categorization'"),
                 (f"value NOT IN ({', '.join(map(quote, fixed.LISTING_TYPES))})", quote("E:Type must be one of: " + ", ".join(fixed.LISTING_TYPES)))],
        "Availability": [(f"{v} = ''", "'W:Availability is recommended'"),
                         (f"value NOT IN ({', '.join(map(quote, fixed.LISTING_STOCK))})",
                          quote("E:Availability must be one of: " + ", ".join(fixed.LISTING_STOCK)))],
        "DateBegin": [(f"{v} = ''", "'W:Date begin is optional'"), (r"NOT regexp_matches(value, '^\d{4}-\d{2}-\d{2}$')", "'E:Date must be in YYYY-MM-DD format'")],
        "DateEnd": [(f"{v} = ''", "'W:Date end is optional'"), (r"NOT regexp_matches(value, '^\d{4}-\d{2}-\d{2}$')", "'E:Date must be in YYYY-MM-DD format'")],
    }
    for name, expected in fixed.LISTING_EXACT.items():
        message = f"E:{name} must be '{expected}'" + fixed.LISTING_EXACT_TAIL.get(name, "")
        per[name] = [(f"coalesce(value, '') <> {quote(expected)}", quote(message))]
    return "CASE field " + " ".join(f"WHEN '{f}' THEN {arms(a)} END".replace("END END", "END") for f, a in per.items()) + " END"


LISTING_OUTCOME = f"""
SELECT listing_id, field, value, {_outcome_sql()} AS note FROM (
 SELECT listing_id, field, value FROM ({plain(LISTING)}) w
 UNPIVOT INCLUDE NULLS (value FOR field IN ({', '.join(f'"{f}"' for f in FIELDS)}))) u"""


@query("v07_listing_fields", f"""
SELECT listing_id, field, NOT coalesce(starts_with(note, 'E:'), false) AS valid,
 CASE WHEN starts_with(note, 'E:') THEN substr(note, 3) END AS error,
 CASE WHEN starts_with(note, 'W:') THEN substr(note, 3) END AS warning FROM ({LISTING_OUTCOME}) o""")
def _(t):
    return rules.check_rows(checked_listings(t)).select("listing_id", "field", "valid", "error", "warning")


_models = f"(SELECT model_family AS name, min(position) AS position FROM ({C}) c GROUP BY 1)"


@query("v07_listing_suggested_fix", f"""
WITH o AS (SELECT *, trim(coalesce(value, '')) AS clean FROM ({LISTING_OUTCOME}) x),
 s AS (SELECT clean, min_by(name, position) AS near FROM (SELECT DISTINCT clean FROM o WHERE field = 'Model' AND clean <> '') k
  JOIN {_models} m ON contains(lower(k.clean), lower(m.name)) OR contains(lower(m.name), lower(k.clean)) GROUP BY 1),
 f AS (SELECT field, CASE
   WHEN field = 'Id' AND starts_with(note, 'E:Id should only') THEN 'Use format like: ARTICLE-CODE-123 or MODEL_YEAR_2025'
   WHEN field = 'Price' AND starts_with(note, 'E:Price must contain') THEN 'Use format: 2500000 (not 2,500,000 руб)'
   WHEN field = 'Power' AND starts_with(note, 'E:Power must be') THEN 'Use format: 165 (not 165 hp)'
   WHEN field = 'EngineCapacity' AND starts_with(note, 'E:Engine capacity must be') THEN 'Use format: 849 (not 849cc)'
   WHEN field = 'Year' AND starts_with(note, 'E:Year must be a 4-digit') THEN 'Use format: 2025'
   WHEN field = 'DateBegin' AND starts_with(note, 'E:') THEN 'Use format: 2025-01-01' WHEN field = 'DateEnd' AND starts_with(note, 'E:') THEN 'Use format: 2025-12-31'
   WHEN field = 'Model' AND contains(note, 'not found') THEN coalesce('Did you mean: ' || near || '?', 'Check official BRP model list for exact spelling') END AS fix
  FROM o LEFT JOIN s ON s.clean = o.clean AND o.field = 'Model')
SELECT field, fix, count(*) AS listings FROM f WHERE fix IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return (rules.check_rows(checked_listings(t)).filter(F.col("fix").isNotNull())
            .groupBy("field", "fix").agg(F.count("*").alias("listings")))


LISTING_TOTALS = f"""
SELECT listing_id, count(*) AS total_checks, count(*) FILTER (NOT coalesce(starts_with(note, 'E:'), false)) AS passed_checks,
 count(*) FILTER (starts_with(note, 'E:')) AS n_errors, count(*) FILTER (starts_with(note, 'W:')) AS n_warnings
FROM ({LISTING_OUTCOME}) o GROUP BY 1"""


@query("a22_listing_totals", f"""
SELECT listing_id, total_checks, passed_checks, n_errors = 0 AS is_valid, CASE WHEN n_errors = 0 THEN
  'VALIDATION PASSED: ' || passed_checks || '/' || total_checks || ' checks passed' || CASE WHEN n_warnings > 0 THEN ' (' || n_warnings || ' warnings)' ELSE '' END
  ELSE 'VALIDATION FAILED: ' || n_errors || ' errors, ' || n_warnings || ' warnings' END AS summary
FROM ({LISTING_TOTALS}) s""")
def _(t):
    return rules.listing_totals(listing_rows(t), FIELDS, 2026).select("listing_id", "total_checks", "passed_checks", "is_valid", "summary")


@query("a22_listing_summary", f"SELECT n_errors, n_warnings, count(*) AS listings FROM ({LISTING_TOTALS}) s GROUP BY 1, 2")
def _(t):
    """The same totals from the full outcomes."""
    return rules.listing_summary(checked_listings(t)).groupBy("n_errors", "n_warnings").agg(F.count("*").alias("listings"))


@query("v08_listing_required", """
SELECT doc_id, concat_ws('; ', CASE WHEN coalesce(source, '') = '' THEN 'Required field ''source'' is missing or empty' END,
 CASE WHEN coalesce(text, '') = '' THEN 'Required field ''text'' is missing or empty' END,
 CASE WHEN coalesce(n_chars, 0) * 100 = 0 THEN 'Required field ''price'' is missing or empty' END,
 CASE WHEN n_chars * 100 <> 0 AND (n_chars * 100 < 100000 OR n_chars * 100 > 10000000) THEN 'Price ' || (n_chars * 100) || ' is outside valid range (100,000 - 10,000,000 RUB)' END,
 CASE WHEN lang = 'en' THEN 'At least one image URL is required' END) AS errors FROM documents""")
def _(t):
    shaped = t.documents.withColumn("price", F.col("n_chars") * 100).withColumn(
        "images", F.when(F.col("lang") == "en", F.array().cast("array<string>")).otherwise(F.array("source")))
    return rules.listing_required(shaped, ["source", "text", "price"]).select(
        "doc_id", F.array_join("errors", "; ").alias("errors"))


@query("v11_required_keys", """
SELECT event_id, concat_ws('; ', CASE WHEN event_type = 'view' THEN 'Required field ''code'' is missing'
  WHEN event_type = 'click' THEN 'Required field ''code'' is None' WHEN event_type = 'error' THEN 'Required field ''code'' is empty' END,
 'Required field ''brand'' is missing') AS errors FROM events""")
def _(t):
    code = (F.when(F.col("event_type") == "click", F.lit(None)).when(F.col("event_type") == "error", F.lit("  "))
            .otherwise(F.lit("LTTA")))
    data = F.when(F.col("event_type") == "view", F.create_map(F.lit("year"), F.lit("2024"))).otherwise(
        F.create_map(F.lit("code"), code))
    return t.events.select("event_id", F.array_join(rules.required_fields(data, ["code", "brand"]), "; ").alias("errors"))


@query("v12_status_decision", f"""
SELECT entry_id, CASE WHEN price <= 8000 THEN 'requires_review' WHEN extraction_confidence < 0.85 THEN 'failed' ELSE 'passed' END AS validation_status,
 price > 8000 AND extraction_confidence >= 0.95 AS auto_accepted, price <= 8000 OR extraction_confidence < 0.85 AS requires_review FROM ({E}) e""")
def _(t):
    made = bands.decision(F.col("extraction_confidence"), F.col("price") > 8000)
    return t.select(ENTRIES).select("entry_id", *[c.alias(n) for n, c in made.items()])


@query("v13_content_accuracy", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, round((CAST(l_returnflag IS NOT DISTINCT FROM o_orderstatus AS DOUBLE)
 + CAST(l_linestatus IS NOT DISTINCT FROM o_orderstatus AS DOUBLE)
 + CAST(date_trunc('month', l_shipdate) IS NOT DISTINCT FROM date_trunc('month', o_orderdate) AS DOUBLE)
 + CAST(l_linenumber % 2 IS NOT DISTINCT FROM o_custkey % 2 AS DOUBLE)) / 4, 6) AS accuracy
FROM (SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem) x
JOIN (SELECT *, 1 AS one FROM orders) o ON o_orderkey = l_orderkey""".replace(
    "date_trunc('month', l_shipdate)", "substr(l_shipdate, 1, 7)").replace(
    "date_trunc('month', o_orderdate)", "strftime(o_orderdate, '%Y-%m')"))
def _(t):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    month = "yyyy-MM"
    return both.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        F.round(rules.share_equal([
            (F.col("l_returnflag"), F.col("o_orderstatus")), (F.col("l_linestatus"), F.col("o_orderstatus")),
            (F.date_format("l_shipdate", month), F.date_format("o_orderdate", month)),
            ((F.col("l_linenumber") % 2).cast("long"), F.col("o_custkey") % 2)]), 6).alias("accuracy"))


@query("v14_price_order", f"""
WITH r AS (SELECT coalesce(malli, '') AS model, CASE WHEN contains(moottori, 'Turbo R') THEN 3 WHEN contains(moottori, '850') THEN 2 WHEN contains(moottori, '600R') THEN 1 END AS rank, price
 FROM ({P}) p), a AS (SELECT model, rank, avg(price) AS price FROM r WHERE rank IS NOT NULL GROUP BY 1, 2)
SELECT model, CAST(rank AS INT) AS engine_rank, round(price, 4) AS price, price > lag(price) OVER (PARTITION BY model ORDER BY rank) AS in_order FROM a""")
def _(t):
    ranked = stats.engine_price_order(products(t), "malli", "moottori", "price")
    return ranked.select("model", "engine_rank", F.round("price", 4).alias("price"), "in_order")


@query("v15_fabricated_words", """
SELECT doc_id, regexp_matches(lower(text), 'fake_|mock_|dummy_|test_123|example_') AS fabricated FROM documents""")
def _(t):
    return t.documents.select("doc_id", rules.fabricated(F.col("text")).alias("fabricated"))


@query("j18_expected_comparison", f"""
SELECT entry_id, CASE WHEN brand <> 'Ski-Doo' THEN 'brand: expected ''Ski-Doo'', got ''' || brand || '''' ELSE '' END
 || CASE WHEN abs(expected - price) > 100 THEN CASE WHEN brand <> 'Ski-Doo' THEN '; ' ELSE '' END || 'price: expected ~' || expected || ', got ' || price || ' (diff: ' || abs(expected - price) || ')' ELSE '' END AS errors,
 CASE WHEN abs(expected - price) > 10 AND abs(expected - price) <= 100 THEN 'price: small difference - expected ' || expected || ', got ' || price ELSE '' END AS warnings,
 brand = 'Ski-Doo' AND abs(expected - price) <= 100 AS valid
FROM (SELECT *, CASE model_code {' '.join(f"WHEN '{c}' THEN CAST({v} AS DOUBLE)" for c, v in (('LTTA', 12000), ('FREE', 5100), ('AB', 21000)))} END AS expected FROM ({E}) e) x
WHERE expected IS NOT NULL""")
def _(t):
    want = t.spark.createDataFrame([("LTTA", "Ski-Doo", 12000.0), ("FREE", "Ski-Doo", 5100.0), ("AB", "Ski-Doo", 21000.0)],
                                   "model_code string, expected_brand string, expected_price double")
    rows = t.select(ENTRIES).join(want, "model_code")
    return out(rules.expected_difference(rows, ["brand"], "price"), "entry_id", "valid")


@query("x03_registered_rules", """
SELECT o_orderkey, concat_ws('; ', CASE WHEN o_totalprice > 400000 THEN 'large: ' || o_orderpriority END) AS errors,
 concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'pending' END) AS warnings FROM orders""")
def _(t):
    own = [rules.error("large", F.col("o_totalprice") > 400000, F.concat(F.lit("large: "), F.col("o_orderpriority"))),
           rules.warning("pending", F.col("o_orderstatus") == "P", "pending")]
    return out(rules.apply_rules(t.orders, own), "o_orderkey")


@query("f25_message_lists", f"""
SELECT product_id, CAST(coalesce(CAST(price <= 0 AS INT), 0) + CAST(trim(coalesce(brand, '')) = '' AS INT) AS INT) AS n FROM ({P}) p""")
def _(t):
    own = [rules.error("price", F.col("price") <= 0, "low"), rules.error("brand", ~filled(F.trim(F.col("brand"))), "none")]
    return products(t).select("product_id", F.size(rules.messages(own, "error")).alias("n"))


@query("a11_validation_summary", f"""
SELECT count(*) AS total_validated, count(*) FILTER (success) AS successful, round(count(*) FILTER (success) * 100.0 / count(*), 6) AS success_rate,
 count(*) FILTER (n_warn > 0) AS with_warnings, count(*) FILTER (n_err > 0) AS with_errors, round(avg(confidence), 6) AS average_confidence FROM ({LAYERED}) v""")
def _(t):
    return stats.validation_summary(validated(t))


_unnested = " UNION ALL ".join(f"SELECT product_id, {i} AS pos, {m} AS issue FROM ({P}) p WHERE {c}"
                               for i, (c, m) in enumerate(REQUIRED_SQL + FIELD_ERRORS_SQL))


@query("a12_common_issues", f"""
SELECT issue, count(*) AS count FROM ({_unnested}) u WHERE issue IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, min(product_id * 100 + pos) LIMIT 5""")
def _(t):
    return stats.common_issues(validated(t), "errors", ["product_id"], 5)
