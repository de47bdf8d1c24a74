"""Table cells, continuation rows, specification pages and nested JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import fixed, jsons, text
from catalign.operators import assemble
from catalign.plans import specbook
from catalign.workloads import query
from catalign.workloads.standins import MODELS, PACKAGES, PAGE_TEXT, TRACKS, pick, plain, quote
from catalign.workloads.w_text import rewrite_sql

T = plain(PAGE_TEXT)

# Twenty-row tables per block of parts: title, two header rows, then one row per part.
_codes = ["VBTA", "", "Deep Snow", "TGTP", "more", None]
CELLS = f"""
SELECT doc, CAST(1 AS INT) AS table_no, page, row_no, c0, c1, c2, c3, c4, c5 FROM (
 SELECT 'list' || CAST(CAST(floor(p_partkey / 200) AS BIGINT) AS STRING) AS doc, CAST(floor(p_partkey / 20) AS BIGINT) AS page,
  CAST(3 + p_partkey % 20 AS BIGINT) AS row_no, {pick('p_partkey', _codes)} AS c0, {pick('p_size', MODELS)} AS c1, {pick('p_partkey', PACKAGES)} AS c2,
  {pick('p_size', TRACKS)} AS c3, {pick('p_partkey', ['22 310,00 €', '', '12500', '9.990,50 €'])} AS c4, {pick('p_size', ['Black', '', None])} AS c5 FROM {{part}}
 UNION ALL SELECT 'list' || CAST(CAST(floor(p_partkey / 200) AS BIGINT) AS STRING), CAST(floor(p_partkey / 20) AS BIGINT), CAST(0 AS BIGINT), 'PRICE LIST', NULL, NULL, NULL, NULL, NULL FROM {{part}} WHERE p_partkey % 20 = 0
 UNION ALL SELECT 'list' || CAST(CAST(floor(p_partkey / 200) AS BIGINT) AS STRING), CAST(floor(p_partkey / 20) AS BIGINT), CAST(1 AS BIGINT), 'Tuote', 'Malli', 'Paketti', 'Telamatto', 'Suositushinta,', 'Väri' FROM {{part}} WHERE p_partkey % 20 = 0
 UNION ALL SELECT 'list' || CAST(CAST(floor(p_partkey / 200) AS BIGINT) AS STRING), CAST(floor(p_partkey / 20) AS BIGINT), CAST(2 AS BIGINT), 'nro', NULL, NULL, NULL, 'sis ALV:n', NULL FROM {{part}} WHERE p_partkey % 20 = 0
) x"""
CELL_FIELDS = ["model_code", "malli", "paketti", "telamatto", "price", "vari"]


def cells(t):
    """The rows of CELLS, each part read once: the first part of a block brings the heading rows of its table."""
    def row(number, *values):
        return F.struct(F.expr(number).cast("long").alias("row_no"), F.array(*[F.expr(v) for v in values]).alias("cells"))

    def text_row(number, *values):
        return row(str(number), *["CAST(NULL AS STRING)" if v is None else quote(v) for v in values])

    own = row("3 + p_partkey % 20", pick("p_partkey", _codes), pick("p_size", MODELS), pick("p_partkey", PACKAGES), pick("p_size", TRACKS),
              pick("p_partkey", ["22 310,00 €", "", "12500", "9.990,50 €"]), pick("p_size", ["Black", "", None]))
    heading = [text_row(0, "PRICE LIST", None, None, None, None, None), text_row(1, "Tuote", "Malli", "Paketti", "Telamatto", "Suositushinta,", "Väri"),
               text_row(2, "nro", None, None, None, "sis ALV:n", None)]
    page = F.floor(F.col("p_partkey") / 20).cast("long")
    made = t.part.select(F.concat(F.lit("list"), F.floor(F.col("p_partkey") / 200).cast("string")).alias("doc"), page.alias("table_no"), page.alias("page"),
                         F.explode(F.when(F.col("p_partkey") % 20 == 0, F.array(*heading, own)).otherwise(F.array(own))).alias("r"))
    return made.select("doc", "table_no", "page", "r.row_no", "r.cells")


RAW = f"""
SELECT doc, page, row_no, {', '.join(f"nullif(trim(c{i}), '') AS {n}" for i, n in enumerate(CELL_FIELDS))} FROM ({plain(CELLS)}) c
WHERE row_no >= 3 AND coalesce({', '.join(f"nullif(trim(c{i}), '')" for i in range(6))}) IS NOT NULL"""


@query("s03_raw_records", f"""
SELECT doc, page, row_no, {', '.join(CELL_FIELDS)}, regexp_replace(lower(coalesce(malli, '')), '[^\\w\\s-]', ' ', 'g') AS normalized_malli,
 coalesce(TRY_CAST(replace(regexp_replace(price, '[^\\d,.]', '', 'g'), ',', '.') AS DOUBLE), 0.0) AS price_value FROM ({RAW}) r""")
def _(t):
    return assemble.raw_records(cells(t)).select("doc", "page", "row_no", *CELL_FIELDS, "normalized_malli", "price_value")


@query("s04_keyword_records", f"""
SELECT doc, page, row_no, trim(c0) AS model_code, coalesce(trim(c1), '') AS model_name, coalesce(trim(c2), '') AS package, coalesce(trim(c3), '') AS track, coalesce(trim(c4), '') AS price_eur, coalesce(trim(c5), '') AS color
FROM ({plain(CELLS)}) c WHERE row_no > 1 AND coalesce(c0, '') <> ''""")
def _(t):
    out = assemble.keyword_records(cells(t))
    return out.select("doc", "page", "row_no", "model_code", "model_name", "package", "track", "price_eur", "color")


NUMBERED = f"""SELECT *, sum(CASE WHEN length(coalesce(model_code, '')) = 4 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY page, row_no) AS no FROM ({RAW}) r"""
_mf = ["malli", "paketti", "telamatto", "vari"]
MERGED = f"""
WITH m AS (SELECT *, row_number() OVER (PARTITION BY doc, no ORDER BY page, row_no) AS k FROM ({NUMBERED}) n WHERE no > 0 AND (length(coalesce(model_code, '')) = 4
  OR (coalesce(model_code, '') <> '' AND model_code NOT IN ({', '.join(map(quote, fixed.CATEGORY_ROWS))})) OR coalesce(malli, paketti, telamatto, vari) IS NOT NULL)),
 l AS (SELECT doc, no, max(model_code) FILTER (k = 1) AS model_code, count(*) AS n, {', '.join(f"list({f} ORDER BY k) FILTER ({f} IS NOT NULL) AS {f}" for f in _mf)} FROM m GROUP BY 1, 2)
SELECT doc, CAST(no AS BIGINT) AS product_no, model_code, {', '.join(f"coalesce(list_reduce({f}, lambda a, b: CASE WHEN a = b THEN a ELSE a || ' ' || b END), '') AS {f}" for f in _mf)}, CAST(n AS INT) AS merged_rows FROM l"""


@query("w03_continuation_merge", MERGED)
def _(t):
    rows = assemble.raw_records(cells(t))
    return assemble.merge_continuations(rows, fields=_mf, useful=_mf).select("doc", "product_no", "model_code", *_mf, "merged_rows")


@query("s05_page_text", r"""
SELECT doc_id, trim(regexp_replace(text, '\n\s*\n', chr(10) || chr(10), 'g')) AS text FROM documents WHERE length(trim(regexp_replace(text, '\n\s*\n', chr(10) || chr(10), 'g'))) > 50""")
def _(t):
    from catalign.sources.pages import clean_pages
    return clean_pages(t.documents).select("doc_id", "text")


# --- page rules --------------------------------------------------------------------------------------
LINES = f"(SELECT *, list_transform(string_split(text, chr(10)), lambda l: trim(l)) AS ls FROM ({T}) t)"


def last_sql(pattern: str, group: int = 1) -> str:
    return f"list_filter(list_transform(ls, lambda l: regexp_extract(l, '{pattern}', {group}, 'i')), lambda x: x <> '')[-1]"


@query("w06_last_value_wins", f"""
SELECT page, {', '.join(f"CAST({last_sql(f'{label}.*?([0-9]{{1,4}}) *{unit}')} AS INT) AS {n}" for n, label, unit in fixed.DIMENSION_LINES)} FROM {LINES} x""")
def _(t):
    return t.select(PAGE_TEXT).select("page", specbook.dimensions(F.col("text")).alias("d")).select("page", "d.*")


_found = "list_concat(" + ", ".join(f"regexp_extract_all(text, '{p}', 0, 'i')" for p in fixed.ENGINE_HEADINGS) + ")"
ENG = f"""SELECT *, list_filter(names, lambda x, i: list_position(list_transform(names, lambda y: {rewrite_sql('y')}), {rewrite_sql('x')}) = i) AS engines FROM (
 SELECT *, list_transform({_found}, lambda m: trim(regexp_replace(m, '[®\\s]+', ' ', 'g'))) AS names FROM {LINES} x) y"""
_cool = "list_filter(ls, lambda l: contains(lower(l), 'liquid-cooled'))"
ENGINE_SQL = {
    "cooling": f"CASE WHEN len({_cool}) > 0 THEN 'liquid-cooled' END",
    "type": f"list_filter(list_transform({_cool}, lambda l: CASE WHEN contains(lower(l), 'two-stroke') THEN '2-stroke' WHEN contains(lower(l), 'four-stroke') THEN '4-stroke' END), lambda x: x IS NOT NULL)[-1]",
    "displacement": f"CAST(floor(CAST({last_sql('([0-9]+) *- *([0-9]+[.]?[0-9]*) *cc', 2)} AS DOUBLE)) AS INT)",
    "bore_stroke": f"{last_sql('([0-9]+[.]?[0-9]*) *x *([0-9]+[.]?[0-9]*) *mm', 1)} || ' x ' || {last_sql('([0-9]+[.]?[0-9]*) *x *([0-9]+[.]?[0-9]*) *mm', 2)} || ' mm'",
    "fuel_system": f"trim({last_sql('fuel system +(.*)')})",
    "fuel_type": "CASE WHEN contains(lower(text), 'premium unleaded') THEN 'Premium unleaded - 95' END",
    "fuel_tank_l": f"CAST({last_sql('fuel tank.*?([0-9]+)')} AS INT)",
}


@query("f18_engine_values", f"SELECT page, array_to_string(engines, '|') AS engines, {', '.join(f'{x} AS {chr(34)}{n}{chr(34)}' for n, x in ENGINE_SQL.items())} FROM ({ENG}) e")
def _(t):
    body = F.col("text")
    read = t.select(PAGE_TEXT).select("page", F.array_join(specbook.engine_names(body), "|").alias("engines"),
                                      specbook.engine_values(body).alias("v"))
    return read.select("page", "engines", *[F.col(f"v.{n}") for n in ENGINE_SQL])


_tr = [f"regexp_extract_all(text, '{fixed.TRACK_LINE}', {i})" for i in range(1, 5)]
TRACKS_SQL = f"""SELECT page, text, list_filter(tr, lambda x, i: list_position(tr, x) = i) AS tracks FROM (
 SELECT *, list_transform({_tr[0]}, lambda n, i: upper(trim(n)) || '|' || CAST({_tr[1]}[i] AS INT) || 'x' || CAST({_tr[2]}[i] AS INT) || 'x' || CAST({_tr[3]}[i] AS DOUBLE)) AS tr FROM ({T}) t) x"""


@query("f19_track_options", f"SELECT page, array_to_string(tracks, ';') AS tracks FROM ({TRACKS_SQL}) k")
def _(t):
    shown = F.transform(specbook.track_options(F.col("text")), lambda x: F.concat(
        F.upper(x["name"]), F.lit("|"), F.concat_ws("x", x["length_inch"], x["width_inch"], x["profile_inch"])))
    return t.select(PAGE_TEXT).select("page", F.array_join(shown, ";").alias("tracks"))


SECTIONS = f"""
WITH l AS (SELECT page, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM {LINES} x),
 h AS (SELECT *, CASE WHEN contains(lower(line), 'what''s new') THEN 'whats_new' WHEN contains(lower(line), 'package highlights') THEN 'package_highlights' WHEN contains(lower(line), 'features') AND line = upper(line) THEN 'features' END AS head FROM l),
 s AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY page ORDER BY k) AS section FROM h),
 i AS (SELECT page, section, k, trim(regexp_replace(line, '^[•�]\\s*', '')) AS item FROM s WHERE head IS NULL AND section IS NOT NULL AND regexp_matches(line, '^[•�]')),
 d AS (SELECT page, section, min(k) AS k, min_by(item, k) AS item FROM i WHERE item <> '' GROUP BY page, section, regexp_replace(regexp_replace(upper(trim(item)), '[^A-Z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))
SELECT page, {', '.join(f"coalesce(string_agg(item, '|' ORDER BY k) FILTER (section = '{n}'), '') AS {n}" for n in ('features', 'whats_new', 'package_highlights'))}
FROM (SELECT page, section, k, item FROM d UNION ALL SELECT page, NULL, NULL, NULL FROM ({T}) t) z GROUP BY page"""


@query("w05_section_lists", SECTIONS)
def _(t):
    lists = t.select(PAGE_TEXT).select("page", specbook.feature_lists(F.col("text")).alias("l"))
    return lists.select("page", *[F.array_join(f"l.{n}", "|").alias(n) for n in ("features", "whats_new", "package_highlights")])


@query("w07_code_and_next_line", """
SELECT doc_id, ls[k] AS own, ls[k + 1] AS following FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, list_position(list_transform(string_split(text, chr(10)), lambda l: contains(l, 'the')), true) AS k FROM documents) x WHERE k > 0""")
def _(t):
    own, following = text.code_lines(F.col("text"), F.lit("the"))
    return t.documents.select("doc_id", own.alias("own"), following.alias("following")).filter(F.col("own").isNotNull())


def spec_pages(t):
    kind = text.page_kind(F.col("doc"))
    return t.select(PAGE_TEXT).withColumns({"brand": kind["brand"], "model_year": F.lit(2026)})


def _titles():
    from catalign.workloads.w_text import BARE, _any, title_sql
    return f"""SELECT page, doc, text, {title_sql(2)} AS model, {title_sql(3)} AS configuration, {title_sql(4)} AS category FROM {BARE} b
     WHERE {_any('upper(text)', fixed.PAGE_ENGINE_WORDS)} AND {_any('bare', fixed.PAGE_MODEL_WORDS)}"""


@query("f21_nested_specification", f"""
SELECT s.page, CASE WHEN contains(s.doc, 'LYNX') THEN 'LYNX' ELSE 'SKIDOO' END || '-' || upper(replace(model, ' ', '-')) || CASE WHEN configuration <> 'Base' THEN '-' || upper(replace(configuration, ' ', '-')) ELSE '' END || '-2026' AS sku,
 category, CAST(len(engines) AS INT) AS engines, engines[1] AS first_engine, {last_sql('dry weight.*?([0-9]{1,4}) *kg')} AS weight FROM ({_titles()}) s JOIN ({ENG}) e ON e.page = s.page WHERE model IS NOT NULL""")
def _(t):
    out = specbook.extract_pages(spec_pages(t))
    e = F.col("specifications.engines")
    named = F.filter(e, lambda x: x["name"] != "Standard Engine")
    return out.select(F.col("source_page").alias("page"), "sku", "category", F.size(named).alias("engines"), F.get(named, F.lit(0))["name"].alias("first_engine"),
                      F.col("specifications.dimensions.dry_weight_kg").cast("string").alias("weight"))


@query("t09_specbook_pages", f"""
SELECT model, configuration, count(*) AS pages FROM ({_titles()}) s WHERE model IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return specbook.extract_pages(spec_pages(t)).groupBy("model", "configuration").agg(F.count("*").alias("pages"))


# --- nested JSON ----------------------------------------------------------------------------------------
# « and » stand for the braces of the JSON text
SPEC_JSON = f"""
SELECT p_partkey, '«"basicInfo":«"brand":"' || p_brand || '","model":"' || p_name || '","modelYear":' || CAST(2019 + p_size % 7 AS STRING) || '»,"marketingContent":«"whatsNew":' ||
 CASE WHEN p_size % 3 = 0 THEN '[]' ELSE '["' || p_type || '","new"]' END || '»,"engines":[' ||
 CASE WHEN p_size % 4 = 0 THEN '' ELSE '«"name":"850 E-TEC","displacement":849,"turbo":false»,«"name":"' || p_type || '","displacement":' || CAST(500 + p_size AS STRING) || ',"turbo":' || CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END || '»' END ||
 '],"weight":«"min":' || CAST(190 + p_size AS STRING) || ',"max":' || CAST(200 + p_size * 2 AS STRING) || '»,"dimensions":«"overall":«"length":"3000"»,"skiStance":"1097"»,"suspension":«"front":«"type":"' ||
 {pick('p_partkey', ['RAS 3', 'LFS-R', 'Wide'])} || '"»»,"pricing":«"msrp":' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) || ',"currency":"EUR"»»' AS spec FROM {{part}}"""


def spec_json(t):
    return t.select(SPEC_JSON.replace("«", "{{").replace("»", "}}"))


J = plain(SPEC_JSON).replace("«", "{").replace("»", "}")


def _jp(path, is_array: bool, kind: str | None) -> str:
    p = "$." + ".".join(path)
    if is_array:
        return f"nullif(CAST(json_extract(spec, '{p}') AS VARCHAR), '[]')"
    value = f"json_extract_string(spec, '{p}')"
    return f"CAST({value} AS {kind})" if kind else value


_cols = [("_".join(jsons.snake(s) for s in p), _jp(p, a, {"int": "INT", "double": "DOUBLE"}.get(jsons.NUMBERS.get("_".join(jsons.snake(s) for s in p), ""))))
         for p, a in jsons.spec_paths()]


@query("f20_flat_specification", f"SELECT p_partkey, spec AS full_llm_json, {', '.join(f'{x} AS {n}' for n, x in _cols)} FROM ({J}) j")
def _(t):
    return spec_json(t).select("p_partkey", *jsons.flatten_spec(F.col("spec")))


@query("k07_wide_specification_rows", f"SELECT basic_info_brand, count(*) AS rows, max(weight_max) AS heaviest FROM (SELECT {', '.join(f'{x} AS {n}' for n, x in _cols)} FROM ({J}) j) f GROUP BY 1")
def _(t):
    from catalign.session import shared_dir
    from catalign.sources import sinks
    path = shared_dir(t.spark, "specs")
    sinks.append_rows(spec_json(t).select(*jsons.flatten_spec(F.col("spec"))), path)
    return t.spark.read.parquet(path).groupBy("basic_info_brand").agg(F.count("*").alias("rows"), F.max("weight_max").alias("heaviest"))


@query("p11_indexed_columns", f"""
SELECT p_partkey, CAST(json_extract_string(spec, '$.engines[0].displacement') AS INT) AS primary_displacement, CAST(json_extract_string(spec, '$.weight.min') AS INT) AS min_dry_weight_kg,
 CAST(json_extract_string(spec, '$.weight.max') AS INT) AS max_dry_weight_kg, CAST(json_extract_string(spec, '$.pricing.msrp') AS DECIMAL(10,2)) AS msrp,
 list_contains(json_extract_string(spec, '$.engines[*].turbo'), 'true') AS has_turbo, CAST(json_array_length(spec, '$.engines') AS INT) AS engine_count FROM ({J}) j""")
def _(t):
    return spec_json(t).select("p_partkey", *[c.alias(n) for n, c in jsons.indexed_columns(F.col("spec")).items()])


@query("p12_path_queries", f"""
SELECT p_partkey, array_to_string(json_extract_string(spec, '$.engines[*].name'), '|') AS engine_names, json_extract_string(spec, '$.suspension.front.type') AS front_suspension FROM ({J}) j
WHERE CAST(json_extract_string(spec, '$.weight.min') AS INT) <= 230 AND CAST(json_extract_string(spec, '$.weight.max') AS INT) >= 220
 AND (json_extract_string(spec, '$.suspension.front.type') LIKE '%LFS-R%' OR json_extract_string(spec, '$.suspension.front.type') LIKE '%RAS%')""")
def _(t):
    spec = F.col("spec")
    values, fast = jsons.path_values(spec), jsons.indexed_columns(spec)
    rows = spec_json(t).withColumns({**values, "low": fast["min_dry_weight_kg"], "high": fast["max_dry_weight_kg"]})
    kind = F.col("front_suspension")
    rows = rows.filter((F.col("low") <= 230) & (F.col("high") >= 220) & (kind.like("%LFS-R%") | kind.like("%RAS%")))
    return rows.select("p_partkey", F.array_join("engine_names", "|").alias("engine_names"), "front_suspension")


RESPONSES = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN '[' || props || ',' || props || ']' WHEN 1 THEN '```json' || chr(10) || '[' || props || ']' || chr(10) || '```'
 WHEN 2 THEN '{{"articles":[' || props || ']}}' WHEN 3 THEN 'Here you go: [' || props || '] done' ELSE 'broken [' || props END AS response FROM {events}"""


def responses(t):
    return t.spark.sql(RESPONSES.replace("{events}", "{src}"), src=t.events)


@query("f22_response_items", f"""
SELECT event_id, n, CASE WHEN n > 0 THEN json_extract_string(props, '$.k') END AS k FROM (SELECT event_id, props, CAST(CASE event_id % 5 WHEN 0 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS INT) AS n FROM events) e""")
def _(t):
    items = jsons.response_items(F.col("response"))
    return responses(t).select("event_id", F.size(items).alias("n"), F.try_element_at(F.get(items, F.lit(0)), F.lit("k")).alias("k"))


@query("f36_batch_usage_split", """
SELECT event_id, event_id % 3 > 0 AS success, CAST(CASE WHEN event_id % 3 > 0 THEN 2 ELSE 3 END AS INT) AS results, CAST(CASE WHEN event_id % 3 > 0 THEN floor(user_id / 2) * 2 ELSE 0 END AS BIGINT) AS tokens FROM events""")
def _(t):
    item = F.concat(F.lit('{"enrichment_result":'), F.col("props"), F.lit(',"confidence":0.9}'))
    reply = F.concat(F.lit("["), item, F.lit(","), item, F.lit("]"))
    expected = F.when(F.col("event_id") % 3 > 0, 2).otherwise(3)
    split = t.events.withColumn("r", jsons.batch_results(reply, expected, F.col("user_id"), F.col("value")))
    return split.select("event_id", F.get("r", F.lit(0))["success"].alias("success"), F.size("r").alias("results"),
                        F.aggregate("r", F.lit(0).cast("long"), lambda s, x: s + x["tokens"]).alias("tokens"))


@query("f37_valid_options", """
SELECT event_id, CAST(CASE WHEN event_type = 'click' THEN 2 ELSE 1 END AS INT) AS kept, CASE WHEN event_type = 'view' THEN CAST(0.7 AS DOUBLE) ELSE least(1.0, value) END AS confidence FROM events""")
def _(t):
    good = '{"option_type":"t","description":"d","confidence":0.9}'
    second = F.when(F.col("event_type") == "click", F.lit(good)).otherwise(F.lit('{"option_type":"t","confidence":0.5}'))
    score = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(F.lit(',"overall_confidence":'), F.col("value").cast("string")))
    reply = F.concat(F.lit('{"detected_options":[' + good + ","), second, F.lit("]"), score, F.lit("}"))
    out = jsons.valid_options(reply)
    return t.events.select("event_id", F.size(out["options"]).alias("kept"), out["confidence"].alias("confidence"))


@query("f47_page_groups", """
SELECT event_id, json_extract_string(props, '$.k') AS displacement, event_type AS model, CASE WHEN value > 50 THEN 'red' END AS colors FROM events""")
def _(t):
    spec = F.concat(F.lit('{"engine":{"name":"'), F.col("event_type"), F.lit('","displacement_info":'), F.get_json_object("props", "$.k"), F.lit('},"track":{"length":"154"}}'))
    done = F.when(F.col("value") > 50, '{"applied_modifications":{"color_changes":"red"}}').otherwise("{}")
    groups = jsons.page_groups(spec, done)
    return t.events.select("event_id", groups["engine"]["displacement"].alias("displacement"), groups["engine"]["model"].alias("model"),
                           groups["applied"]["color_changes"].alias("colors"))
