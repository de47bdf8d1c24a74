"""Scalar text, price and clock rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import clock, fixed, prices, text
from catalign.workloads import query
from catalign.workloads.standins import CATALOG, ENGINES, ENTRIES, PAGE_TEXT, PRODUCTS, pick, plain, quote

P, E, T, C = plain(PRODUCTS), plain(ENTRIES), plain(PAGE_TEXT), plain(CATALOG)


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def model_sql(c: str) -> str:
    x = squeeze(f"regexp_replace(coalesce({c}, ''), '[®™©]', '', 'g')")
    for old, new in fixed.MODEL_SPELLINGS:
        x = f"replace({x}, '{old}', '{new}')"
    return f"upper(trim({x}))"


def package_sql(c: str) -> str:
    return "upper(" + squeeze(f"regexp_replace(coalesce({c}, ''), '\\b(PACKAGE|WITH|AND)\\b', '', 'gi')") + ")"


def engine_sql(c: str) -> str:
    shape = r"(\d{3,4})\s*(R?)\s*(E-TEC|ACE|ETEC)\s*(TURBO\s*R?)?"
    g = [f"regexp_extract(coalesce({c}, ''), '{shape}', {i}, 'i')" for i in range(5)]
    return (f"CASE WHEN {g[1]} <> '' THEN trim({g[1]} || {g[2]} || ' ' || upper(replace({g[3]}, '-', '')) || "
            f"CASE WHEN {g[4]} <> '' THEN ' ' || upper(trim({g[4]})) ELSE '' END) ELSE upper(trim(coalesce({c}, ''))) END")


def first_sql(c: str, words) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, {quote(w)}) THEN {quote(w)}" for w in words) + " END"


@query("f07_normal_names", f"""
SELECT product_id, {model_sql('malli')} AS model, {package_sql('paketti')} AS package, {engine_sql('moottori')} AS engine FROM ({P}) p""")
def _(t):
    return t.select(PRODUCTS).select("product_id", text.model_text(F.col("malli")).alias("model"),
                                     text.package_text(F.col("paketti")).alias("package"),
                                     text.engine_text(F.col("moottori")).alias("engine"))


def part_sql(c: str, x: str) -> str:
    return f"CASE WHEN coalesce({c}, '') <> '' THEN {x} END"


@query("f08_search_text", f"""
SELECT product_id AS id, trim(concat_ws(' ', nullif(brand, ''), {part_sql('malli', model_sql('malli'))}, {part_sql('paketti', package_sql('paketti'))},
 {part_sql('moottori', engine_sql('moottori'))}, CAST(model_year AS VARCHAR))) AS search_text FROM ({P}) p
UNION ALL SELECT -1 - position, trim(concat_ws(' ', {model_sql('model_family')}, feature, {engine_sql('engine')}, nullif(brand, ''))) FROM ({C}) c""")
def _(t):
    own = t.select(PRODUCTS).select(F.col("product_id").alias("id"), text.product_search_text(
        F.col("brand"), F.col("malli"), F.col("paketti"), F.col("moottori"), F.col("model_year")).alias("search_text"))
    cat = t.select(CATALOG).select((-1 - F.col("position")).alias("id"), text.catalog_search_text(
        F.col("model_family"), F.array("feature"), F.array("engine"), F.col("brand")).alias("search_text"))
    return own.unionByName(cat)


HEADS = ["Tuote- nro", "Malli", "Paketti", "Moottori", "Telamatto", "", "Käynnistin", "Mittaristo", "Kevätoptiot", "Väri",
         "Suositushinta, sis ALV:n", "engine spec", "Gauge", "price list", "Track model"]


def header_sql(c: str, rules) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({c}, {quote(w)})" for w in words) + f" THEN '{field}'" for words, field in rules) + " END"


@query("f09_header_fields", f"""
SELECT p_partkey, {header_sql('head', fixed.TABLE_HEADERS)} AS table_field, {header_sql('lower(head)', fixed.KEYWORD_HEADERS)} AS keyword_field
FROM (SELECT p_partkey, {pick('p_partkey', HEADS)} AS head FROM part) p""")
def _(t):
    head = t.select(f"SELECT p_partkey, {pick('p_partkey', HEADS)} AS head FROM {{part}}")
    return head.select("p_partkey", text.header_field(F.col("head"), fixed.TABLE_HEADERS).alias("table_field"),
                       text.header_field(F.lower("head"), fixed.KEYWORD_HEADERS).alias("keyword_field"))


@query("f10_field_text", r"""
SELECT doc_id, regexp_replace(lower(trim(text)), '[^\p{L}\p{M}\p{N}_\s-]', ' ', 'g') AS normal FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.field_text(F.col("text")).alias("normal"))


NAMES = [*[e or "" for e in ENGINES], "850 E-TEC® Turbo R with WIS", "600R E TEC", "900 A.C.E. turbocharged", "600 Fuel Injection",
         "the 850/E-TEC and Turbo Charged", "998cc – Turbo"]


def rewrite_sql(c: str) -> str:
    x = f"regexp_replace(upper({c}), '[®™℠©•�]', '', 'g')"
    for shape, instead in fixed.ENGINE_REWRITES:
        x = f"regexp_replace({x}, '{shape}', '{instead}', 'g')"
    x = squeeze(f"regexp_replace({x}, '[^A-Z0-9\\s]', '', 'g')")
    return f"regexp_replace({x}, '\\s*(\\d+)\\s*', '\\1', 'g')"


@query("f11_engine_name", f"""
SELECT p_partkey, {rewrite_sql('name')} AS engine FROM (SELECT p_partkey, {pick('p_partkey', NAMES)} || ' ' || p_type AS name FROM part) p""")
def _(t):
    named = t.select(f"SELECT p_partkey, {pick('p_partkey', NAMES)} || ' ' || p_type AS name FROM {{part}}")
    return named.select("p_partkey", text.engine_name(F.col("name")).alias("engine"))


# price texts in the shapes price lists use, around each order's total
PRICE_TEXT = f"""
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || ',50 €'
 WHEN 1 THEN '12.345,50' WHEN 2 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) WHEN 3 THEN ''
 WHEN 4 THEN 'N/A' ELSE 'EUR ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '.25 (sis ALV:n)' END AS price_text FROM {{orders}}"""


@query("f12_price_digits", f"""
SELECT o_orderkey, coalesce(TRY_CAST(replace(regexp_replace(price_text, '[^\\d,.]', '', 'g'), ',', '.') AS DOUBLE), 0.0) AS price FROM ({plain(PRICE_TEXT)}) p""")
def _(t):
    return t.select(PRICE_TEXT).select("o_orderkey", prices.price_digits(F.col("price_text")).alias("price"))


@query("f13_price_number", f"""
SELECT o_orderkey, TRY_CAST(replace(regexp_extract(b, '[\\d.,]+'), ',', '.') AS DOUBLE) AS price,
 TRY_CAST(replace(regexp_extract(CASE WHEN contains(b, ',') THEN replace(b, '.', '') ELSE b END, '[\\d.,]+'), ',', '.') AS DOUBLE) AS price_fi
FROM (SELECT o_orderkey, regexp_replace(regexp_replace(price_text, '€|EUR', '', 'g'), '\\s', '', 'g') AS b FROM ({plain(PRICE_TEXT)}) p) q""")
def _(t):
    c = F.col("price_text")
    return t.select(PRICE_TEXT).select("o_orderkey", prices.price_number(c).alias("price"), prices.price_number(c, "fi").alias("price_fi"))


CODE_PAGE = f"""
SELECT o_orderkey, 'VBTA' AS code, CASE o_orderkey % 5
 WHEN 0 THEN 'Deep Snow' || chr(10) || 'VBTA Freeride 850 E-TEC Turbo R 154in 3900mm 2.5in 64mm PowderMax' || chr(10) || CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS STRING) || '.310 € Scandi Blue'
 WHEN 1 THEN 'VBTA Summit X Expert Package 850 E-TEC ' || CAST(10 + CAST(floor(o_totalprice) AS BIGINT) % 90 AS STRING) || '.310.50€ Electric 10.25 in. Color Touchscreen Display Black'
 WHEN 2 THEN 'no code on this page' WHEN 3 THEN 'x VBTA Expedition SE 900 ACE Turbo R Manual Terra Green Color Terra Green 7.2 in. Digital Display'
 ELSE 'intro' || chr(10) || 'VBTA Rave RE 600R E-TEC 137in 3500mm 1.5in 38mm Cobra' || chr(10) || 'White Spring 1' || CAST(1000 + CAST(floor(o_totalprice) AS BIGINT) % 9000 AS STRING) || ',00 €' END AS text
FROM {{orders}}"""
_page = f"(SELECT *, string_split(text, chr(10)) AS lines FROM ({plain(CODE_PAGE)}) p)"
_at = "list_position(list_transform(lines, lambda l: contains(l, code)), true)"
CODE_LINES = f"SELECT *, CASE WHEN coalesce({_at}, 0) > 0 THEN lines[{_at}] END AS own, CASE WHEN coalesce({_at}, 0) > 0 THEN lines[{_at} + 1] END AS following FROM {_page} q"


def euro_sql(c: str) -> str:
    g = f"regexp_extract({c}, '(\\d{{1,3}}(?:[.,\\s]\\d{{3}})*(?:[.,]\\d{{2}})?)\\s*€', 1)"
    v = f"replace({g}, ',', '.')"
    fixed_v = f"CASE WHEN NOT contains(right({v}, 3), '.') AND length({v}) > 3 THEN left({v}, length({v}) - 2) || '.' || right({v}, 2) ELSE {v} END"
    return f"CASE WHEN TRY_CAST({fixed_v} AS DOUBLE) > 15000 THEN TRY_CAST({fixed_v} AS DOUBLE) END"


@query("f14_price_near_code", f"SELECT o_orderkey, coalesce({euro_sql('own')}, {euro_sql('following')}, 0.0) AS price FROM ({CODE_LINES}) c")
def _(t):
    return t.select(CODE_PAGE).select("o_orderkey", prices.price_near_code(F.col("text"), F.col("code")).alias("price"))


_both = "(own || ' ' || coalesce(following, ''))"
_lf = {n: first_sql(_both, w) for n, w in fixed.LINE_WORDS.items()}
_lf["vari"] = f"replace({_lf['vari']}, ' Color ', ' ')"
_lf["telamatto"] = (f"CASE WHEN regexp_matches({_both}, '(\\d+)in\\s*(\\d+)mm') THEN regexp_extract({_both}, '(\\d+)in\\s*(\\d+)mm', 1) || 'in/' || "
                    f"regexp_extract({_both}, '(\\d+)in\\s*(\\d+)mm', 2) || 'mm' END")
_lf["kevatoptiot"] = "'Contains ' || " + "(CASE " + " ".join(
    f"WHEN contains(lower({_both}), '{w.lower()}') THEN '{w.lower()}'" for w in fixed.OPTION_WORDS) + " END) || ' modifications'"


@query("f15_line_fields", f"SELECT o_orderkey, {', '.join(f'{x} AS {n}' for n, x in _lf.items())} FROM ({CODE_LINES}) c")
def _(t):
    made = text.line_fields(F.col("text"), F.col("code"))
    return t.select(CODE_PAGE).select("o_orderkey", *[c.alias(n) for n, c in made.items()])


_ts = r"(\d+)in.*?(\d+)mm.*?(\d+\.?\d*)in.*?(\d+)mm\s+([A-Za-z\s]+)"
_tg = [f"regexp_extract(text, '{_ts}', {i})" for i in range(6)]


@query("f16_page_fields", f"""
SELECT o_orderkey, CASE WHEN contains(own, 'Expedition SE') THEN 'Ski-Doo Expedition SE 900 ACE Turbo R' WHEN contains(own, 'Summit X') THEN 'Ski-Doo Summit X 850 E-TEC Turbo R' ELSE 'Unknown Model (' || code || ')' END AS model_name,
 {first_sql('text', ['900 ACE Turbo R', '850 E-TEC Turbo R'])} AS engine, CAST(CASE WHEN contains(text, '900 ACE Turbo R') THEN 899 WHEN contains(text, '850 E-TEC Turbo R') THEN 849 END AS INT) AS engine_cc,
 {first_sql('text', fixed.PAGE_DISPLAYS)} AS display, {first_sql('text', fixed.PAGE_COLORS)} AS color,
 CASE WHEN {_tg[1]} <> '' THEN {_tg[1]} || 'in ' || {_tg[2]} || 'mm ' || {_tg[3]} || 'in ' || {_tg[4]} || 'mm ' || regexp_replace({_tg[5]}, '^\\s+|\\s+$', '', 'g') END AS track
FROM ({CODE_LINES}) c""")
def _(t):
    made = text.page_fields(F.col("text"), F.col("code"))
    return t.select(CODE_PAGE).select("o_orderkey", *[c.alias(n) for n, c in made.items()])


def title_sql(i: int) -> str:
    arms = []
    for title in fixed.PAGE_TITLES:
        cond = f"contains(bare, '{title[0]}')"
        if title[1]:
            cond += f" AND NOT regexp_matches(regexp_extract(bare, '.*{title[0]}(.*)$', 1), '{title[1]}')"
        arms.append(f"WHEN {cond} THEN {quote(title[i])}")
    return "CASE " + " ".join(arms) + " END"


BARE = f"(SELECT *, regexp_replace(upper(text), '[^A-Z0-9]+', '', 'g') AS bare FROM ({T}) t)"


@query("f17_page_title", f"SELECT page, {title_sql(2)} AS model, {title_sql(3)} AS configuration, {title_sql(4)} AS category FROM {BARE} b")
def _(t):
    return t.select(PAGE_TEXT).select("page", text.page_title(F.col("text")).alias("title")).select("page", "title.*")


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


@query("p09_relevant_pages", f"""
SELECT page FROM {BARE} b WHERE {_any('upper(text)', fixed.PAGE_ENGINE_WORDS)} AND {_any('bare', fixed.PAGE_MODEL_WORDS)}""")
def _(t):
    return t.select(PAGE_TEXT).filter(text.page_is_relevant(F.col("text"))).select("page")


@query("f29_listing_price", f"""
SELECT product_id, CASE WHEN price > 0 THEN CAST(round_even(CASE WHEN currency = 'EUR' THEN price * 100 ELSE price END, 0) AS BIGINT) END AS roubles FROM ({P}) p""")
def _(t):
    return t.select(PRODUCTS).select("product_id", prices.listing_price(F.col("price"), F.col("currency")).alias("roubles"))


@query("f30_listing_texts", f"""
SELECT product_id, concat_ws(' ', brand, nullif(malli, ''), nullif(paketti, '')) AS full_name,
 CASE WHEN coalesce(price, 0) <> 0 AND currency = 'EUR' THEN format('{{:,.2f}}', price) || '€' WHEN coalesce(price, 0) <> 0 AND currency = 'RUB' THEN format('{{:,}}', CAST(round_even(price, 0) AS BIGINT)) || '₽' ELSE 'Price not available' END AS display_price,
 concat_ws(' ', nullif(brand, ''), nullif(malli, ''), CAST(model_year AS VARCHAR), nullif(paketti, '')) AS title,
 concat_ws(chr(10), 'Model Code: ' || model_code, 'Engine: ' || nullif(moottori, ''), 'Track: ' || nullif(telamatto, ''), 'Starter: ' || nullif(kaynnistin, ''), 'Gauge: ' || nullif(mittaristo, ''), 'Color: ' || nullif(vari, ''))
  || chr(10) || chr(10) || 'Features:' || chr(10) || '• Wide' || chr(10) || '• ' || model_code AS description FROM ({P}) p""")
def _(t):
    c = F.col
    labels = {"Engine": c("moottori"), "Track": c("telamatto"), "Starter": c("kaynnistin"), "Gauge": c("mittaristo"), "Color": c("vari")}
    return t.select(PRODUCTS).select(
        "product_id", prices.full_name(c("brand"), c("malli"), c("paketti")).alias("full_name"),
        prices.display_price(c("price"), c("currency")).alias("display_price"),
        prices.listing_title(c("model_code"), c("brand"), c("malli"), c("model_year"), c("paketti")).alias("title"),
        prices.listing_description(c("model_code"), labels, F.array(F.lit("Wide"), c("model_code"))).alias("description"))


FILES = ["LYNX_2025_PRICE_LIST.pdf", "SKI-DOO_MY26_PRICE_LIST.pdf", "SKIDOO_2024_PRICE_LIST.pdf", "other.pdf", "LYNX 2026 SPEC BOOK.pdf", "Lynx-1999.pdf"]
FILE_SQL = f"SELECT p_partkey, {pick('p_partkey', FILES)} AS file FROM {{part}}"
BRAND_SQL = "CASE WHEN starts_with(upper(file), 'LYNX') THEN 'LYNX' WHEN contains(upper(file), 'SKI-DOO') OR contains(upper(file), 'SKIDOO') THEN 'SKI-DOO' END"
YEAR_SQL = (r"CASE WHEN regexp_matches(file, 'MY(\d{2})') THEN '20' || regexp_extract(file, 'MY(\d{2})', 1) WHEN regexp_matches(file, '20\d{2}') "
            r"THEN regexp_extract(file, '20\d{2}') WHEN regexp_matches(file, '\d{4}') THEN regexp_extract(file, '\d{4}') ELSE '2024' END")


@query("s01_file_name_parts", f"SELECT p_partkey, {BRAND_SQL} AS brand, {YEAR_SQL} AS year FROM ({plain(FILE_SQL)}) f")
def _(t):
    return t.select(FILE_SQL).select("p_partkey", text.file_brand(F.col("file")).alias("brand"), text.file_year(F.col("file")).alias("year"))


@query("f33_page_kind", f"""
SELECT p_partkey, CASE WHEN contains(file, 'SPEC BOOK') THEN 'spec_book' ELSE 'price_list' END AS doc_type, CASE WHEN contains(file, 'LYNX') THEN 'LYNX' ELSE 'SKIDOO' END AS brand,
 coalesce(nullif(regexp_extract(file, '20\\d{{2}}'), ''), 'unknown') AS year FROM ({plain(FILE_SQL)}) f""")
def _(t):
    return t.select(FILE_SQL).select("p_partkey", *[c.alias(n) for n, c in text.page_kind(F.col("file")).items()])


@query("f34_token_estimate", """
SELECT doc_id, CAST(floor(length(text) / 4) AS BIGINT) AS tokens, CAST(floor(length(text) / 4) AS BIGINT) + 2000 AS request_tokens FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.token_estimate(F.col("text")).alias("tokens"), text.token_estimate(F.col("text"), 2000).alias("request_tokens"))


@query("f35_usage_cost", """
SELECT conv_id, turn, CAST(CAST(length(text) AS DECIMAL(18,0)) * 0.25 / 1000000 + CAST(turn AS DECIMAL(18,0)) * 1.25 / 1000000 AS DECIMAL(18,8)) AS cost FROM conversations""")
def _(t):
    return t.conversations.select("conv_id", "turn", prices.usage_cost(F.length("text"), F.col("turn")).alias("cost"))


_hints = ", ".join(f"CASE WHEN regexp_matches(lower(text), '{s}') THEN '{h}' END" for h, s in fixed.HINT_SHAPES)


@query("f38_validation_hints", f"SELECT doc_id, concat_ws('|', {_hints}) AS hints FROM documents")
def _(t):
    return t.documents.select("doc_id", F.array_join(text.validation_hints(F.col("text")), "|").alias("hints"))


@query("f39_measures", """
SELECT p_partkey, round(p_size / 25.4, 6) AS inches, round(CAST(p_size * 25.4 AS DOUBLE), 6) AS mm, CASE WHEN p_size % 2 = 0 THEN '€' || format('{:,.2f}', p_retailprice) ELSE format('{:,.2f}', p_retailprice) || ' SEK' END AS price FROM part""")
def _(t):
    currency = F.when(F.col("p_size") % 2 == 0, "EUR").otherwise("SEK")
    return t.part.select("p_partkey", F.round(prices.mm_to_inches(F.col("p_size")), 6).alias("inches"),
                         F.round(prices.inches_to_mm(F.col("p_size")), 6).alias("mm"), prices.market_price(F.col("p_retailprice"), currency).alias("price"))


_s = [f"date_trunc('day', ts) + INTERVAL {int(x[:2])} HOUR" for x in fixed.SLOTS]
_next = "coalesce(" + ", ".join(f"CASE WHEN {s} > ts THEN {s} END" for s in _s) + f", {_s[0]} + INTERVAL 1 DAY)"
_nname = "coalesce(" + ", ".join(f"CASE WHEN {s} > ts THEN '{n}' END" for s, n in zip(_s, fixed.SLOTS)) + ", '03:00 (next day)')"
_act = "coalesce(" + ", ".join(f"CASE WHEN {s} <= ts AND ts <= {s} + INTERVAL 60 MINUTE THEN '{n}' END" for s, n in zip(_s, fixed.SLOTS)) + ")"
_left = "coalesce(" + ", ".join(f"CASE WHEN {s} <= ts AND ts <= {s} + INTERVAL 60 MINUTE THEN (epoch_us({s} + INTERVAL 60 MINUTE) - epoch_us(ts)) / 60000000.0 END" for s in _s) + ")"


@query("f40_processing_slots", f"""
SELECT event_id, strftime({_next}, '%Y-%m-%d %H:%M') AS next_start, {_nname} AS next_window, {_act} AS active_window, round(CAST({_left} AS DOUBLE), 4) AS minutes_left FROM events""")
def _(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.date_format(clock.next_window(ts), "yyyy-MM-dd HH:mm").alias("next_start"),
                           clock.next_window_name(ts).alias("next_window"), clock.active_window(ts).alias("active_window"),
                           F.round(clock.minutes_left(ts), 4).alias("minutes_left"))


@query("f41_expected_completion", f"SELECT event_id, strftime({_next} + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M') AS expected FROM events")
def _(t):
    return t.events.select("event_id", F.date_format(clock.expected_completion(F.col("ts")), "yyyy-MM-dd HH:mm").alias("expected"))


_sign = "(" + " OR ".join(f"contains(text, {quote(w)})" for w in fixed.TABLE_SIGNS) + ")"


@query("f42_document_quality", f"""
WITH d AS (SELECT conv_id, count(*) AS page_count, sum(CASE WHEN turn < 3 THEN length(text) ELSE 0 END) AS chars, coalesce(max(CASE WHEN turn < 3 THEN {_sign} END), false) AS tables,
  sum(CASE WHEN turn < 3 AND role = 'user' THEN 1 ELSE 0 END) AS images FROM conversations GROUP BY 1),
 q AS (SELECT *, CASE WHEN chars > 100 AND tables AND chars / least(3, page_count) > 1000 THEN 'digital_high' WHEN chars > 100 AND tables AND round_even(images / least(3, page_count), 2) < 0.6 THEN 'digital_medium'
  WHEN chars > 100 THEN 'scanned_good' ELSE 'scanned_poor' END AS quality_level FROM d)
SELECT conv_id, page_count, quality_level, CASE WHEN quality_level LIKE 'digital%' THEN 'pymupdf' WHEN quality_level = 'scanned_good' THEN 'camelot' ELSE 'ocr' END AS parser,
 CAST(CASE quality_level WHEN 'digital_high' THEN 0.95 WHEN 'digital_medium' THEN 0.85 WHEN 'scanned_good' THEN 0.75 ELSE 0.6 END AS DOUBLE) AS confidence FROM q""")
def _(t):
    paged = t.conversations.withColumn("images", F.when(F.col("role") == "user", 1).otherwise(0))
    return text.document_quality(paged, "conv_id", "turn", "text", "images").select("conv_id", "page_count", "quality_level", "parser", "confidence")


@query("f43_lookup_key", "SELECT p_partkey, p_brand || '_' || replace(p_name, ' ', '_') || '_' || p_size AS lookup_key FROM part")
def _(t):
    return t.part.select("p_partkey", text.lookup_key(F.col("p_brand"), F.col("p_name"), F.col("p_size")).alias("lookup_key"))


_tp = r"^(\d+)in (\d+)mm (\d+\.?\d*)in (\d+)mm (.+)$"


@query("f44_track_parts", f"""
SELECT product_id, CAST(nullif(regexp_extract(telamatto, '{_tp}', 1), '') AS INT) AS length_in, CAST(nullif(regexp_extract(telamatto, '{_tp}', 2), '') AS INT) AS length_mm,
 CAST(nullif(regexp_extract(telamatto, '{_tp}', 3), '') AS DOUBLE) AS profile_in, CAST(nullif(regexp_extract(telamatto, '{_tp}', 4), '') AS INT) AS profile_mm, nullif(regexp_extract(telamatto, '{_tp}', 5), '') AS track_name FROM ({P}) p""")
def _(t):
    return t.select(PRODUCTS).select("product_id", *[c.alias(n) for n, c in text.track_parts(F.col("telamatto")).items()])


@query("f45_standard_entry", f"""
SELECT product_id, upper(trim(coalesce(model_code, ''))) AS model_code, coalesce({squeeze('paketti')}, '') AS clean_text,
 CASE WHEN contains(upper(kaynnistin), 'SHOT') THEN 'SHOT' WHEN contains(upper(kaynnistin), 'ELECTRIC') THEN 'ELECTRIC' WHEN contains(upper(kaynnistin), 'MANUAL') THEN 'MANUAL' END AS starter,
 CASE WHEN contains(lower(mittaristo), 'touchscreen') THEN 'touchscreen' WHEN contains(lower(mittaristo), 'digital') THEN 'digital' END AS display,
 CASE WHEN currency = 'EUR' THEN 'EUR' WHEN currency = 'RUB' THEN 'RUB' WHEN upper(market) = 'RUSSIA' THEN 'RUB' ELSE 'EUR' END AS currency FROM ({P}) p""")
def _(t):
    c = F.col
    made = text.standard_entry(c("model_code"), c("paketti"), c("kaynnistin"), c("mittaristo"), c("currency"), c("market"))
    return t.select(PRODUCTS).select("product_id", *[v.alias(n) for n, v in made.items()])


@query("f46_remaining_time", """
SELECT o_orderkey, round(CASE WHEN done > 0 THEN (total - done) / (done / greatest(1, age)) END, 4) AS seconds_left
FROM (SELECT l_orderkey AS o_orderkey, count(*) FILTER (l_linestatus = 'F') AS done, count(*) AS total, max(l_quantity) AS age FROM lineitem GROUP BY 1) q""")
def _(t):
    from catalign.operators.history import remaining_seconds
    jobs = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count_if(F.col("l_linestatus") == "F").alias("done"), F.count("*").alias("total"), F.max("l_quantity").alias("age"))
    return jobs.select("o_orderkey", F.round(remaining_seconds(F.col("done"), F.col("total"), F.col("age")), 4).alias("seconds_left"))


_sig = ("CASE " + " ".join(f"WHEN model_code IN ({', '.join(map(quote, s['codes']))}) THEN '{b}'" for b, s in fixed.BRAND_SIGNS.items())
        + " ".join(f" WHEN malli IN ({', '.join(map(quote, s['families']))}) THEN '{b}'" for b, s in fixed.BRAND_SIGNS.items())
        + " ".join(f" WHEN starts_with(upper(file), '{b.upper()}') THEN '{b}'" for b in fixed.BRAND_SIGNS)
        + " ".join(f" WHEN moottori IN ({', '.join(map(quote, s['engines']))}) THEN '{b}'" for b, s in fixed.BRAND_SIGNS.items()) + " END")


@query("f49_brand_detection", f"SELECT product_id, {_sig} AS brand FROM (SELECT *, brand || '_2025' AS file FROM ({P}) p) q")
def _(t):
    c = F.col
    return t.select(PRODUCTS).select("product_id", text.brand_from_signs(
        c("model_code"), c("malli"), c("moottori"), F.concat("brand", F.lit("_2025"))).alias("brand"))
