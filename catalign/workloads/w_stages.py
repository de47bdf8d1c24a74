"""Specification maps and the five stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import bands, fixed, maps
from catalign.operators.keep import rank_option_rows
from catalign.plans import stages
from catalign.tables import Tables
from catalign.workloads import query
from catalign.workloads.standins import BASE_MODELS, ENTRIES, plain, quote
from catalign.workloads.w_matching import MATCHED, VERIFIED, suggestions

E, B = plain(ENTRIES), plain(BASE_MODELS)


# --- SQL side: maps as MAP(VARCHAR, VARCHAR) ---------------------------------------------------------
def m(values: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in values.items()) + "}"


EMPTY = "CAST(MAP {} AS MAP(VARCHAR, VARCHAR))"


def over(*parts: str) -> str:
    return "map_concat(" + ", ".join(parts) + ")"


def defaults(specs: str, extra: str) -> str:
    return over(extra, specs)


def when(cond: str, values: dict[str, str]) -> str:
    return f"CASE WHEN {cond} THEN {m(values)} ELSE {EMPTY} END"


def first(arms: list[tuple[str, dict[str, str]]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {m(v)}" for c, v in arms) + f" ELSE {EMPTY} END"


def shown(specs: str) -> str:
    return f"array_to_string(list_sort(list_transform(map_entries({specs}), lambda e: e.key || '=' || e.value)), '; ')"


def like(code: str, pattern: str) -> str:
    return f"regexp_matches(upper({code}), '{pattern}')"


GROUPS = f"""
SELECT *, map_from_entries(list_filter([{{'k': 'displacement', 'v': displacement}}, {{'k': 'engine_type', 'v': engine_type}},
  {{'k': 'suspension', 'v': suspension}}, {{'k': 'track_type', 'v': track_type}}, {{'k': 'connectivity', 'v': connectivity}}], lambda x: x.v IS NOT NULL)) AS base_specs FROM ({B}) b"""
_brand = first([(f"brand = '{b}'", v) for b, v in fixed.BRAND_DEFAULTS.items()])
WITH_MATCH = f"WITH matched_entries AS MATERIALIZED ({MATCHED}), verified AS MATERIALIZED ({VERIFIED.replace(MATCHED, 'SELECT * FROM matched_entries')})\n"
INHERITED = f"""
SELECT *, {defaults('s3', first([('price >= 18000', fixed.PRICE_TIERS['premium']), ('price >= 12000', fixed.PRICE_TIERS['mid']), ('true', fixed.PRICE_TIERS['entry'])]))} AS inherited FROM (
SELECT *, CASE WHEN model_year <= 2020 THEN {over("map_from_entries(list_filter(map_entries(s2), lambda e: e.key <> 'connectivity'))", m({'display': 'analog_gauge'}))} ELSE s2 END AS s3 FROM (
SELECT *, {defaults(defaults('s1', when('model_year >= 2023', {'display': 'digital_gauge', 'connectivity': 'bluetooth'})), when('model_year >= 2024', {'starting': 'electric_start', 'warranty': '3_year_extended'}))} AS s2 FROM (
SELECT *, {defaults('base_specs', _brand)} AS s1 FROM (
 SELECT e.*, CASE WHEN e.score >= 0.8 THEN e.best_id ELSE v.base_model_id END AS matched_id,
  CASE WHEN e.score >= 0.8 THEN e.score WHEN v.base_model_id IS NOT NULL THEN 0.75 ELSE 0.0 END AS match_confidence,
  coalesce(g.base_specs, {EMPTY}) AS base_specs, CASE WHEN g.position IS NOT NULL THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS base_conf
 FROM matched_entries e LEFT JOIN verified v ON v.entry_id = e.entry_id
 LEFT JOIN ({GROUPS}) g ON g.position = CASE WHEN e.score >= 0.8 THEN e.best_position ELSE v.position END) j) a) b) c"""
_n = "cardinality(inherited)"
INHERITED = f"""
SELECT *, greatest(0.0, least(0.95, base_conf + CASE WHEN {_n} < 5 THEN -0.1 ELSE least(0.2, {_n} * 0.02) END)) AS inherit_conf FROM ({INHERITED}) i"""
_code = over(first([(like("model_code", p), v) for p, v in fixed.ENGINE_CODES]), first([(like("model_code", p), v) for p, v in fixed.TRACK_CODES]),
             *[when(like("model_code", p), v) for p, v in fixed.FEATURE_CODES])
_variant = over(first([(f"brand = '{b}' AND {like('model_code', p)}", v) for b, p, v in fixed.VARIANT_CODES]),
                *[when(like("model_code", p), v) for p, v in fixed.TRIM_CODES])
_changed = "list_filter(map_entries(code_specs), lambda e: map_contains(inherited, e.key) AND inherited[e.key] <> e.value)"
CUSTOM = f"""
SELECT *, greatest(0.1, least(0.95, 0.7 + (CASE WHEN cardinality(custom) >= 5 THEN 0.2 WHEN cardinality(custom) >= 3 THEN 0.1 WHEN cardinality(custom) >= 1 THEN 0.05 ELSE -0.2 END)
  + (CASE WHEN len(list_filter(map_keys(custom), lambda k: contains(k, 'engine'))) > 0 AND len(list_filter(map_keys(custom), lambda k: contains(k, 'track'))) > 0 THEN 0.1 ELSE 0 END)
  + (CASE WHEN length(model_code) >= 8 THEN 0.05 ELSE 0 END))) AS custom_conf FROM (
SELECT *, {over('code_specs', f"map_from_entries(list_transform({_changed}, lambda e: {{'k': e.key || '_customized', 'v': 'true'}}))",
                f"map_from_entries(list_transform({_changed}, lambda e: {{'k': e.key || '_original', 'v': inherited[e.key]}}))", 'variant')} AS custom FROM (
SELECT *, {_code} AS code_specs, {_variant} AS variant FROM ({INHERITED}) i) c) d"""


def _opt(cond: str, i: int, kind: str, text: str, conf: float, how: str) -> str:
    return (f"CASE WHEN {cond} THEN {{'c': CAST({-conf} AS DOUBLE), 'i': {i}, 't': '{kind}', 'd': '{text}', 'm': '{how}'}} END")


_opts = [(like("model_code", p), k, d, c, "model_code_pattern") for p, k, d, c in fixed.OPTION_CODES]
_opts += [(f"custom['{key}'] = '{v}'", k, d, c, how) for key, v, k, d, c, how in fixed.OPTION_RULES]
_opts += [("price >= 18000", *fixed.LUXURY_OPTION)]
OPTIONS = f"""
SELECT *, CASE WHEN len(opts) = 0 THEN 0.5 ELSE greatest(0.1, least(0.95, -list_sum(list_transform(opts, lambda o: o.c)) / len(opts)
  + least(0.2, cardinality(custom) * 0.02) + least(0.1, len(list_distinct(list_transform(opts, lambda o: o.t))) * 0.03))) END AS opt_conf FROM (
SELECT *, list_sort(list_filter([{', '.join(_opt(c, i, k, d, conf, how) for i, (c, k, d, conf, how) in enumerate(_opts))}], lambda x: x IS NOT NULL)) AS opts FROM ({CUSTOM}) c) op"""


def _f(name: str) -> str:
    return f"final['{name}']"


_prem = " + ".join(f"CAST(len(list_filter(map_values(final), lambda v: contains(lower(v), '{w}'))) > 0 AS INT)" for w in fixed.PREMIUM_WORDS)
WARN = [
    ("matched_id IS NULL", "'No base model matched'"),
    (f"{_n} < 3", "'Very few specifications inherited'"),
    (f"contains({_f('displacement')}, '1000cc') AND {_f('engine_type')} <> '4-stroke'", "'Large displacement with 2-stroke engine seems unusual'"),
    (f"contains({_f('displacement')}, '600cc') AND {_f('engine_type')} <> '2-stroke'", "'Small displacement with 4-stroke engine seems unusual'"),
    (f"{_f('track_type')} = 'mountain' AND NOT contains(lower({_f('suspension')}), 'air')", "'Mountain track without air suspension seems unusual'"),
    (f"price > 20000 AND coalesce({_f('heated_grips')}, 'false') <> 'true'", "'High-priced model without heated grips'"),
    (f"price > 20000 AND coalesce({_f('reverse')}, 'false') <> 'electric'", "'High-priced model without electric reverse'"),
]
for _name, (_low, _high) in fixed.BRAND_PRICES.items():
    WARN.append((f"brand = '{_name}' AND price < {_low}", f"'Price seems low for {_name} (' || price || ')'"))
    WARN.append((f"brand = '{_name}' AND price > {_high}", f"'Price seems high for {_name} (' || price || ')'"))
WARN += [
    (f"({_prem}) >= 3 AND price < 15000", "'Many premium features but relatively low price'"),
    (f"({_prem}) = 0 AND price > 18000", "'High price but few premium features detected'"),
    ("len(list_filter(opts, lambda o: contains(o.t, 'track'))) > 1", "'Multiple track options detected - may be conflicting'"),
    ("len(list_filter(opts, lambda o: contains(o.t, 'suspension'))) > 1", "'Multiple suspension options detected'"),
]
_err = "CAST(coalesce(price <= 0, false) AS INT) + CAST(matched_id IS NULL AND cardinality(inherited) = 0 AS INT)"
FINAL = f"""
SELECT *, CASE WHEN n_err > 0 THEN CAST(0.0 AS DOUBLE) ELSE greatest(0.0, least(0.95, least(inherit_conf, custom_conf, opt_conf) + (quality - 0.7) * 0.2
  + least(0.1, ({_n} + cardinality(custom)) * 0.01) - n_err * 0.1 - n_warn * 0.02
  - CASE WHEN regexp_matches(upper(model_code), 'UNKNOWN|TEST|XYZ') THEN 0.3 ELSE 0 END)) END AS final_conf FROM (
SELECT *, greatest(0.0, least(1.0, CAST(1.0 AS DOUBLE) - n_err * 0.2 - n_warn * 0.05)) AS quality FROM (
SELECT *, list_filter([{', '.join(f'CASE WHEN {c} THEN {t} END' for c, t in WARN)}], lambda x: x IS NOT NULL) AS warns,
 len(warns) AS n_warn, {_err} AS n_err FROM (
SELECT *, {over('inherited', 'custom')} AS final FROM ({OPTIONS}) op) f) g) h"""
DONE = f"""
SELECT *, matched_id IS NOT NULL AND n_err = 0 AS success, CASE WHEN matched_id IS NOT NULL AND n_err = 0 THEN
 match_confidence * 0.3 + inherit_conf * 0.2 + custom_conf * 0.2 + opt_conf * 0.1 + final_conf * 0.2 END AS overall FROM ({FINAL}) f"""


# --- Spark side --------------------------------------------------------------------------------------
def models_with_specs(t: Tables):
    specs = maps.known_map(displacement=F.col("displacement"), engine_type=F.col("engine_type"),
                           suspension=F.col("suspension"), track_type=F.col("track_type"), connectivity=F.col("connectivity"))
    return t.select(BASE_MODELS).withColumns({"base_specs": specs, "inheritance_base": F.lit(0.9)})


def reconciled(t: Tables):
    return stages.reconcile(t.select(ENTRIES), models_with_specs(t), suggestions=suggestions(t))


@query("t02_specification_inheritance", f"{WITH_MATCH}SELECT entry_id, {shown('inherited')} AS specs, round(inherit_conf, 6) AS confidence FROM ({INHERITED}) i")
def _(t):
    df = stages.inherit(stages.match_stage(models_with_specs(t), suggestions(t))(t.select(ENTRIES)))
    return df.select("entry_id", maps.map_text(F.col("inherited_specs")).alias("specs"),
                     F.round("inheritance_confidence", 6).alias("confidence"))


@query("t03_customization", f"{WITH_MATCH}SELECT entry_id, {shown('custom')} AS custom, round(CAST(custom_conf AS DOUBLE), 6) AS confidence FROM ({CUSTOM}) c")
def _(t):
    df = stages.customize(stages.inherit(stages.match_stage(models_with_specs(t), suggestions(t))(t.select(ENTRIES))))
    return df.select("entry_id", maps.map_text(F.col("customizations")).alias("custom"),
                     F.round("customization_confidence", 6).alias("confidence"))


@query("t04_options", f"""{WITH_MATCH}
SELECT entry_id, array_to_string(list_transform(opts, lambda o: o.t || ':' || o.d || ':' || o.m), '; ') AS options, round(CAST(opt_conf AS DOUBLE), 6) AS confidence FROM ({OPTIONS}) op""")
def _(t):
    shown_options = F.array_join(F.transform("spring_options", lambda o: F.concat_ws(":", o["type"], o["description"], o["method"])), "; ")
    return reconciled(t).select("entry_id", shown_options.alias("options"), F.round("options_confidence", 6).alias("confidence"))


@query("t05_final_validation", f"""{WITH_MATCH}
SELECT entry_id, array_to_string(warns, '; ') AS warnings, round(quality, 6) AS quality, round(final_conf, 6) AS confidence FROM ({FINAL}) f""")
def _(t):
    return reconciled(t).select("entry_id", F.array_join("warnings", "; ").alias("warnings"), F.round("quality_score", 6).alias("quality"),
                                F.round("final_confidence", 6).alias("confidence"))


@query("t06_reconciled_batch", f"""{WITH_MATCH}
SELECT entry_id, success, round(overall, 6) AS overall, CASE WHEN matched_id IS NULL THEN 'base_model_matching' WHEN n_err > 0 THEN 'final_validation' END AS failed_stage FROM ({DONE}) d""")
def _(t):
    return reconciled(t).select("entry_id", "success", F.round("overall_confidence", 6).alias("overall"), "failed_stage")


@query("t06_batch_totals", f"""{WITH_MATCH.rstrip()}, d AS MATERIALIZED (SELECT entry_id, success, overall FROM ({DONE}) x)
SELECT count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, round(avg(overall), 6) AS avg_confidence FROM d""")
def _(t):
    return stages.batch_totals(reconciled(t)).withColumn("avg_confidence", F.round("avg_confidence", 6))


@query("t07_auto_approved", f"""{WITH_MATCH.rstrip()}, d AS MATERIALIZED (SELECT entry_id, success, overall FROM ({DONE}) x)
SELECT CASE WHEN success AND overall >= 0.8 THEN 'auto_approved' WHEN success THEN 'pending_review' END AS review_status, count(*) AS entries FROM d GROUP BY 1""")
def _(t):
    return stages.auto_approve(reconciled(t), 0.8).groupBy("review_status").agg(F.count("*").alias("entries"))


@query("v09_final_checks", f"{WITH_MATCH}SELECT entry_id, CAST(n_err AS INT) AS n_errors, CAST(n_warn AS INT) AS n_warnings FROM ({FINAL}) f")
def _(t):
    return reconciled(t).select("entry_id", F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"))


@query("v10_final_confidence", f"""{WITH_MATCH}
SELECT entry_id, round(final_conf, 6) AS confidence, CASE WHEN round(final_conf, 9) >= 0.9 THEN 'high' WHEN round(final_conf, 9) >= 0.7 THEN 'medium' ELSE 'low' END AS level FROM ({FINAL}) f""")
def _(t):
    score = F.col("final_confidence")
    return reconciled(t).select("entry_id", F.round(score, 6).alias("confidence"), bands.level3(F.round(score, 9)).alias("level"))


@query("a18_options_confidence", f"""{WITH_MATCH}
SELECT entry_id, CAST(len(opts) AS INT) AS n_options, CAST(len(list_distinct(list_transform(opts, lambda o: o.t))) AS INT) AS n_types, round(CAST(opt_conf AS DOUBLE), 6) AS confidence FROM ({OPTIONS}) op""")
def _(t):
    kinds = F.size(F.array_distinct(F.transform("spring_options", lambda o: o["type"])))
    return reconciled(t).select("entry_id", F.size("spring_options").alias("n_options"), kinds.alias("n_types"),
                                F.round("options_confidence", 6).alias("confidence"))


@query("u01_concat_lists", f"""{WITH_MATCH}
SELECT entry_id, CAST(len(opts) AS INT) + CAST(n_warn AS INT) AS n FROM ({FINAL}) f""")
def _(t):
    joined = F.concat(F.transform("spring_options", lambda o: o["description"]), F.col("warnings"))
    return reconciled(t).select("entry_id", F.size(joined).alias("n"))


@query("u03_rank_options", """
SELECT l_orderkey, lower(l_returnflag || l_linestatus) AS option, max(l_discount) AS confidence, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1, 2""")
def _(t):
    kind = F.lower(F.concat("l_returnflag", "l_linestatus"))
    ranked = rank_option_rows(t.lineitem, ["l_orderkey", kind.alias("option")], "l_discount", "l_linenumber")
    return ranked.select("l_orderkey", "option", F.col("l_discount").alias("confidence"), F.col("l_linenumber").alias("first_line"))


@query("f23_map_overlay", f"{WITH_MATCH}SELECT entry_id, {shown(over('base_specs', _code))} AS specs FROM ({INHERITED}) i")
def _(t):
    df = stages.match_stage(models_with_specs(t), suggestions(t))(t.select(ENTRIES))
    return df.select("entry_id", maps.map_text(maps.overlay(F.col("base_specs"), stages.code_customizations(F.col("model_code")))).alias("specs"))


@query("f24_map_defaults", f"""
SELECT position, {shown(defaults('base_specs', _brand))} AS specs, {shown("map_from_entries(list_filter(map_entries(base_specs), lambda e: e.key <> 'connectivity'))")} AS dropped FROM ({GROUPS}) g""")
def _(t):
    df = models_with_specs(t)
    return df.select("position", maps.map_text(stages.brand_defaults(F.col("base_specs"), F.col("brand"))).alias("specs"),
                     maps.map_text(maps.without(F.col("base_specs"), "connectivity")).alias("dropped"))


_ch = "list_filter(map_entries(b), lambda e: map_contains(a, e.key) AND a[e.key] <> e.value)"
_ad = "list_filter(map_entries(b), lambda e: NOT map_contains(a, e.key))"


@query("f26_map_difference", f"""
WITH p AS (SELECT o_orderkey, MAP {{'status': o_orderstatus, 'size': CAST(o_custkey % 3 AS VARCHAR)}} AS a,
 MAP {{'status': 'F', 'size': '1', 'priority': o_orderpriority}} AS b FROM orders)
SELECT o_orderkey, {shown(over(f"map_from_entries({_ch})", f"map_from_entries({_ad})", f"map_from_entries(list_transform({_ch}, lambda e: {{'k': e.key || '_customized', 'v': 'true'}}))", f"map_from_entries(list_transform({_ch}, lambda e: {{'k': e.key || '_original', 'v': a[e.key]}}))"))} AS diff FROM p""")
def _(t):
    a = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("size"), (F.col("o_custkey") % 3).cast("string"))
    b = F.create_map(F.lit("status"), F.lit("F"), F.lit("size"), F.lit("1"), F.lit("priority"), F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", maps.map_text(maps.difference(a, b)).alias("diff"))


@query("f27_confidence_bands", f"""
SELECT entry_id, CASE WHEN extraction_confidence >= 0.9 THEN 'high' WHEN extraction_confidence >= 0.7 THEN 'medium' ELSE 'low' END AS three,
 CASE WHEN extraction_confidence >= 0.9 THEN 'HIGH' WHEN extraction_confidence >= 0.7 THEN 'MEDIUM' WHEN extraction_confidence >= 0.5 THEN 'LOW' ELSE 'VERY_LOW' END AS four FROM ({E}) e""")
def _(t):
    c = F.col("extraction_confidence")
    return t.select(ENTRIES).select("entry_id", bands.level3(c).alias("three"), bands.level4(c).alias("four"))


@query("f28_clamp_confidence", """
SELECT event_id, greatest(0.0, least(1.0, coalesce(TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE CAST(value / 10 - 1 AS VARCHAR) END AS DOUBLE), 0.0))) AS confidence FROM events""")
def _(t):
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise((F.col("value") / 10 - 1).cast("string"))
    return t.events.select("event_id", bands.clamp(raw).alias("confidence"))


@query("x04_stage_hooks", f"""
SELECT entry_id, {shown(_code)} AS custom, cardinality({_code}) > 0 AS codes_success, least(1.0, CAST(cardinality({_code}) AS DOUBLE) / 3) AS codes_confidence,
 price > 8000 AS priced_success, CASE WHEN price > 8000 THEN 0.5 ELSE 0.0 END::DOUBLE AS priced_confidence FROM ({E}) e""")
def _(t):
    found = F.size("code_specs")
    hooked = stages.run_stages(t.select(ENTRIES), [
        ("codes", lambda df: df.withColumn("code_specs", stages.code_customizations(F.col("model_code"))), ["code_specs"],
         {"success": found > 0, "confidence": found.cast("double") / 3}),
        ("priced", lambda df: df.withColumns({"dear": F.when(F.col("price") > 8000, F.col("price")), "cheap": F.when(F.col("price") <= 8000, F.col("price"))}),
         ["dear", "cheap"], {"success": F.col("price") > 8000, "confidence": True})])
    return hooked.select("entry_id", maps.map_text(F.col("code_specs")).alias("custom"), "codes_success", "codes_confidence",
                         "priced_success", "priced_confidence")
