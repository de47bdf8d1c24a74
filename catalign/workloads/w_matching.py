"""Base-model matching, similarity and text matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalign.functions import bands, fixed, similarity, text
from catalign.operators import keep, matching, tiles
from catalign.plans import feed, stages
from catalign.tables import Tables
from catalign.workloads import query
from catalign.workloads.standins import BASE_MODELS, CATALOG, ENTRIES, PRODUCTS, plain, quote

E, B, P, C = plain(ENTRIES), plain(BASE_MODELS), plain(PRODUCTS), plain(CATALOG)

_arms = ", ".join(
    f"CASE WHEN upper(brand) = '{b}' AND regexp_matches(upper(trim(model_code)), '^({p})') THEN '{f}' END"
    for b, p, f in fixed.CODE_FAMILIES)
CANDIDATES = f"""
SELECT *, list_sort(list_distinct(CASE WHEN len(fam) > 0 THEN fam
  WHEN length(c) >= 3 THEN [substr(c, 1, 3), substr(c, 1, 4)] ELSE [] END)) AS candidates
FROM (SELECT *, upper(trim(model_code)) AS c, list_filter([{_arms}], lambda x: x IS NOT NULL) AS fam FROM ({E}) e)"""


def letters_sql(a: str, b: str) -> str:
    left = f"list_distinct(string_split(upper({a}), ''))"
    right = f"list_distinct(string_split(upper({b}), ''))"
    return (f"CASE WHEN coalesce({a}, '') = '' OR coalesce({b}, '') = '' THEN 0.0 ELSE "
            f"CAST(len(list_intersect({left}, {right})) AS DOUBLE) / "
            f"len(list_distinct(list_concat({left}, {right}))) END")


SCORED = f"""
SELECT r.model_code, r.brand, r.model_year, r.cand, m.base_model_id, m.model_name, m.brand AS mb, m.position,
  least(1.0, (CASE WHEN m.base_model_id = r.cand THEN 0.5 ELSE 0.0 END)
   + (CASE WHEN contains(upper(m.model_name), r.cand) THEN 0.3 ELSE 0.0 END)
   + (CASE WHEN contains(r.c, upper(m.brand)) THEN 0.1 ELSE 0.0 END)
   + ({letters_sql('r.c', 'm.base_model_id')}) * 0.1) AS score
FROM (SELECT DISTINCT model_code, brand, model_year, c, unnest(candidates) AS cand FROM ({CANDIDATES}) k) r
JOIN ({B}) m ON m.model_year = r.model_year AND m.brand ILIKE '%' || r.brand || '%'
 AND (m.base_model_id ILIKE '%' || r.cand || '%' OR m.model_name ILIKE '%' || r.cand || '%')"""
BEST = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_code, brand, model_year
  ORDER BY score DESC, cand, mb, model_name, position) AS rn FROM ({SCORED}) s WHERE score > 0) WHERE rn = 1"""
MATCHED = f"""
SELECT e.*, coalesce(b.score, 0.0) AS score, b.base_model_id AS best_id, b.model_name AS best_name,
  b.position AS best_position, b.cand, len(e.candidates) AS n_candidates
FROM ({CANDIDATES}) e LEFT JOIN ({BEST}) b
 ON b.model_code = e.model_code AND b.brand = e.brand AND b.model_year = e.model_year"""


def entries(t: Tables):
    return t.select(ENTRIES)


def base_models(t: Tables):
    return t.select(BASE_MODELS)


def matched_entries(t: Tables):
    return matching.match_base_models(entries(t), base_models(t))


@query("f01_code_candidates", f"""
SELECT entry_id, array_to_string(candidates, '|') AS candidates FROM ({CANDIDATES}) c""")
def _(t):
    return entries(t).select("entry_id", F.array_join(text.code_candidates(F.col("model_code"), F.col("brand")), "|")
                             .alias("candidates"))


@query("f02_match_score", f"""
SELECT model_code, brand, model_year, cand AS candidate, base_model_id, round(score, 6) AS score FROM ({SCORED}) s""")
def _(t):
    asked = entries(t).select(F.col("model_code").alias("code"), "brand", "model_year").distinct()
    found = matching.find_candidates(asked, base_models(t))
    return found.select(F.col("code").alias("model_code"), "brand", "model_year", "candidate", "base_model_id",
                        F.round("score", 6).alias("score"))


@query("f03_letter_similarity", f"""
SELECT p_partkey, round({letters_sql('p_name', 'p_type')}, 6) AS similarity FROM part""")
def _(t):
    return t.part.select("p_partkey", F.round(similarity.letter_similarity(F.col("p_name"), F.col("p_type")), 6)
                         .alias("similarity"))


_w1 = "list_distinct(list_filter(regexp_split_to_array(lower(trim(d.text)), '\\s+'), lambda x: x <> ''))"
_w2 = "list_distinct(list_filter(regexp_split_to_array(lower(trim(b.text)), '\\s+'), lambda x: x <> ''))"
WORD_OVERLAP = f"""CASE WHEN coalesce(d.text, '') = '' OR coalesce(b.text, '') = '' THEN 0.0 WHEN lower(trim(d.text)) = lower(trim(b.text)) THEN 1.0
 WHEN len({_w1}) = 0 OR len({_w2}) = 0 THEN 0.0 ELSE CAST(len(list_intersect({_w1}, {_w2})) AS DOUBLE) / len(list_distinct(list_concat({_w1}, {_w2}))) END"""


@query("f04_word_similarity", f"""
SELECT d.conv_id, d.turn, round({WORD_OVERLAP}, 6) AS similarity
FROM conversations d JOIN conversations b ON b.conv_id = d.conv_id AND b.turn = d.turn + 1""")
def _(t):
    """Every turn against the turn that answers it."""
    answers = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other"))
    return t.conversations.join(answers, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(similarity.word_similarity(F.col("text"), F.col("other")), 6).alias("similarity"))


@query("f05_block_ratio", """
WITH RECURSIVE pairs AS (SELECT DISTINCT p_name, p_type, lower(p_name) AS a, lower(p_type) AS b FROM part),
w AS (
  SELECT p_name, p_type, a, b, 0 AS got FROM pairs
  UNION ALL
  SELECT p_name, p_type, CASE side WHEN 0 THEN substr(a, 1, m.i - 1) ELSE substr(a, m.i + m.k) END,
         CASE side WHEN 0 THEN substr(b, 1, strpos(b, substr(a, m.i, m.k)) - 1) ELSE substr(b, strpos(b, substr(a, m.i, m.k)) + m.k) END,
         CASE side WHEN 0 THEN m.k ELSE 0 END
  FROM (SELECT p_name, p_type, a, b, side, {'k': best.k, 'i': -best.before} AS m FROM (
    SELECT p_name, p_type, a, b, side, list_max(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(
      list_filter(range(1, length(a) - i + 2), lambda n: contains(b, substr(a, i, n))), lambda n: {'k': n, 'before': -i})))) AS best
    FROM w CROSS JOIN (VALUES (0), (1)) s(side) WHERE a <> '' AND b <> '') t WHERE best IS NOT NULL) u
), r AS (SELECT p_name, p_type, 2.0 * sum(got) / (length(p_name) + length(p_type)) AS ratio FROM w GROUP BY p_name, p_type)
SELECT p_partkey, round(CAST(coalesce(r.ratio, 0) AS DOUBLE), 6) AS ratio FROM part JOIN r USING (p_name, p_type)""")
def _(t):
    pairs = t.part.select("p_name", "p_type").distinct().withColumn(
        "ratio", similarity.block_ratio(F.col("p_name"), F.col("p_type")))
    return t.part.select("p_partkey", "p_name", "p_type").join(pairs, ["p_name", "p_type"]).select(
        "p_partkey", F.round("ratio", 6).alias("ratio"))


def boost_sql(a: str, b: str) -> str:
    parts = [f"(CASE WHEN contains(lower({a}), '{w}') AND contains(lower({b}), '{w}') THEN {weight} ELSE 0.0 END)"
             for weight, group in fixed.BOOST_WORDS for w in group]
    return "least(0.2, " + " + ".join(f"CAST({p} AS DOUBLE)" for p in parts) + ")"


@query("f06_domain_boost", f"""
SELECT product_id, round({boost_sql("coalesce(malli,'') || ' ' || coalesce(moottori,'')", "coalesce(paketti,'') || ' ' || coalesce(moottori,'') || ' sport summit'")}, 6) AS boost
FROM ({P}) p""")
def _(t):
    def gap(c):
        return F.coalesce(F.col(c), F.lit(""))
    left = F.concat(gap("malli"), F.lit(" "), gap("moottori"))
    right = F.concat(gap("paketti"), F.lit(" "), gap("moottori"), F.lit(" sport summit"))
    return t.select(PRODUCTS).select("product_id", F.round(similarity.domain_boost(left, right), 6).alias("boost"))


@query("f48_combined_confidence", f"""
SELECT entry_id, round(least(1.0, extraction_confidence + (model_year % 3) * 0.1 + least(0.05 * (model_year % 6), 0.2)), 6) AS confidence
FROM ({E}) e""")
def _(t):
    year = F.col("model_year")
    return entries(t).select("entry_id", F.round(similarity.combined_confidence(
        F.col("extraction_confidence"), year % 3, (year % 6) * 0.05), 6).alias("confidence"))


@query("j01_base_model_candidates", f"""
SELECT model_code, brand, model_year, base_model_id, cand AS candidate, round(score, 6) AS score FROM ({BEST}) b""")
def _(t):
    asked = entries(t).select(F.col("model_code").alias("code"), "brand", "model_year").distinct()
    best = keep.best_match(matching.find_candidates(asked, base_models(t)), ["code", "brand", "model_year"], "score",
                           ["candidate", "model_brand", "model_name", "position"])
    return best.select(F.col("code").alias("model_code"), "brand", "model_year", "base_model_id", "candidate",
                       F.round("score", 6).alias("score"))


@query("t01_base_model_match", f"""
SELECT entry_id, CASE WHEN score >= 0.7 THEN best_id END AS base_model_id, round(score, 6) AS confidence,
 CASE WHEN n_candidates = 0 THEN 'No base model candidates extracted from code'
  WHEN score < 0.7 THEN 'Best match confidence ' || printf('%.2f', score) || ' below threshold 0.7' END AS reason
FROM ({MATCHED}) m""")
def _(t):
    return matched_entries(t).select(
        "entry_id", F.col("matched_base_model_id").alias("base_model_id"),
        F.round("match_confidence", 6).alias("confidence"), F.col("match_reason").alias("reason"))


@query("t01_base_model_levels", f"""
SELECT CASE WHEN score >= 0.9 THEN 'high' WHEN score >= 0.7 THEN 'medium' ELSE 'low' END AS level,
 count(*) AS entries, count(DISTINCT model_code) AS codes FROM ({MATCHED}) m GROUP BY 1""")
def _(t):
    return (matched_entries(t).groupBy(bands.level3(F.col("match_confidence")).alias("level"))
            .agg(F.count("*").alias("entries"), F.countDistinct("model_code").alias("codes")))


# the catalog row that confirms the suggestion of an entry
VERIFIED = f"""
SELECT entry_id, base_model_id, position FROM (
 SELECT m.entry_id, b.base_model_id, b.position, row_number() OVER (PARTITION BY m.entry_id ORDER BY b.brand, b.model_name, b.position) AS rn
 FROM ({MATCHED}) m JOIN ({B}) b ON upper(b.base_model_id) = CASE WHEN m.entry_id % 2 = 0 THEN 'RENEGADE_X' ELSE 'SUMMIT' END
  AND b.model_year = m.model_year AND b.brand ILIKE '%' || m.brand || '%'
 WHERE m.score < 0.8) WHERE rn = 1"""


def suggestions(t: Tables):
    return entries(t).select(
        "entry_id", F.when(F.col("entry_id") % 2 == 0, "renegade_x").otherwise("summit").alias("suggested_id"),
        F.lit(0.75).alias("suggested_confidence"))


@query("j06_fallback_cascade", f"""
WITH m AS ({MATCHED}), v AS ({VERIFIED})
SELECT m.entry_id, CASE WHEN m.score >= 0.8 THEN 'structured' WHEN v.base_model_id IS NOT NULL THEN 'semantic' ELSE 'failed' END AS method,
 CASE WHEN m.score >= 0.8 THEN m.best_id ELSE v.base_model_id END AS base_model_id,
 round(CASE WHEN m.score >= 0.8 THEN m.score WHEN v.base_model_id IS NOT NULL THEN 0.75 ELSE 0.0 END, 6) AS confidence
FROM m LEFT JOIN v ON v.entry_id = m.entry_id""")
def _(t):
    matched = matching.match_base_models(entries(t), base_models(t), boundary=True)
    done = matching.with_fallback(matched, suggestions(t), base_models(t), entries=entries(t))
    return done.select("entry_id", F.col("matching_method").alias("method"),
                       F.col("matched_base_model_id").alias("base_model_id"),
                       F.round("match_confidence", 6).alias("confidence"))


@query("t01_cascade_levels", f"""
WITH m AS ({MATCHED}), v AS ({VERIFIED}), c AS (
 SELECT CASE WHEN m.score >= 0.8 THEN 'structured' WHEN v.base_model_id IS NOT NULL THEN 'semantic' ELSE 'failed' END AS method,
  CASE WHEN m.score >= 0.8 THEN m.score WHEN v.base_model_id IS NOT NULL THEN 0.75 ELSE 0.0 END AS confidence, m.model_code
 FROM m LEFT JOIN v ON v.entry_id = m.entry_id)
SELECT method, CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.7 THEN 'medium' ELSE 'low' END AS level,
 count(*) AS entries, count(DISTINCT model_code) AS codes FROM c GROUP BY 1, 2""")
def _(t):
    models = base_models(t).withColumns({"base_specs": F.create_map().cast("map<string,string>"), "inheritance_base": F.lit(0.9)})
    done = stages.match_stage(models, suggestions(t))(entries(t))
    return done.groupBy(F.col("matching_method").alias("method"), bands.level3(F.col("match_confidence")).alias("level")).agg(
        F.count("*").alias("entries"), F.countDistinct("model_code").alias("codes"))


_keyed = f"""
SELECT brand || '_' || replace(p_name, ' ', '_') || '_' || model_year AS lookup_key, min(p_partkey) AS base_id
FROM (SELECT p_partkey, p_name, 'B' || (p_size % 5) AS brand, 2019 + p_size % 7 AS model_year FROM part) p
WHERE p_partkey % 3 > 0 GROUP BY 1"""


@query("j02_lookup_key_match", f"""
WITH k AS ({_keyed})
SELECT p_partkey, e.lookup_key, CASE WHEN k.base_id IS NULL THEN 'semantic' ELSE 'exact_lookup' END AS method,
 CASE WHEN k.base_id IS NOT NULL THEN CAST(0.98 AS DOUBLE) END AS confidence, k.base_id
FROM (SELECT p_partkey, 'B' || (p_size % 5) || '_' || replace(p_name, ' ', '_') || '_' || (2019 + p_size % 7) AS lookup_key FROM part) e
LEFT JOIN k ON k.lookup_key = e.lookup_key""")
def _(t):
    shaped = t.part.select(
        "p_partkey", F.col("p_name").alias("model_family"),
        F.concat(F.lit("B"), (F.col("p_size") % 5).cast("string")).alias("brand"),
        (F.lit(2019) + F.col("p_size") % 7).alias("model_year"))
    key = text.lookup_key(F.col("brand"), F.col("model_family"), F.col("model_year"))
    models = (shaped.filter(F.col("p_partkey") % 3 > 0).groupBy(key.alias("lookup_key"))
              .agg(F.min("p_partkey").alias("base_model_id")))
    return matching.match_by_key(shaped, models).select(
        "p_partkey", "lookup_key", F.col("processing_method").alias("method"),
        F.col("confidence_score").alias("confidence"), F.col("matched_base_model_id").alias("base_id"))


def text_products(t: Tables):
    return t.select(PRODUCTS).withColumn("search_text", text.product_search_text(
        F.col("brand"), F.col("malli"), F.lit(None).cast("string"), F.col("moottori"), F.lit(2025)))


def text_catalog(t: Tables):
    return t.select(CATALOG).withColumn("search_text", text.catalog_search_text(
        F.col("model_family"), F.array("feature"), F.array("engine"), F.col("brand")))


@query("j03_text_match")
def _(t):
    return matching.match_texts(text_products(t), text_catalog(t)).select(
        "product_id", "matched", "catalog_position", F.round("score", 6).alias("score"))


@query("j04_vector_match", """
WITH reps AS (SELECT min(vec_id) AS position FROM embeddings GROUP BY label),
 s AS (SELECT e.vec_id, r.position, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS sim
  FROM embeddings e CROSS JOIN reps r JOIN embeddings c ON c.vec_id = r.position)
SELECT vec_id, position, round(sim, 6) AS similarity FROM (
 SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, position) AS rn FROM s WHERE sim > 0) WHERE rn = 1""")
def _(t):
    items = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    firsts = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("vector"),
                                              F.min("vec_id").alias("position"))
    best = tiles.nearest_vectors(items, firsts.select("position", "vector"))
    return best.select(F.col("id").alias("vec_id"), "position", F.round("similarity", 6).alias("similarity"))


@query("j05_first_containing", f"""
WITH f AS (SELECT model_family, min(position) AS pos, max(position) AS entry FROM ({C}) c GROUP BY 1),
 k AS (SELECT DISTINCT malli FROM ({P}) p WHERE coalesce(malli, '') <> ''),
 h AS (SELECT k.malli, f.model_family, f.entry, row_number() OVER (PARTITION BY k.malli ORDER BY f.pos) AS rn
  FROM k JOIN f ON contains(upper(k.malli), upper(f.model_family)) OR contains(upper(f.model_family), upper(k.malli)))
SELECT product_id, h.model_family, h.entry AS catalog_position FROM ({P}) p LEFT JOIN h ON h.malli = p.malli AND h.rn = 1""")
def _(t):
    found = matching.first_containing(t.select(PRODUCTS), t.select(CATALOG))
    return found.select("product_id", "model_family", "catalog_position")


def whitelist(t: Tables):
    return t.select(CATALOG).select(
        F.concat(F.lit("BRP "), F.col("model_family")).alias("name"), F.col("position"))


@query("j14_whitelist_match")
def _(t):
    short = t.select(PRODUCTS).withColumn("malli", F.concat_ws(" ", F.coalesce("malli", F.lit("Tundra")), "paketti"))
    return matching.whitelist_match(short, whitelist(t)).select(
        "product_id", "match_type", "pattern", "suggestion", F.round("score", 6).alias("score"))


_shape = "CASE " + " ".join(f"WHEN regexp_matches(upper(model_text), '^{s}') THEN '{s}'" for s in fixed.WHITELIST_SHAPES) + " END"


@query("j14_exact_and_pattern_tiers", f"""
SELECT product_id, CASE WHEN listed THEN 'exact' ELSE 'pattern' END AS match_type, CASE WHEN NOT listed THEN pattern END AS pattern FROM (
 SELECT product_id, upper(model_text) IN (SELECT upper('BRP ' || model_family) FROM ({C}) c) AS listed, {_shape} AS pattern
 FROM (SELECT product_id, trim('BRP ' || brand || ' ' || malli) AS model_text FROM ({P}) p WHERE coalesce(malli, '') <> '') q) r WHERE listed OR pattern IS NOT NULL""")
def _(t):
    found = matching.whitelist_match(t.select(PRODUCTS), whitelist(t))
    return found.filter(F.col("match_type").isin("exact", "pattern")).select("product_id", "match_type", "pattern")


@query("v02_whitelist_layer")
def _(t):
    from catalign.operators import rules
    checked = rules.whitelist_layer(matching.whitelist_match(t.select(PRODUCTS), whitelist(t)))
    return checked.select("product_id", F.array_join("errors", "; ").alias("errors"),
                          F.array_join("warnings", "; ").alias("warnings"),
                          F.array_join("suggestions", "; ").alias("suggestions"))


@query("j15_containment_suggestion", f"""
WITH w AS (SELECT model_family AS name, position FROM ({C}) c),
 k AS (SELECT DISTINCT trim(malli) AS v FROM ({P}) p WHERE trim(coalesce(malli, '')) <> ''),
 n AS (SELECT v FROM k WHERE v NOT IN (SELECT name FROM w)),
 h AS (SELECT v, name, row_number() OVER (PARTITION BY v ORDER BY position) AS rn FROM n
  JOIN w ON contains(lower(v), lower(name)) OR contains(lower(name), lower(v)))
SELECT product_id, trim(coalesce(malli, '')) IN (SELECT name FROM w) AS listed, h.name AS similar
FROM ({P}) p LEFT JOIN h ON h.v = trim(p.malli) AND h.rn = 1""")
def _(t):
    names = t.select(CATALOG).select(F.col("model_family").alias("name"), "position")
    return matching.suggest_models(t.select(PRODUCTS), names, "malli").select("product_id", "listed", "similar")


_ranges = " UNION ALL ".join(f"SELECT '{k}' AS kind, {quote(v)} AS value, CAST({a} AS DOUBLE) AS low, CAST({b} AS DOUBLE) AS high"
                             for k, v, a, b in fixed.PRICE_RANGES)


@query("j22_price_range", f"""
WITH r AS ({_ranges})
SELECT product_id, coalesce(a.low, b.low, c.low) AS range_low, coalesce(a.high, b.high, c.high) AS range_high,
 p.price BETWEEN coalesce(a.low, b.low, c.low) AND coalesce(a.high, b.high, c.high) AS in_range
FROM ({P}) p LEFT JOIN r a ON a.kind = 'model_code' AND a.value = p.model_code
 LEFT JOIN r b ON b.kind = 'model_family' AND b.value = p.malli
 LEFT JOIN r c ON c.kind = 'engine' AND c.value = p.moottori""")
def _(t):
    ranges = t.spark.createDataFrame(fixed.PRICE_RANGES, "kind string, value string, low double, high double")
    rows = t.select(PRODUCTS).withColumnRenamed("malli", "model_family").withColumnRenamed("moottori", "engine")
    return matching.price_in_range(rows, ranges).select("product_id", "range_low", "range_high", "in_range")


@query("w01_best_match", """
SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM (
 SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey, l_shipdate) AS rn FROM lineitem
 WHERE l_extendedprice > 0) WHERE rn = 1""")
def _(t):
    best = keep.best_match(t.lineitem, ["l_partkey"], "l_extendedprice",
                           ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"])
    return best.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("x02_matcher_plugin", f"""
SELECT product_id, brand || '_' || model_code || '_' || model_year AS listing_id, f.catalog_position FROM ({P}) p
LEFT JOIN (SELECT engine, min(position) AS catalog_position FROM ({C}) c GROUP BY 1) f ON f.engine = p.moottori
WHERE regexp_matches(model_code, '^[A-Z]{{4}}$') AND brand IN ('BRP', 'LYNX', 'SKI-DOO') AND model_year BETWEEN 2015 AND 2030
 AND (price IS NULL OR (currency IN ('EUR', 'RUB') AND price <= 10000000 AND price > 0 AND CASE WHEN currency = 'EUR' THEN price * 100 ELSE price END BETWEEN 100000 AND 10000000))""")
def _(t):
    def by_engine(products, catalog):
        firsts = catalog.groupBy(F.col("engine").alias("moottori")).agg(F.min("position").alias("catalog_position"))
        return products.join(firsts, "moottori", "left")

    made = feed.matched_listings(t.select(PRODUCTS), t.select(CATALOG), by_engine)
    return made.select("product_id", "listing_id", "catalog_position")


@query("x01_similarity_argument", f"""
SELECT conv_id, turn, score >= 0.1 AS matched, CASE WHEN score >= 0.1 THEN item_id END AS catalog_position, round(score, 6) AS score FROM (
 SELECT d.conv_id, d.turn, b.item_id, {WORD_OVERLAP} AS score,
  row_number() OVER (PARTITION BY d.conv_id, d.turn ORDER BY {WORD_OVERLAP} DESC, b.item_id) AS rn FROM conversations d CROSS JOIN benchmark b) s WHERE rn = 1""")
def _(t):
    asked = t.conversations.select("conv_id", "turn", F.col("text").alias("search_text"), F.lit("").alias("brand"))
    known = t.benchmark.select(F.col("text").alias("search_text"), F.lit("").alias("brand"), F.col("item_id").alias("position"))
    found = matching.match_texts(asked, known, 0.1, similarity.word_similarity)
    return found.select("conv_id", "turn", "matched", "catalog_position", F.round("score", 6).alias("score"))
