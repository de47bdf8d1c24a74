"""Matching of price entries and products to catalog models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import fixed, text
from catalign.functions.similarity import letter_similarity
from catalign.operators import contain, tiles
from catalign.operators.keep import best_match, spread_nulls, top_per_key
from catalign.session import written

Matcher = Callable[[DataFrame, DataFrame], DataFrame]


def match_score(code: Column, candidate: Column, model_id: Column, model_name: Column, brand: Column) -> Column:
    """0.5 for an equal id, 0.3 for a name with the candidate, 0.1 for the brand in the code, 0.1 x letters."""
    score = (F.when(model_id == candidate, 0.5).otherwise(0.0)
             + F.when(F.upper(model_name).contains(candidate), 0.3).otherwise(0.0)
             + F.when(code.contains(F.upper(brand)), 0.1).otherwise(0.0)
             + letter_similarity(code, model_id) * 0.1)
    return F.least(F.lit(1.0), score)


def _grams(value: Column) -> Column:
    def of(n: int) -> Column:
        starts = F.when(F.length(value) >= n, F.sequence(F.lit(1), F.length(value) - (n - 1)))
        return F.coalesce(F.transform(starts, lambda i: F.substr(value, i, F.lit(n))), F.array().cast("array<string>"))
    return F.concat(F.array(F.lit("")), *[of(n) for n in range(1, 5)])


def candidate_index(base_models: DataFrame) -> DataFrame:
    """One row per base model and key it can be found by, so that LIKE turns into an equi-join.

    Keys are the parts of up to four letters of id and name, and the family names (whose ``_`` stands for
    any letter) that occur in either; a pattern is looked up by its longest run of letters.
    """
    model_id, name = F.upper("base_model_id"), F.upper("model_name")
    families = sorted({family for _, _, family in fixed.CODE_FAMILIES})
    named = F.array_compact(F.array(*[
        F.when(model_id.like(f"%{f}%") | name.like(f"%{f}%"), F.lit(f)) for f in families]))
    keys = F.array_distinct(F.concat(_grams(model_id), _grams(name), named))
    return base_models.withColumn("key", F.explode(keys))


def find_candidates(requests: DataFrame, base_models: DataFrame) -> DataFrame:
    """Candidate base models of distinct ``(code, brand, model_year)`` requests, scored.

    A candidate taken from the letters of a code may itself hold ``_`` or ``%``; it is looked up by its longest run of
    other letters, and the models found are compared with the pattern.
    """
    wild = F.col("candidate").rlike("[_%]") & ~F.col("candidate").isin(*{f for _, _, f in fixed.CODE_FAMILIES})
    runs = F.transform(F.split("candidate", "[_%]+"), lambda r: F.struct(F.length(r).alias("n"), r.alias("r")))
    asked = requests.withColumn("candidate", F.explode(text.code_candidates(F.col("code"), F.col("brand"))))
    asked = asked.withColumns({"wild": wild, "key": F.when(wild, F.array_max(runs)["r"]).otherwise(F.col("candidate"))}).alias("a")
    shape = F.concat(F.lit("%"), F.col("a.candidate"), F.lit("%"))
    pairs = asked.join(
        candidate_index(base_models).alias("m"),
        (F.col("a.key") == F.col("m.key")) & (F.col("a.model_year") == F.col("m.model_year"))
        & F.ilike(F.col("m.brand"), F.concat(F.lit("%"), F.col("a.brand"), F.lit("%")))
        & (~F.col("a.wild") | F.ilike(F.col("m.base_model_id"), shape) | F.ilike(F.col("m.model_name"), shape)))
    pairs = pairs.select("a.code", "a.brand", "a.model_year", "a.candidate", "m.base_model_id", "m.model_name",
                         F.col("m.brand").alias("model_brand"), "m.position")
    return pairs.withColumn("score", match_score(
        F.upper(F.trim("code")), F.col("candidate"), F.col("base_model_id"), F.col("model_name"),
        F.col("model_brand")))


def match_base_models(entries: DataFrame, base_models: DataFrame, accept: float = 0.7, use: float = 0.8,
                      attach: Sequence[str] = (), boundary: bool = False) -> DataFrame:
    """Stage-1 match of every entry: best candidate, its confidence and the outcome.

    Scores depend on code, brand and year only, so each distinct combination is matched once and
    joined back; a popular code costs no more than a rare one. Columns of the model to ``attach`` come
    along in the same join, null where the match is not accepted.
    """
    keys = ["code", "brand", "model_year"]
    requests = entries.select(F.col("model_code").alias("code"), "brand", "model_year").distinct()
    ranked = best_match(find_candidates(requests, base_models), keys, "score",
                        ["candidate", "model_brand", "model_name", "position"])
    best = ranked.select(*keys, "candidate", F.col("base_model_id").alias("best_id"),
                         F.col("model_name").alias("best_name"), "position", "score")
    if attach:
        best = best.join(base_models.select("position", *attach), "position", "left")
    best = best.drop("position")
    if boundary:
        best = written(best, "matches")
    joined = entries.withColumnRenamed("model_code", "code").join(best, keys, "left").withColumnRenamed(
        "code", "model_code")
    known = F.size(text.code_candidates(F.col("model_code"), F.col("brand"))) > 0
    score = F.coalesce(F.col("score"), F.lit(0.0))
    accepted = score >= accept
    return (joined
            .withColumn("matched_base_model_id", F.when(accepted, F.col("best_id")))
            .withColumn("matched_model_name", F.when(accepted, F.col("best_name")))
            .withColumn("match_confidence", score)
            .withColumns({c: F.when(accepted, F.col(c)) for c in attach})
            .withColumn("structured", score >= use)
            .withColumn("match_reason", F.when(~known, "No base model candidates extracted from code")
                        .when(~accepted, F.concat(F.lit("Best match confidence "), F.format_string("%.2f", score),
                                                  F.lit(f" below threshold {accept:g}"))))
            .drop("best_id", "best_name", "score"))


def with_fallback(matched: DataFrame, suggestions: DataFrame, base_models: DataFrame, attach: Sequence[str] = (),
                  entries: DataFrame | None = None) -> DataFrame:
    """Structured match, else a suggestion that the catalog confirms, else a failed row.

    ``suggestions(entry_id, suggested_id, suggested_confidence)`` come from outside. Given the ``entries`` of the match, they
    are looked up by those, so the match is worked out once; else only rows without a structured match are looked up.
    Columns to ``attach`` come from the model that won.
    """
    open_rows = matched.filter(~F.col("structured")) if entries is None else entries
    asked = open_rows.select("entry_id", "brand", "model_year").join(suggestions, "entry_id")
    index = base_models.withColumn("key", F.upper("base_model_id")).alias("m")
    hits = asked.alias("a").join(
        index, (F.upper("a.suggested_id") == F.col("m.key")) & (F.col("a.model_year") == F.col("m.model_year"))
        & F.ilike(F.col("m.brand"), F.concat(F.lit("%"), F.col("a.brand"), F.lit("%"))))
    first = top_per_key(hits.select("a.entry_id", "a.suggested_confidence", "m.base_model_id", "m.model_name",
                                    "m.brand", "m.position", *[f"m.{c}" for c in attach]),
                        ["entry_id"], [F.col("brand"), F.col("model_name"), F.col("position")])
    first = first.select("entry_id", F.col("base_model_id").alias("verified_id"), F.col("model_name").alias("verified_name"),
                         "suggested_confidence", *[F.col(c).alias(f"_verified_{c}") for c in attach])
    joined = matched.join(first, "entry_id", "left")
    verified = F.col("verified_id").isNotNull()
    return (joined
            .withColumn("matching_method", F.when(F.col("structured"), "structured")
                        .when(verified, "semantic").otherwise("failed"))
            .withColumn("matched_base_model_id", F.when(F.col("structured"), F.col("matched_base_model_id"))
                        .otherwise(F.col("verified_id")))
            .withColumn("matched_model_name", F.when(F.col("structured"), F.col("matched_model_name"))
                        .otherwise(F.col("verified_name")))
            .withColumn("match_confidence", F.when(F.col("structured"), F.col("match_confidence"))
                        .when(verified, F.col("suggested_confidence")).otherwise(0.0))
            .withColumns({c: F.when(F.col("structured"), F.col(c)).otherwise(F.col(f"_verified_{c}")) for c in attach})
            .drop("verified_id", "verified_name", "suggested_confidence", *[f"_verified_{c}" for c in attach]))


def match_by_key(entries: DataFrame, models: DataFrame, confidence: float = 0.98) -> DataFrame:
    """Exact lookup on ``brand_family_year``, the smallest model id where a key occurs twice; misses go to the semantic tier."""
    keyed = entries.withColumn("lookup_key", text.lookup_key(F.col("brand"), F.col("model_family"), F.col("model_year")))
    found = models.groupBy("lookup_key").agg(F.min("base_model_id").alias("matched_base_model_id"))
    hit = F.col("matched_base_model_id").isNotNull()
    return (keyed.join(found, "lookup_key", "left")
            .withColumn("processing_method", F.when(hit, "exact_lookup").otherwise("semantic"))
            .withColumn("confidence_score", F.when(hit, F.lit(confidence))))


def _nearest_by(texts: DataFrame, names: DataFrame, similarity: Callable[[Column, Column], Column]) -> DataFrame:
    """Best name per text under a column similarity; a brand that fits no name is compared with all of them.

    A similarity with ``parts`` (text -> struct) and ``compare`` (of two such structs) has the parts of every text and name taken once, not once a pair.
    """
    parts, compare = getattr(similarity, "parts", lambda c: c), getattr(similarity, "compare", similarity)
    own = F.struct(F.trim(F.upper(F.coalesce("brand", F.lit("")))).alias("brand"), parts(F.col("text")).alias("parts"))
    names = names.select("position", F.upper(F.coalesce("name_brand", F.lit(""))).alias("name_brand"), parts(F.col("name")).alias("parts"))

    def rank(n: Column, text: Column) -> Column:
        fits = n["name_brand"].contains(text["brand"]) | text["brand"].contains(n["name_brand"])
        return F.struct(fits.alias("fits"), compare(text["parts"], n["parts"]).alias("score"), (-n["position"]).alias("after"))

    found = tiles.best_hit(texts, ["text", "brand"], names, ["position", "name_brand", "parts"], rank, own=own)
    score = F.col("hit.score")
    return found.select("text", "brand", F.when(score > 0, -F.col("hit.after")).alias("position"), F.greatest(score, F.lit(0.0)).alias("score"))


def match_texts(products: DataFrame, catalog: DataFrame, threshold: float = 0.7,
                similarity: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Best catalog entry of every product by search-text ratio plus domain boost, or by ``similarity`` of the two texts.

    ``products`` needs ``search_text`` and ``brand``; ``catalog`` needs ``search_text``, ``position``
    and ``brand``. Equal texts are compared once.
    """
    texts = products.select(F.col("search_text").alias("text"), "brand").distinct()
    names = catalog.select(F.col("search_text").alias("name"), F.col("brand").alias("name_brand"), "position")
    names = names.groupBy("name", "name_brand").agg(F.min("position").alias("position"))
    best = tiles.nearest_names(texts, names, boost=True, by_brand=True) if similarity is None else _nearest_by(texts, names, similarity)
    best = best.select(F.col("text").alias("search_text"), "brand", F.col("position").alias("best_position"), "score")
    joined = (products.withColumn("_brand", F.col("brand"))
              .join(best.withColumnRenamed("brand", "_best_brand"),
                    F.col("_brand").eqNullSafe(F.col("_best_brand")) & (products["search_text"] == best["search_text"]),
                    "left")
              .drop(best["search_text"]).drop("_brand", "_best_brand"))
    score = F.coalesce(F.col("score"), F.lit(0.0))
    matched = score >= threshold
    return (joined.withColumn("score", score).withColumn("matched", matched)
            .withColumn("catalog_position", F.when(matched, F.col("best_position"))).drop("best_position"))


def mutual_containment(left: Column, right: Column) -> Column:
    """Either text contains the other, upper-cased; an empty left text never matches."""
    a, b = F.upper(left), F.upper(right)
    return text.filled(left) & (a.contains(b) | b.contains(a))


def mutual_hits(texts: DataFrame, value: str, names: DataFrame, name: str) -> DataFrame:
    """Distinct pairs ``value, name`` of which one contains the other, both ways by an anchor join."""
    left, right = texts.select(value).distinct(), names.select(name).filter(F.col(name).isNotNull()).distinct()
    inside = contain.contained(left, [value], value, right, name).withColumnRenamed("name", name)
    around = contain.contained(right, [name], name, left, value).withColumnRenamed("name", value)
    return inside.unionByName(around).distinct()


def first_containing(products: DataFrame, catalog: DataFrame, model: str = "malli") -> DataFrame:
    """First catalog family (by first position) that contains a product's model or lies in it.

    Of double families the last entry counts, at the place of the first.
    """
    families = catalog.groupBy("model_family").agg(
        F.min("position").alias("position"), F.max("position").alias("entry_position"))
    models = products.select(F.col(model).alias("_model")).filter(text.filled(F.col("_model"))).distinct().withColumn("_upper", F.upper("_model"))
    named = families.withColumn("_name", F.upper("model_family"))
    hits = mutual_hits(models, "_upper", named, "_name")
    first = hits.join(models, "_upper").join(named, "_name").groupBy("_model").agg(
        F.min_by(F.struct("model_family", "entry_position"), F.struct("position", "model_family")).alias("hit"))
    found = first.select("_model", F.col("hit.model_family").alias("model_family"), F.col("hit.entry_position").alias("catalog_position"))
    keyed = products.withColumn("_model", spread_nulls(F.col(model), *products.columns))
    return keyed.join(found, "_model", "left").drop("_model")


def whitelist_match(products: DataFrame, whitelist: DataFrame, brand: str = "brand", model: str = "malli",
                    prefix: str = "BRP") -> DataFrame:
    """Match type of ``prefix brand model`` texts: exact (any case), pattern, fuzzy, none; with a suggestion.

    Every text is resolved once; only those neither exact nor covered by a pattern are compared by ratio.
    """
    spelled = F.trim(F.concat(F.lit(prefix + " "), F.col(brand), F.lit(" "), F.col(model)))
    products = products.withColumn("model_text", F.when(text.filled(F.col(model)), spelled))
    texts = products.select("model_text").filter(F.col("model_text").isNotNull()).distinct()
    known = whitelist.select(F.upper("name").alias("_upper")).distinct().withColumn("_exact", F.lit(True))
    texts = texts.withColumn("_upper", F.upper("model_text")).join(known, "_upper", "left")
    shape = F.coalesce(*[F.when(F.col("_upper").rlike(f"^{s}"), F.lit(s)) for s in fixed.WHITELIST_SHAPES])
    tiered = texts.withColumn("pattern", F.when(F.col("_exact").isNull(), shape))
    rest = tiered.filter(F.col("_exact").isNull() & F.col("pattern").isNull()).select(F.col("model_text").alias("text"))
    names = whitelist.groupBy("name").agg(F.min("position").alias("position"))
    best = tiles.nearest_names(rest, names, fold="upper").select(
        F.col("text").alias("model_text"), F.col("name").alias("_best"), "score")
    tiered = tiered.join(best, "model_text", "left")
    fuzzy = F.col("score") > 0.8
    kinds = (F.when(F.col("_exact"), "exact").when(F.col("pattern").isNotNull(), "pattern")
             .when(fuzzy, "fuzzy").otherwise("none"))
    resolved = tiered.select("model_text", "pattern", kinds.alias("match_type"), "score",
                             F.when(F.col("score") > 0.6, F.col("_best")).alias("suggestion"))
    keyed = products.withColumn("_text", spread_nulls(F.col("model_text"), *products.columns))
    return keyed.join(resolved.withColumnRenamed("model_text", "_text"), "_text", "left").drop("_text")


def suggest_models(values: DataFrame, whitelist: DataFrame, value: str) -> DataFrame:
    """Whitelist check of a value, with the first name that contains it or lies in it as suggestion.

    The distinct values with their outcomes are written first: their measured size lets Spark broadcast them, so that rows, of which a few values
    may hold nearly all, are not shuffled by value unless the distinct values are many.
    """
    clean = F.trim(F.col(value))
    texts = values.select(clean.alias("_clean")).filter(text.filled(F.col("_clean"))).distinct()
    known = whitelist.select(F.col("name").alias("_clean")).distinct().withColumn("_listed", F.lit(True))
    texts = texts.join(known, "_clean", "left")
    missing = texts.filter(F.col("_listed").isNull()).select("_clean", F.lower("_clean").alias("_lower"))
    named = whitelist.select("position", "name", F.lower("name").alias("_name"))
    hits = mutual_hits(missing, "_lower", named, "_name")
    similar = hits.join(missing, "_lower").join(named, "_name").groupBy("_clean").agg(
        F.min(F.struct("position", "name")).alias("hit"))
    texts = texts.join(similar, "_clean", "left").select(
        "_clean", F.coalesce("_listed", F.lit(False)).alias("listed"), F.col("hit.name").alias("similar"))
    texts = written(texts, "models")
    keyed = values.withColumn("_clean", spread_nulls(F.nullif(clean, F.lit("")), *values.columns))
    return (keyed.join(texts, "_clean", "left").drop("_clean")
            .withColumn("listed", F.coalesce("listed", F.lit(False))))


def price_in_range(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Check a price against the range of its code, else its family, else its engine."""
    out = rows
    for kind in ("model_code", "model_family", "engine"):
        part = ranges.filter(F.col("kind") == kind).select(
            F.col("value").alias(kind), F.struct("low", "high").alias(f"_{kind}"))
        out = out.join(part, kind, "left")
    chosen = F.coalesce("_model_code", "_model_family", "_engine")
    return (out.withColumn("range_low", chosen["low"]).withColumn("range_high", chosen["high"])
            .withColumn("in_range", F.col("price").between(F.col("range_low"), F.col("range_high")))
            .drop("_model_code", "_model_family", "_engine"))
