"""The five reconciliation stages as chained DataFrame transforms.

Each stage takes a DataFrame and adds columns; the whole batch is one plan. Only the base-model
match shuffles, everything after it is a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import fixed, maps
from catalign.operators import matching, stats
from catalign.operators.rules import Rule, error, messages, warning

Stage = Callable[[DataFrame], DataFrame]
OPTION = "array<struct<type:string,description:string,confidence:double,method:string>>"


def stage_success(required: Sequence[str]) -> Column:
    """Default success of a stage: all its required columns have a value."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))


def stage_confidence(success: Column, required: Sequence[str]) -> Column:
    """Default confidence of a stage: 0 without success, else the share of required columns with a value, 0.8 if there are none."""
    if not required:
        return F.when(success, 0.8).otherwise(0.0)
    share = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("double") for c in required]) / len(required)
    return F.when(success, share).otherwise(0.0)


def run_stages(df: DataFrame, stages: Sequence[tuple]) -> DataFrame:
    """Apply named stages ``(name, stage, required[, hooks])`` in order; each must leave its required columns behind.

    ``hooks`` may hold ``success`` and ``confidence``, each a Column or True for the default; they add ``<name>_success`` and
    ``<name>_confidence`` (clamped to 0..1).
    """
    for name, stage, required, *rest in stages:
        df = df.transform(stage)
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"stage {name} left out {missing}")
        hooks = rest[0] if rest else {}
        if "success" in hooks or "confidence" in hooks:
            success = hooks.get("success", True)
            df = df.withColumn(f"{name}_success", stage_success(required) if success is True else success)
        if "confidence" in hooks:
            value = hooks["confidence"]
            value = stage_confidence(F.col(f"{name}_success"), required) if value is True else value
            df = df.withColumn(f"{name}_confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))
    return df


# --- inheritance -----------------------------------------------------------------------------------
def base_specs(df: DataFrame, engine: str, suspension: str, dimensions: str, features: str) -> Column:
    """Overlay of the four specification groups, later ones win."""
    return maps.overlay(F.col(engine), F.col(suspension), F.col(dimensions), F.col(features))


def brand_defaults(specs: Column, brand: Column) -> Column:
    arms = [(brand == b, values) for b, values in fixed.BRAND_DEFAULTS.items()]
    return maps.with_defaults(specs, maps.first_map(arms))


def year_updates(specs: Column, year: Column) -> Column:
    """Recent years gain displays and warranties; old ones lose connectivity."""
    for first, values in fixed.YEAR_UPDATES:
        specs = maps.with_defaults(specs, maps.when_map(year >= first, values))
    old = maps.overlay(maps.without(specs, fixed.OLD_LOSES), maps.literal_map(fixed.OLD_VALUES))
    return F.when(year <= fixed.OLD_YEAR, old).otherwise(specs)


def price_tier(specs: Column, price: Column) -> Column:
    tiers = fixed.PRICE_TIERS
    arms = [(price >= fixed.PREMIUM_PRICE, tiers["premium"]), (price >= fixed.MID_PRICE, tiers["mid"]),
            (F.lit(True), tiers["entry"])]
    return maps.with_defaults(specs, maps.first_map(arms))


def inheritance_confidence(base: Column, specs: Column) -> Column:
    n = F.size(specs)
    bonus = F.when(n < 5, F.lit(-0.1)).otherwise(F.least(F.lit(0.2), n * 0.02))
    return F.greatest(F.lit(0.0), F.least(F.lit(0.95), base + bonus))


def inherit(df: DataFrame) -> DataFrame:
    """From ``base_specs``, ``brand``, ``model_year``, ``price``, ``inheritance_base``."""
    specs = brand_defaults(F.col("base_specs"), F.col("brand"))
    specs = year_updates(specs, F.col("model_year"))
    df = df.withColumn("inherited_specs", price_tier(specs, F.col("price")))
    return df.withColumn("inheritance_confidence", inheritance_confidence(F.col("inheritance_base"), F.col("inherited_specs")))


# --- customization ---------------------------------------------------------------------------------
def code_customizations(code: Column) -> Column:
    code = F.upper(code)
    engine = maps.first_map([(code.rlike(p), v) for p, v in fixed.ENGINE_CODES])
    track = maps.first_map([(code.rlike(p), v) for p, v in fixed.TRACK_CODES])
    features = [maps.when_map(code.rlike(p), v) for p, v in fixed.FEATURE_CODES]
    return maps.overlay(engine, track, *features)


def variant_details(code: Column, brand: Column) -> Column:
    code = F.upper(code)
    line = maps.first_map([((brand == b) & code.rlike(p), v) for b, p, v in fixed.VARIANT_CODES])
    return maps.overlay(line, *[maps.when_map(code.rlike(p), v) for p, v in fixed.TRIM_CODES])


def customization_confidence(custom: Column, code: Column) -> Column:
    n = F.size(custom)
    boost = F.when(n >= 5, 0.2).when(n >= 3, 0.1).when(n >= 1, 0.05).otherwise(-0.2)
    boost = boost + F.when(maps.any_key(custom, "engine") & maps.any_key(custom, "track"), 0.1).otherwise(0.0)
    boost = boost + F.when(F.length(code) >= 8, 0.05).otherwise(0.0)
    return F.greatest(F.lit(0.1), F.least(F.lit(0.95), boost + 0.7))


def customize(df: DataFrame) -> DataFrame:
    code = F.col("model_code")
    df = df.withColumn("code_specs", code_customizations(code)).withColumn("variant", variant_details(code, F.col("brand")))
    custom = maps.overlay(F.col("code_specs"), maps.difference(F.col("inherited_specs"), F.col("code_specs")), F.col("variant"))
    df = df.withColumn("customizations", custom)
    return df.withColumn("customization_confidence", customization_confidence(F.col("customizations"), code))


# --- options ---------------------------------------------------------------------------------------
def option(kind: str, description: str, confidence: float, method: str) -> Column:
    text = maps.sql_text
    return F.expr(f"named_struct('type', {text(kind)}, 'description', {text(description)}, "
                  f"'confidence', {confidence}D, 'method', {text(method)})")


def detect_options(code: Column, custom: Column, price: Column) -> Column:
    """All options in detection order: code patterns, customizations, season and price."""
    code = F.upper(code)
    found = [F.when(code.rlike(p), option(kind, text, c, "model_code_pattern")) for p, kind, text, c in fixed.OPTION_CODES]
    found += [F.when(F.try_element_at(custom, F.lit(key)) == value, option(kind, text, c, how))
              for key, value, kind, text, c, how in fixed.OPTION_RULES]
    found.append(F.when(price >= fixed.PREMIUM_PRICE, option(*fixed.LUXURY_OPTION)))
    return F.array_compact(F.array(*found)).cast(OPTION)


def rank_options(options: Column) -> Column:
    """Highest confidence per type and description, then by confidence, first detected first."""
    def key(o: Column) -> Column:
        return F.concat(o["type"], F.lit("|"), F.lower(o["description"]))

    placed = F.transform(options, lambda o, i: F.struct((-o["confidence"]).alias("c"), i.alias("i"), key(o).alias("k"), o.alias("o")))
    ordered = F.array_sort(placed)
    keys = F.transform(ordered, lambda p: p["k"])
    best = F.filter(ordered, lambda p, i: F.array_position(keys, p["k"]) == i + 1)
    place = F.transform(options, key)
    ranked = F.array_sort(F.transform(best, lambda p: F.struct(
        p["c"].alias("c"), F.array_position(place, p["k"]).alias("i"), p["o"].alias("o"))))
    return F.transform(ranked, lambda p: p["o"])


def options_confidence(options: Column, custom: Column) -> Column:
    n = F.size(options)
    total = F.aggregate(options, F.lit(0.0), lambda s, o: s + o["confidence"])
    kinds = F.size(F.array_distinct(F.transform(options, lambda o: o["type"])))
    score = total / n + F.least(F.lit(0.2), F.size(custom) * 0.02) + F.least(F.lit(0.1), kinds * 0.03)
    return F.when(n == 0, 0.5).otherwise(F.greatest(F.lit(0.1), F.least(F.lit(0.95), score)))


def enhance_options(df: DataFrame) -> DataFrame:
    found = detect_options(F.col("model_code"), F.col("customizations"), F.col("price"))
    df = df.withColumn("detected_options", found).withColumn("spring_options", rank_options(F.col("detected_options")))
    return df.withColumn("options_confidence", options_confidence(F.col("spring_options"), F.col("customizations")))


# --- final validation ------------------------------------------------------------------------------
def _spec(name: str) -> Column:
    return F.try_element_at(F.col("final_specs"), F.lit(name))


def final_checks() -> list[Rule]:
    price, brand = F.col("price"), F.col("brand")
    inherited = F.size("inherited_specs")
    volume, stroke = _spec("displacement"), _spec("engine_type")
    no_base = F.col("matched_base_model_id").isNull()
    values = F.transform(F.map_values("final_specs"), lambda v: F.lower(v))
    premium = sum((_holds(values, word) for word in fixed.PREMIUM_WORDS), F.lit(0))
    options = F.col("spring_options")

    def several(word: str) -> Column:
        return F.size(F.filter(options, lambda o: o["type"].contains(word))) > 1

    found = [
        error("code", F.coalesce(F.col("model_code"), F.lit("")) == "", "Missing model code"),
        error("brand", F.coalesce(brand, F.lit("")) == "", "Missing brand"),
        error("price", price <= 0, "Invalid price"),
        warning("base", no_base, "No base model matched"),
        error("base", no_base & (inherited == 0), "No base model matched and no specifications inherited"),
        warning("few", inherited < 3, "Very few specifications inherited"),
        warning("large", volume.contains("1000cc") & (stroke != "4-stroke"), "Large displacement with 2-stroke engine seems unusual"),
        warning("small", volume.contains("600cc") & (stroke != "2-stroke"), "Small displacement with 4-stroke engine seems unusual"),
        warning("track", (_spec("track_type") == "mountain") & ~F.lower(_spec("suspension")).contains("air"),
                "Mountain track without air suspension seems unusual"),
        warning("grips", (price > 20000) & ~F.coalesce(_spec("heated_grips"), F.lit("false")).isin("true"),
                "High-priced model without heated grips"),
        warning("reverse", (price > 20000) & (F.coalesce(_spec("reverse"), F.lit("false")) != "electric"),
                "High-priced model without electric reverse"),
    ]
    for name, (low, high) in fixed.BRAND_PRICES.items():
        label = F.concat(F.lit(f" for {name} ("), price.cast("string"), F.lit(")"))
        found.append(warning("low", (brand == name) & (price < low), F.concat(F.lit("Price seems low"), label)))
        found.append(warning("high", (brand == name) & (price > high), F.concat(F.lit("Price seems high"), label)))
    found += [
        warning("cheap", (premium >= 3) & (price < 15000), "Many premium features but relatively low price"),
        warning("plain", (premium == 0) & (price > 18000), "High price but few premium features detected"),
        warning("tracks", several("track"), "Multiple track options detected - may be conflicting"),
        warning("shocks", several("suspension"), "Multiple suspension options detected"),
    ]
    return found


def _holds(values: Column, word: str) -> Column:
    return F.exists(values, lambda v: v.contains(word)).cast("int")


def final_confidence() -> Column:
    code = F.upper("model_code")
    suspect = F.lit(False)
    for word in fixed.SUSPECT_WORDS:
        suspect = suspect | code.contains(word)
    n = F.size("inherited_specs") + F.size("customizations")
    score = (F.col("current_confidence") + (F.col("quality_score") - 0.7) * 0.2 + F.least(F.lit(0.1), n * 0.01)
             - F.size("errors") * 0.1 - F.size("warnings") * 0.02 - F.when(suspect, 0.3).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(0.95), score))


def validate(df: DataFrame) -> DataFrame:
    """Messages, quality score, final confidence and level; success needs no error."""
    df = df.withColumns({
        "final_specs": maps.overlay(F.col("inherited_specs"), F.col("customizations")),
        "current_confidence": F.least("inheritance_confidence", "customization_confidence", "options_confidence")})
    checks = final_checks()
    df = df.withColumns({"errors": messages(checks, "error"), "warnings": messages(checks, "warning")})
    quality = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - F.size("errors") * 0.2 - F.size("warnings") * 0.05))
    df = df.withColumn("quality_score", quality)
    good = F.size("errors") == 0
    return df.withColumns({"validated": good, "final_confidence": F.when(good, final_confidence()).otherwise(0.0)})


# --- whole batch -----------------------------------------------------------------------------------
def match_stage(base_models: DataFrame, suggestions: DataFrame | None = None, use: float = 0.8) -> Stage:
    """The matching cascade: a structured match of ``use`` or more, else a suggestion that the catalog confirms, else failed.

    The specification groups of the model that won come along; ``matching_method`` tells how it was found.
    """
    groups = ["base_specs", "inheritance_base"]

    def stage(entries: DataFrame) -> DataFrame:
        matched = matching.match_base_models(entries, base_models, accept=use, use=use, attach=groups, boundary=True)
        if suggestions is None:
            matched = matched.withColumns({
                "matching_method": F.when(F.col("structured"), "structured").otherwise("failed"),
                "match_confidence": F.when(F.col("structured"), F.col("match_confidence")).otherwise(0.0)})
        else:
            matched = matching.with_fallback(matched, suggestions, base_models, groups, entries)
        return matched.withColumns({
            "base_specs": F.coalesce("base_specs", maps.literal_map({})),
            "inheritance_base": F.coalesce("inheritance_base", F.lit(0.0))}).drop("candidate")

    return stage


def reconcile(entries: DataFrame, base_models: DataFrame, high: float = 0.9, medium: float = 0.7,
              suggestions: DataFrame | None = None) -> DataFrame:
    """Entries through all five stages, with stage results, weighted confidence, level and error rows.

    An entry without a base model fails at the first stage and carries its error; nothing is dropped.
    """
    done = run_stages(entries, [
        ("base_model_matching", match_stage(base_models, suggestions), ["matched_base_model_id", "match_confidence", "base_specs"]),
        ("specification_inheritance", inherit, ["inherited_specs", "inheritance_confidence"]),
        ("customization_processing", customize, ["customizations", "customization_confidence"]),
        ("spring_options_enhancement", enhance_options, ["spring_options", "options_confidence"]),
        ("final_validation", validate, ["final_confidence", "errors", "warnings"]),
    ])
    scores = dict(zip([s for s, _ in fixed.STAGE_WEIGHTS], [
        F.col("match_confidence"), F.col("inheritance_confidence"), F.col("customization_confidence"),
        F.col("options_confidence"), F.col("final_confidence")]))
    matched = F.col("matched_base_model_id").isNotNull()
    success = matched & F.col("validated")
    overall = F.when(success, stats.weighted_confidence(scores, fixed.STAGE_WEIGHTS))
    results = F.array(*[F.struct(F.lit(s).alias("stage"), c.alias("confidence")) for s, c in scores.items()])
    return done.withColumns({
        "success": success, "overall_confidence": overall, "stage_results": results,
        "failed_stage": F.when(~matched, "base_model_matching").when(~F.col("validated"), "final_validation"),
        "confidence_level": F.when(overall >= high, "high").when(overall >= medium, "medium").when(overall.isNotNull(), "low"),
    })


def batch_totals(done: DataFrame) -> DataFrame:
    """Totals of a reconciled batch."""
    return done.agg(F.count("*").alias("total"), F.count_if("success").alias("successful"),
                    F.count_if(~F.col("success")).alias("failed"), F.avg("overall_confidence").alias("avg_confidence"))


def auto_approve(done: DataFrame, threshold: float = 0.9) -> DataFrame:
    approved = F.col("success") & (F.col("overall_confidence") >= threshold)
    return done.withColumn("review_status", F.when(approved, "auto_approved").when(F.col("success"), "pending_review"))
