"""Joins of products, specifications, prices, options and inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.functions.text import engine_name
from catalign.operators import contain
from catalign.operators.keep import spread_nulls
from catalign.session import written

CLASS_IDS = 1024  # ids of alike specifications that one joined row carries at most
TASK_PRICES = 16384  # price rows of a task; Parquet keeps a dictionary of so many keys of some 25 characters (1 MB a column)


def product_360(products: DataFrame, mappings: DataFrame, entries: DataFrame, models: DataFrame) -> DataFrame:
    """Products with their mapping, price entry and base model where present."""
    return (products.join(mappings, "sku", "left").join(entries, "model_code", "left")
            .join(models, "base_model_id", "left"))


def child_rows(parents: DataFrame, models: DataFrame, on: Column, children: DataFrame, key: str) -> DataFrame:
    """Parents left joined to a model and to their child rows, one row per child."""
    return parents.join(models, on, "left").join(children, key, "left")


def child_document(parents: DataFrame, models: DataFrame, on: Column, children: DataFrame, key: str, order: Sequence[str],
                   out: str) -> DataFrame:
    """The document form for a few chosen parents: child rows as an ordered array.

    Filter ``parents`` first; only their children are gathered.
    """
    children = children.join(parents.select(key), key, "left_semi")
    packed = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *[
        c for c in children.columns if c != key and c not in order]))).alias(out))
    return parents.join(models, on, "left").join(packed, key, "left")


def unseen(files: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """Files without a log row."""
    return files.join(log.select(name).distinct(), name, "left_anti")


def seen(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return rows.join(others.select(key).distinct(), key, "left_semi")


def engine_suffix_free(name: Column) -> Column:
    return engine_name(F.regexp_replace(name, "(?i) with .*$", ""))


def _with_engine_key(rows: DataFrame, engine: str, keys: DataFrame, *spread: str) -> DataFrame:
    """Rows with the key ``e`` of their engine; a row without one has the key of no name."""
    named = keys.select(F.col("engine").alias("_engine"), F.col("e").alias("_e"))
    keyed = rows.withColumn("_engine", spread_nulls(F.col(engine), *spread)).join(named, "_engine", "left")
    return keyed.withColumn("e", F.coalesce(F.when(F.col(engine).isNotNull(), F.col("_e")), F.lit(""))).drop("_engine", "_e")


def spec_price_join(specs: DataFrame, pricing: DataFrame, tolerance: float = 0.05, price_rows: int | None = None) -> dict[str, DataFrame]:
    """Match specifications with price rows by brand, model and engine, then judge track lengths.

    ``specs(spec_id, brand, model, engines, track_mm)``, ``pricing(sku, brand, model, engine, track_mm)``.
    Exact engine names and tracks are perfect; a track within ``tolerance`` is high, without a track
    length medium, beyond it low. Rows left over on either side come with a reason: they are found by the distinct keys of the other side, so
    pairs are built for the matches alone.

    Pairs outgrow both inputs where keys repeat, so they are made to take little room where they are written: specifications alike in key,
    track and engine are judged as one class, and a merge join gives the pairs price row by price row, those of a key together and in one
    order of specifications. ``price_rows``, the size of ``pricing``, deals them to one task per ``TASK_PRICES``; no key stays in one task.

    An engine's key takes ten patterns, so each distinct engine gets its own once. Distinct names of prices with their counts, then distinct
    engines, are written first: their measured size lets Spark broadcast them, and prices are read once more only.
    """
    variants = specs.select("spec_id", "track_mm", F.upper("brand").alias("b"), F.upper("model").alias("m"),
                            F.explode_outer("engines").alias("spec_engine"))
    priced = pricing.select("sku", F.col("track_mm").alias("price_mm"), F.upper("brand").alias("b"), F.upper("model").alias("m"),
                            F.col("engine").alias("price_engine"))
    counted = written(pricing.groupBy("brand", "model", "engine").agg(F.count("*").alias("n")), "names")
    engines = variants.select(F.col("spec_engine").alias("engine")).unionByName(counted.select("engine")).filter("engine IS NOT NULL").distinct()
    engines = written(engines.select("engine", engine_suffix_free(F.col("engine")).alias("e")), "engines")
    variants = _with_engine_key(variants, "spec_engine", engines, "spec_id")
    priced = _with_engine_key(priced, "price_engine", engines, "sku")
    named = _with_engine_key(counted.select(F.upper("brand").alias("b"), F.upper("model").alias("m"), "engine", "n"), "engine", engines, "b", "m")
    keys = ["b", "m", "e"]
    alike = [*keys, "track_mm", "spec_engine"]
    place = F.row_number().over(Window.partitionBy(*alike).orderBy("spec_id"))
    classes = (variants.withColumn("block", F.floor((place - 1) / CLASS_IDS)).groupBy(*alike, "block")
               .agg(F.transform(F.collect_list(F.struct("spec_id")), lambda s: s["spec_id"]).alias("specs")))  # nulls stay
    # keys of more price rows than a task has, with the slices to deal them in; a row of the input per ``TASK_PRICES`` at most
    crowded = F.broadcast(named.groupBy(*keys).agg(F.ceil(F.sum("n") / TASK_PRICES).alias("slices")).filter("slices > 1"))
    dealt = priced.join(crowded, keys, "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("sku"), "slices"), F.lit(0)))
    spread = classes.join(crowded, keys, "left").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("slices", F.lit(1)) - 1)))
    if price_rows is not None:
        dealt = dealt.repartition(price_rows // TASK_PRICES + 1, *keys, "slice")
    pairs = dealt.join(spread.hint("merge"), [*keys, "slice"])
    gap = F.abs(F.col("track_mm") - F.col("price_mm")) / F.col("track_mm")
    same = F.col("spec_engine") == F.col("price_engine")
    tier = (F.when(same & (gap == 0), "perfect").when(gap <= tolerance, "high").when(gap.isNull(), "medium").otherwise("low"))
    score = F.when(tier == "perfect", 1.0).when(tier == "high", 0.95).when(tier == "medium", 0.8).otherwise(0.6)
    judged = pairs.select("specs", "sku", "spec_engine", "price_engine", tier.alias("tier"), score.alias("confidence"))
    matches = judged.select(F.explode("specs").alias("spec_id"), "sku", "spec_engine", "price_engine", "tier", "confidence")
    met_specs = variants.join(named.select(*keys).distinct(), keys, "left_semi").select("spec_id").distinct()
    met_skus = priced.join(variants.select(*keys).distinct(), keys, "left_semi").select("sku").distinct()
    return {
        "matches": matches,
        "unmatched_specs": specs.join(met_specs, "spec_id", "left_anti").withColumn("reason", F.lit("no_corresponding_price_data")),
        "unmatched_pricing": pricing.join(met_skus, "sku", "left_anti").withColumn("reason", F.lit("no_corresponding_spec")),
    }


def inherit_engine(pricing: DataFrame, specs: DataFrame) -> DataFrame:
    """Price variants with the values of their engine from the base specification, and feature notes.

    ``specs(brand, model, engines: array<struct<name, displacement, turbo, weight>>)``, unique per model.
    """
    engines = specs.select("brand", "model", F.explode("engines").alias("spec")).withColumn("engine", F.col("spec.name"))
    joined = pricing.join(engines, ["brand", "model", "engine"], "left")
    notes = F.array_compact(F.array(
        F.when(F.col("engine") == "850 E-TEC Turbo R", "Launch Control and E-TEC SHOT starter"),
        F.when(F.col("track").contains("Ice Ripper XT"), "studded track"),
        F.when(F.col("display").contains("10.25 in. Color Touchscreen"), "BRP Connect and built-in GPS")))
    return joined.select("*", F.col("spec.displacement").alias("displacement"), F.col("spec.turbo").alias("turbo"),
                         F.col("spec.weight").alias("dry_weight"), notes.alias("highlights")).drop("spec")


def option_usage_in_text(options: DataFrame, texts: DataFrame, keys: Sequence[str], as_of: Column, days: int = 30) -> DataFrame:
    """How many texts of the last ``days`` contain each option name; ``_`` and ``%`` in a name are wildcards.

    ``options(option_id, name, deleted_at, ...)`` keeps its other registry columns; deleted options are left out.
    ``texts(text, created_at)`` meet a name only where they hold its anchor: its rarest part, of a pattern that of its longest run.
    """
    options = options.filter(F.col("deleted_at").isNull()).drop("deleted_at")
    texts = texts.filter(F.col("created_at") >= F.date_sub(as_of, days))
    named = contain.with_run_anchor(options.filter(F.col("name").isNotNull()), "name")
    like = lambda t, n: F.when(n.rlike("[_%]"), F.like(t, F.concat(F.lit("%"), n, F.lit("%")))).otherwise(t.contains(n))
    hits = contain.contained(texts.select(*keys, "text"), keys, "text", named, "name", like).join(options.select("option_id", "name"), "name")
    used = hits.groupBy("option_id").agg(F.count("*").alias("recent_usage_count"))
    return options.join(used, "option_id", "left").withColumn("recent_usage_count", F.coalesce("recent_usage_count", F.lit(0)))


def known_options(entries: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Registry options found in each entry's option text and what is left after removing them.

    ``registry(position, name, brand, family)``: a null brand or family fits all. ``entries`` carry
    ``text``, ``brand`` and ``family``; equal combinations, blanks around the text apart, are looked up once, by the text and the names
    that it holds.
    """
    same = ["text", "brand", "family"]
    keyed = entries.withColumn("text", F.nullif(F.trim("text"), F.lit("")))
    asked = keyed.select(*same).filter("text IS NOT NULL").distinct().withColumn("lower", F.lower("text"))
    named = registry.withColumn("known_as", F.lower("name"))
    held = contain.contained(asked.select("lower").distinct(), ["lower"], "lower", named, "known_as").withColumnRenamed("name", "known_as")
    options = held.join(named.select("known_as", F.struct("position", "name", "brand", "family").alias("n")), "known_as")
    met = asked.join(options, "lower", "left")
    fits = F.coalesce(F.col("n.brand") == F.col("brand"), F.col("n.brand").isNull()) & F.coalesce(F.col("n.family") == F.col("family"), F.col("n.family").isNull())
    hits = met.groupBy(*same).agg(F.array_sort(F.collect_list(F.when(fits, F.col("n")))).alias("hits"))
    names = F.transform("hits", lambda h: h["name"])
    rest = F.aggregate(names, F.lower("text"), lambda left, name: F.replace(left, F.lower(name), F.lit("")))
    found = hits.select(*[F.col(c).alias(f"_{c}") for c in same], names.alias("known"),
                        F.trim(F.regexp_replace(rest, r"[\s,;]+", " ")).alias("remainder"))
    spread = keyed.withColumn("text", spread_nulls(F.col("text"), *keys))
    on = (F.col("text") == F.col("_text")) & F.col("brand").eqNullSafe(F.col("_brand")) & F.col("family").eqNullSafe(F.col("_family"))
    return spread.join(found, on, "left").select(*keys, "known", "remainder")


def new_registry_rows(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct remainders to be stored as new, unvalidated options."""
    return found.filter(F.col("remainder") != "").groupBy(F.col("remainder").alias("name")).agg(
        F.min(keys[0]).alias("first_seen"), F.count("*").alias("times_seen")).withColumn("validated", F.lit(False))


def unknown_fields(rows: DataFrame, fields: str, known: Sequence[str]) -> DataFrame:
    """Filled fields of a map column that no mapping knows, with how often each occurs."""
    filled = F.map_keys(F.map_filter(fields, lambda _, v: F.coalesce(v, F.lit("")) != ""))
    unknown = F.array_except(filled, F.array(*[F.lit(k) for k in known]))
    return rows.select(F.explode(unknown).alias("field")).groupBy("field").agg(F.count("*").alias("occurrences"))


def per_language(rows: DataFrame, languages: Sequence[str] = ("fi", "en")) -> DataFrame:
    """One row per row and language, with currency and market."""
    wanted = [x for x in fixed.LANGUAGES if x[0] in languages]
    options = F.array(*[F.struct(F.lit(a).alias("language"), F.lit(b).alias("language_name"), F.lit(c).alias("language_currency"),
                                 F.lit(d).alias("language_market")) for a, b, c, d in wanted])
    return rows.withColumn("_language", F.explode(options)).select("*", "_language.*").drop("_language")


def verify_inventory(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local files against a remote listing by name: missing, size differs, or verified."""
    joined = local.select("name", F.col("length").alias("local_size")).join(
        remote.select("name", F.col("length").alias("remote_size")), "name", "left")
    state = (F.when(F.col("remote_size").isNull(), "missing").when(F.col("local_size") != F.col("remote_size"), "size_mismatch")
             .otherwise("verified"))
    return joined.withColumn("state", state)


def dimension_join(products: DataFrame, suppliers: DataFrame, categories: DataFrame, supplier: str, category: str) -> DataFrame:
    return products.join(suppliers, supplier).join(categories, category)
