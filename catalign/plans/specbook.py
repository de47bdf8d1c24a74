"""Specification pages to typed nested specifications.

All rules read the lines of one page cell as an array, so a page is one projection without shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import fixed, text
from catalign.operators.keep import dedup_array


def lines_of(page: Column) -> Column:
    return F.transform(F.split(page, "\n"), lambda line: F.trim(line))


def last_match(lines: Column, pattern: str, group: int = 1) -> Column:
    """Group of the last line that matches; null without one."""
    hits = F.filter(F.transform(lines, lambda line: F.regexp_extract(line, pattern, group)), lambda x: x != "")
    return F.try_element_at(hits, F.lit(-1))


def engine_names(page: Column) -> Column:
    """Engine headings in pattern order, first spelling per normal form."""
    found = [F.regexp_extract_all(page, F.lit(f"(?iU){p}"), F.lit(0)) for p in fixed.ENGINE_HEADINGS]
    clean = F.transform(F.concat(*found), lambda m: F.trim(F.regexp_replace(m, r"(?U)[®\s]+", " ")))
    return dedup_array(clean, text.engine_name)


def engine_values(page: Column) -> Column:
    """Struct of the engine values of a page; the last line that names one wins."""
    return text.let(lines_of(page), _engine_struct)


def _engine_struct(lines: Column) -> Column:
    lower = F.transform(lines, lambda line: F.lower(line))
    cooled = F.filter(lower, lambda line: line.contains("liquid-cooled"))
    strokes = F.filter(F.transform(cooled, lambda line: F.when(line.contains("two-stroke"), "2-stroke")
                                   .when(line.contains("four-stroke"), "4-stroke")), lambda x: x.isNotNull())
    low, high = (last_match(lines, r"(\d+)\s*-\s*(\d+\.?\d*)\s*cc", i) for i in (1, 2))
    bore, stroke = (last_match(lines, r"(\d+\.?\d*)\s*x\s*(\d+\.?\d*)\s*mm", i) for i in (1, 2))
    values = {
        "cooling": F.when(F.size(cooled) > 0, "liquid-cooled"),
        "type": F.try_element_at(strokes, F.lit(-1)),
        "displacement": F.floor(high.try_cast("double")).try_cast("int"),
        "displacement_cc": F.concat(low, F.lit(" - "), high, F.lit(" cc")),
        "bore_stroke": F.concat(bore, F.lit(" x "), stroke, F.lit(" mm")),
        "fuel_system": F.trim(last_match(lines, r"(?i)fuel system\s+(.*)")),
        "fuel_type": F.when(F.exists(lower, lambda line: line.contains("premium unleaded")), "Premium unleaded - 95"),
        "fuel_tank_l": last_match(lines, r"(?i)fuel tank.*?(\d+)").try_cast("int"),
    }
    return F.struct(*[c.alias(n) for n, c in values.items()])


ENGINE_VALUES = ["cooling", "type", "displacement", "displacement_cc", "bore_stroke", "fuel_system", "fuel_type", "fuel_tank_l"]


def engine_variants(names: Column, values: Column) -> Column:
    """One struct per engine name; a single standard engine when only values are known."""
    known = F.coalesce(*[values[n].cast("string") for n in ENGINE_VALUES]).isNotNull()
    chosen = F.when(F.size(names) > 0, names).when(known, F.array(F.lit("Standard Engine"))).otherwise(F.array().cast("array<string>"))
    return F.transform(chosen, lambda name: F.struct(
        name.alias("name"), F.lower(name).contains("turbo").alias("turbo"), *[values[n].alias(n) for n in ENGINE_VALUES]))


def dimensions(page: Column) -> Column:
    """Struct of lengths and dry weight; the last line that names one wins."""
    return text.let(lines_of(page), lambda lines: F.struct(*[
        last_match(lines, rf"(?i){label}.*?(\d{{1,4}})\s*{unit}").cast("int").alias(name)
        for name, label, unit in fixed.DIMENSION_LINES]))


def feature_lists(page: Column) -> Column:
    """Struct of bullet texts under the last heading above them, deduplicated per section."""
    def heading(line: Column) -> Column:
        lower = F.lower(line)
        capital = (line == F.upper(line)) & (line != lower)
        return (F.when(lower.contains("what's new"), "whats_new").when(lower.contains("package highlights"), "package_highlights")
                .when(lower.contains("features") & capital, "features").otherwise(""))

    def step(state: Column, line: Column) -> Column:
        new = heading(line)
        bullet = line.startswith("•") | line.startswith("�")
        item = F.trim(F.regexp_replace(line, r"^[•�]\s*", ""))
        use = (new == "") & bullet & (item != "") & (state["section"] != "")
        added = F.array(F.struct(state["section"].alias("section"), item.alias("item")))
        return F.struct(F.when(new != "", new).otherwise(state["section"]).alias("section"),
                        F.when(use, F.concat(state["items"], added)).otherwise(state["items"]).alias("items"))

    start = F.struct(F.lit("").alias("section"), F.array().cast("array<struct<section:string,item:string>>").alias("items"))
    items = F.aggregate(lines_of(page), start, step, lambda s: s["items"])

    def of(found: Column, name: str) -> Column:
        own = F.transform(F.filter(found, lambda i: i["section"] == name), lambda i: i["item"])
        return dedup_array(own, text.item_text).alias(name)

    return text.let(items, lambda found: F.struct(*[of(found, n) for n in ("features", "whats_new", "package_highlights")]))


def track_options(page: Column) -> Column:
    """Track structs (name, length, width, profile), first per name and size; a number that its type cannot hold is null."""
    part = [F.regexp_extract_all(page, F.lit(fixed.TRACK_SCAN), F.lit(i)) for i in range(1, 5)]
    tracks = F.transform(part[0], lambda name, i: F.struct(
        F.trim(name).alias("name"), F.get(part[1], i).try_cast("int").alias("length_inch"), F.get(part[2], i).try_cast("int").alias("width_inch"),
        F.get(part[3], i).try_cast("double").alias("profile_inch")))
    return dedup_array(tracks, lambda t: F.concat_ws("", F.upper(F.trim(t["name"])), t["length_inch"].cast("string"),
                                                     t["width_inch"].cast("string"), t["profile_inch"].cast("string")))


def sku(brand: Column, model: Column, configuration: Column, year: Column) -> Column:
    def dashed(c: Column) -> Column:
        return F.upper(F.replace(c, F.lit(" "), F.lit("-")))
    return F.concat_ws("-", brand, dashed(model), F.when(configuration != "Base", dashed(configuration)), year.cast("string"))


def extract_pages(pages: DataFrame, page_text: str = "text", brand: str = "brand", year: str = "model_year",
                  page: str = "page", document: str = "doc") -> DataFrame:
    """Relevant pages with a known model as nested specifications and indexed columns."""
    body = F.col(page_text)
    # exploding drops pages without a title and keeps Spark from computing the title again for a filter
    titled = F.explode(F.array_compact(F.array(text.relevant_page_title(body)))).alias("_title")
    kept = pages.select("*", titled).withColumns({
        "_names": engine_names(body), "_values": engine_values(body), "_tracks": track_options(body),
        "_dims": dimensions(body), "_lists": feature_lists(body)})
    kept = kept.withColumn("_engines", engine_variants(F.col("_names"), F.col("_values"))).select("*", "_title.*", "_lists.*")
    engines = F.transform("_engines", lambda e: F.struct(
        e["name"].alias("name"), F.coalesce(e["type"], F.lit("2-stroke")).alias("type"), e["displacement"].alias("displacement"),
        e["bore_stroke"].alias("bore_stroke"), e["turbo"].alias("turbo"), F.coalesce(e["cooling"], F.lit("liquid-cooled")).alias("cooling"),
        e["fuel_system"].alias("fuel_system"), e["fuel_type"].alias("fuel_type"), e["fuel_tank_l"].alias("fuel_tank_l"),
        e["displacement_cc"].alias("displacement_cc")))
    tracks = F.transform("_tracks", lambda t: F.struct(
        t["name"].alias("name"), F.concat_ws("x", t["length_inch"], t["width_inch"], t["profile_inch"]).alias("size"),
        t["length_inch"].alias("length_inch"), t["width_inch"].alias("width_inch"), t["profile_inch"].alias("profile_inch")))
    d = F.col("_dims")
    overall = F.struct(d["overall_length_mm"].alias("length_mm"), d["overall_width_mm"].alias("width_mm"),
                       d["overall_height_mm"].alias("height_mm"))
    spec = F.struct(
        engines.alias("engines"), F.struct(overall.alias("overall"), d["ski_stance_mm"].alias("ski_stance_mm"),
                                           d["dry_weight_kg"].alias("dry_weight_kg")).alias("dimensions"),
        tracks.alias("tracks"), F.struct(F.lit("REV Gen5").alias("platform"), F.col(page).alias("source_page")).alias("features"))
    first = F.get("_engines", F.lit(0))
    return kept.select(
        F.col(document).alias("source_document"), F.col(page).alias("source_page"), F.col(brand), F.col(year),
        "model", "configuration", "category", sku(F.col(brand), F.col("model"), F.col("configuration"), F.col(year)).alias("sku"),
        F.concat_ws(" ", brand, "model", "configuration").alias("description"), spec.alias("specifications"),
        F.col("features").alias("feature_list"), "whats_new", "package_highlights",
        first["displacement"].alias("primary_engine_displacement"), first["type"].alias("engine_type"),
        d["dry_weight_kg"].alias("min_dry_weight_kg"), d["dry_weight_kg"].alias("max_dry_weight_kg"),
        F.exists("_engines", lambda e: e["turbo"]).alias("has_turbo"),
        F.greatest(F.size("_engines"), F.lit(1)).alias("engine_count"),
        (F.get("_tracks", F.lit(0))["length_inch"] * 25.4).alias("track_length_mm"), d["ski_stance_mm"].alias("ski_stance_mm"))
