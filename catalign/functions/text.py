"""Text rules as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalign.functions import fixed


def filled(value: Column) -> Column:
    """True for a text that is neither null nor empty."""
    return F.coalesce(value, F.lit("")) != ""


def or_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def first_word(text: Column, words: Sequence[str]) -> Column:
    """The first listed word that occurs in ``text``."""
    return F.coalesce(*[F.when(text.contains(w), F.lit(w)) for w in words])


def any_word(text: Column, words: Sequence[str]) -> Column:
    """Whether any word occurs; one pattern, so ``text`` is evaluated once."""
    return text.rlike("|".join(re.escape(w) for w in words))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


# --- codes -----------------------------------------------------------------------------------------
def code_candidates(code: Column, brand: Column) -> Column:
    """Base-model names a code may stand for: its brand's families, else its 3 and 4 first letters."""
    code, brand = F.upper(F.trim(code)), F.upper(brand)
    families = F.array_compact(F.array(*[
        F.when((brand == b) & code.rlike(f"^({prefixes})"), F.lit(family))
        for b, prefixes, family in fixed.CODE_FAMILIES]))
    starts = F.when(F.length(code) >= 3, F.array_distinct(F.array(F.substring(code, 1, 3), F.substring(code, 1, 4))))
    return F.array_sort(F.when(F.size(families) > 0, families).otherwise(
        F.coalesce(starts, F.array().cast("array<string>"))))


def lookup_key(brand: Column, family: Column, year: Column) -> Column:
    return F.concat(brand, F.lit("_"), F.replace(family, F.lit(" "), F.lit("_")), F.lit("_"), year.cast("string"))


# --- normal forms ----------------------------------------------------------------------------------
def model_text(text: Column) -> Column:
    clean = squeeze(F.regexp_replace(F.coalesce(text, F.lit("")), "[®™©]", ""))
    for old, new in fixed.MODEL_SPELLINGS:
        clean = F.replace(clean, F.lit(old), F.lit(new))
    return F.upper(F.trim(clean))


def package_text(text: Column, strict: bool = False) -> Column:
    """Upper-cased package without filler words; ``strict`` keeps the words."""
    clean = F.coalesce(text, F.lit(""))
    if not strict:
        clean = F.regexp_replace(clean, fixed.PACKAGE_WORDS, "")
    return F.upper(squeeze(clean))


def engine_text(text: Column, strict: bool = False) -> Column:
    """``850 ETEC TURBO R`` form of an engine text; other texts are trimmed and upper-cased."""
    text = F.coalesce(text, F.lit(""))
    plain = F.upper(F.trim(text))
    if strict:
        return plain

    def part(i: int) -> Column:
        return F.regexp_extract(text, fixed.ENGINE_SHAPE, i)

    kind = F.upper(F.replace(part(3), F.lit("-"), F.lit("")))
    turbo = F.when(part(4) != "", F.concat(F.lit(" "), F.upper(F.trim(part(4))))).otherwise(F.lit(""))
    return F.when(part(1) != "", F.trim(F.concat(part(1), part(2), F.lit(" "), kind, turbo))).otherwise(plain)


def field_text(text: Column) -> Column:
    """Lower-cased text whose punctuation (but not hyphens) became spaces, letters of any script kept."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), r"(?U)[^\w\s-]", " ")


def engine_name(text: Column) -> Column:
    """Spelling-free engine name used to spot duplicates."""
    name = F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), "[®™℠©•�]", "")
    for shape, instead in fixed.ENGINE_WORDS:
        name = F.regexp_replace(name, shape, instead)
    name = F.regexp_replace(name, r"[^A-Z0-9\s]", "")
    return F.regexp_replace(squeeze(name), r"\s*(\d+)\s*", "$1")


def item_text(text: Column) -> Column:
    """Default normal form for list dedup."""
    return F.regexp_replace(F.regexp_replace(F.upper(F.trim(text)), r"[^A-Z0-9\s]", ""), r"\s+", " ")


# --- search texts ----------------------------------------------------------------------------------
def product_search_text(brand: Column, model: Column, package: Column, engine: Column, year: Column) -> Column:
    return F.trim(F.concat_ws(
        " ", or_null(brand), F.when(filled(model), model_text(model)),
        F.when(filled(package), package_text(package)), F.when(filled(engine), engine_text(engine)),
        F.when(year != 0, year.cast("string"))))


def catalog_search_text(family: Column, features: Column, engines: Column, brand: Column) -> Column:
    return F.trim(F.concat_ws(
        " ", F.when(filled(family), model_text(family)),
        F.when(F.size(features) > 0, F.array_join(F.slice(features, 1, 3), " ")),
        F.when(F.size(engines) > 0, engine_text(F.array_join(engines, " "))), or_null(brand)))


# --- headers ---------------------------------------------------------------------------------------
def header_field(text: Column, rules: Sequence[tuple[list[str], str]]) -> Column:
    """Field name of a header text: the first rule with a word in the text."""
    return F.coalesce(*[F.when(any_word(text, words), F.lit(field)) for words, field in rules])


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words])


# --- page text -------------------------------------------------------------------------------------
def page_lines(text: Column) -> Column:
    return F.split(text, "\n")


def code_lines(text: Column, code: Column) -> tuple[Column, Column]:
    """The first line that contains ``code`` and the line after it (null when there is none)."""
    def pair(lines: Column) -> Column:
        at = F.nullif(F.array_position(F.transform(lines, lambda line: line.contains(code)), F.lit(True)), F.lit(0))
        return F.array(F.get(lines, (at - 1).cast("int")), F.get(lines, at.cast("int")))

    found = let(page_lines(text), pair)
    return F.get(found, F.lit(0)), F.get(found, F.lit(1))


def line_fields(text: Column, code: Column) -> dict[str, Column]:
    """Price-list fields read from a code's line and the next one."""
    own, following = code_lines(text, code)
    both = F.concat(own, F.lit(" "), F.coalesce(following, F.lit("")))
    track = r"(\d+)in\s*(\d+)mm"
    inches, mm = F.regexp_extract(both, track, 1), F.regexp_extract(both, track, 2)
    fields = {name: first_word(both, words) for name, words in fixed.LINE_WORDS.items()}
    fields["vari"] = F.replace(fields["vari"], F.lit(" Color "), F.lit(" "))
    fields["telamatto"] = F.when(inches != "", F.concat(inches, F.lit("in/"), mm, F.lit("mm")))
    option = F.coalesce(*[F.when(F.lower(both).contains(w.lower()), F.lit(w.lower())) for w in fixed.OPTION_WORDS])
    fields["kevatoptiot"] = F.concat(F.lit("Contains "), option, F.lit(" modifications"))
    return fields


def page_fields(text: Column, code: Column) -> dict[str, Column]:
    """Model name, engine, displacement, display and color read from page text."""
    own, _ = code_lines(text, code)
    named = F.coalesce(*[F.when(own.contains(w), F.lit(name)) for w, name in fixed.PAGE_MODELS])
    return {
        "model_name": F.coalesce(named, F.concat(F.lit("Unknown Model ("), code, F.lit(")"))),
        "engine": first_word(text, [w for w, _ in fixed.PAGE_ENGINES]),
        "engine_cc": F.coalesce(*[F.when(text.contains(w), F.lit(cc)) for w, cc in fixed.PAGE_ENGINES]),
        "display": first_word(text, fixed.PAGE_DISPLAYS),
        "color": first_word(text, fixed.PAGE_COLORS),
        "track": track_config(text),
    }


def track_config(text: Column) -> Column:
    shape = r"(\d+)in.*?(\d+)mm.*?(\d+\.?\d*)in.*?(\d+)mm\s+([A-Za-z\s]+)"
    part = [F.regexp_extract(text, shape, i) for i in range(1, 6)]
    whole = F.concat(part[0], F.lit("in "), part[1], F.lit("mm "), part[2], F.lit("in "), part[3], F.lit("mm "),
                     F.trim(F.regexp_replace(part[4], r"^\s+|\s+$", "")))
    return F.when(part[0] != "", whole)


def track_parts(text: Column) -> dict[str, Column]:
    """Numbers and name of a track text such as ``154in 3900mm 3.0in 76mm Powdermax``."""
    shape = r"^(\d+)in (\d+)mm (\d+\.?\d*)in (\d+)mm (.+)$"
    kinds = [("length_in", 1, "int"), ("length_mm", 2, "int"), ("profile_in", 3, "double"),
             ("profile_mm", 4, "int"), ("track_name", 5, "string")]
    return {name: or_null(F.regexp_extract(text, shape, i)).cast(kind) for name, i, kind in kinds}


def squashed(text: Column) -> Column:
    """Capital letters and digits only, so spaced titles read as one word."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]+", "")


def _first_title(bare: Column) -> Column:
    return F.coalesce(*[
        F.when(bare.contains(title) if absent is None else bare.rlike(f"{title}(?!.*({absent}))"),
               F.struct(F.lit(model).alias("model"), F.lit(setup).alias("configuration"), F.lit(kind).alias("category")))
        for title, absent, model, setup, kind in fixed.PAGE_TITLES])


def page_title(text: Column) -> Column:
    """Struct of model, configuration and category from the page's first known title; null without one."""
    return let(squashed(text), _first_title)


def page_is_relevant(text: Column) -> Column:
    """An engine word and a model word; the text is named once, so a filter on a computed text does not multiply its code."""
    return let(text, lambda t: let(F.upper(t), lambda u: any_word(u, fixed.PAGE_ENGINE_WORDS))
               & let(squashed(t), lambda s: any_word(s, fixed.PAGE_MODEL_WORDS)))


def relevant_page_title(text: Column) -> Column:
    """The title of a relevant page, null for any other page; the text is upper-cased and squashed once for all rules."""
    def titled(bare: Column) -> Column:
        return F.when(any_word(bare, fixed.PAGE_MODEL_WORDS), _first_title(bare))

    return let(F.upper(text), lambda u: F.when(any_word(u, fixed.PAGE_ENGINE_WORDS), let(squashed(u), titled)))


def has_table_signs(text: Column) -> Column:
    return any_word(text, fixed.TABLE_SIGNS)


# --- file names ------------------------------------------------------------------------------------
def file_brand(name: Column) -> Column:
    """Brand from a price-list file name; null when it names none."""
    upper = F.upper(name)
    return (F.when(upper.startswith("LYNX"), "LYNX")
            .when(upper.contains("SKI-DOO") | upper.contains("SKIDOO"), "SKI-DOO"))


def file_year(name: Column) -> Column:
    short, full, other = (F.regexp_extract(name, p, 1) for p in (r"MY(\d{2})", r"_?(20\d{2})", r"(\d{4})"))
    return F.when(short != "", F.concat(F.lit("20"), short)).when(full != "", full).when(
        other != "", other).otherwise(F.lit("2024"))


def page_kind(name: Column) -> dict[str, Column]:
    """Document type, brand and year of a page's file name."""
    year = F.regexp_extract(name, r"20\d{2}", 0)
    return {
        "doc_type": F.when(name.contains("SPEC BOOK"), "spec_book").otherwise("price_list"),
        "brand": F.when(name.contains("LYNX"), "LYNX").otherwise("SKIDOO"),
        "year": F.coalesce(or_null(year), F.lit("unknown")),
    }


# --- other -----------------------------------------------------------------------------------------
def token_estimate(text: Column, extra: int = 0) -> Column:
    return F.floor(F.length(text) / 4) + extra


def validation_hints(text: Column) -> Column:
    lower = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(lower.rlike(shape), F.lit(hint)) for hint, shape in fixed.HINT_SHAPES]))


def brand_from_signs(code: Column, family: Column, engine: Column, file_name: Column) -> Column:
    """Brand by code, then family, then file name, then engine."""
    tests = [F.when(code.isin(*s["codes"]), F.lit(b)) for b, s in fixed.BRAND_SIGNS.items()]
    tests += [F.when(family.isin(*s["families"]), F.lit(b)) for b, s in fixed.BRAND_SIGNS.items()]
    tests += [F.when(F.upper(file_name).startswith(b.upper()), F.lit(b)) for b in fixed.BRAND_SIGNS]
    tests += [F.when(engine.isin(*s["engines"]), F.lit(b)) for b, s in fixed.BRAND_SIGNS.items()]
    return F.coalesce(*tests)


def standard_entry(code: Column, text: Column, starter: Column, display: Column, price: Column,
                   market: Column) -> dict[str, Column]:
    """Cleaned entry fields: code, text, starter, display kind and currency."""
    start, show = F.upper(F.trim(starter)), F.lower(F.trim(display))
    return {
        "model_code": F.upper(F.trim(F.coalesce(code, F.lit("")))),
        "clean_text": F.coalesce(squeeze(text), F.lit("")),
        "starter": F.when(start.contains("SHOT"), "SHOT").when(start.contains("ELECTRIC"), "ELECTRIC")
        .when(start.contains("MANUAL"), "MANUAL"),
        "display": F.when(show.contains("touchscreen"), "touchscreen").when(show.contains("digital"), "digital"),
        "currency": F.when(price.contains("€") | price.contains("EUR"), "EUR")
        .when(price.contains("₽") | price.contains("RUB"), "RUB")
        .when(F.upper(market) == "RUSSIA", "RUB").otherwise("EUR"),
    }


# --- document quality ------------------------------------------------------------------------------
def document_quality(pages, doc: str, page: str, text: str, images: str, first: int = 3):
    """Quality level, confidence and parser choice per document from its first pages.

    ``pages`` has one row per page, numbered from 0; totals are conditional sums, so nothing is
    gathered per document.
    """
    early = F.col(page) < first
    shaped = pages.groupBy(doc).agg(
        F.count("*").alias("page_count"), F.sum(F.when(early, F.length(text)).otherwise(0)).alias("_chars"),
        F.coalesce(F.max(F.when(early, has_table_signs(F.col(text)))), F.lit(False)).alias("has_table_structure"),
        F.sum(F.when(early, F.col(images)).otherwise(0)).alias("_images"))
    checked = F.least(F.lit(first), F.col("page_count"))
    selectable = F.col("_chars") > 100
    tables, density = F.col("has_table_structure"), F.bround(F.col("_images") / checked, 2)
    high = selectable & tables & (F.col("_chars") / checked > 1000)
    medium = selectable & tables & (density < 0.6)
    level = (F.when(high, "digital_high").when(medium, "digital_medium").when(selectable, "scanned_good").otherwise("scanned_poor"))
    shaped = shaped.withColumns({"has_selectable_text": selectable, "image_density": density, "quality_level": level})
    kind = F.col("quality_level")
    digital = kind.isin("digital_high", "digital_medium")
    return shaped.withColumns({
        "confidence": F.when(kind == "digital_high", 0.95).when(kind == "digital_medium", 0.85).when(kind == "scanned_good", 0.75).otherwise(0.6),
        "parser": F.when(digital, "pymupdf").when(kind == "scanned_good", "camelot").otherwise("ocr"),
        "fallbacks": F.when(digital, "camelot|ocr").when(kind == "scanned_good", "ocr").otherwise(""),
        "threshold": F.when(digital, 0.85).when(kind == "scanned_good", 0.75).otherwise(0.7),
    }).drop("_chars", "_images")
