"""Row rules that yield errors, warnings and suggestions as arrays."""

from __future__ import annotations

from collections.abc import Sequence
from contextvars import ContextVar
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.functions.maps import sql_text
from catalign.functions.text import any_word, filled

TEXTS = "array<string>"


class Rule(NamedTuple):
    """A registered rule: when ``condition`` holds, ``message`` is added at ``severity``."""

    name: str
    condition: Column
    message: Column
    severity: str = "error"


def error(name: str, condition: Column, message: Column | str) -> Rule:
    return Rule(name, condition, F.lit(message) if isinstance(message, str) else message)


def warning(name: str, condition: Column, message: Column | str) -> Rule:
    return error(name, condition, message)._replace(severity="warning")


def suggestion(name: str, condition: Column, message: Column | str) -> Rule:
    return error(name, condition, message)._replace(severity="suggestion")


def messages(rules: Sequence[Rule], severity: str) -> Column:
    arms = [F.when(r.condition, r.message) for r in rules if r.severity == severity]
    return F.array_compact(F.array(*arms)).cast(TEXTS) if arms else F.array().cast(TEXTS)


def apply_rules(df: DataFrame, rules: Sequence[Rule], success: str = "success") -> DataFrame:
    """Add ``errors``, ``warnings``, ``suggestions`` and ``success`` (no errors)."""
    out = df.withColumns({f"{s}s": messages(rules, s) for s in ("error", "warning", "suggestion")})
    return out.withColumn(success, F.size("errors") == 0)


def text_of(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


# --- required fields and general rules -------------------------------------------------------------
def required_rules(code: Column, brand: Column, year: Column, price: Column) -> list[Rule]:
    low, high = fixed.YEAR_RANGE
    no_year = year.isNull() | (year < low) | (year > high)
    return [
        error("code", F.coalesce(F.length(code), F.lit(0)) != 4, "model_code must be exactly 4 characters"),
        error("brand", ~filled(F.trim(brand)), "brand cannot be empty"),
        error("year", no_year, F.concat(F.lit("year must be between 2015-2030, got: "), text_of(year))),
        error("price", price <= 0, "price must be greater than 0"),
        error("price_limit", price > fixed.MAX_PRICE, F.concat(F.lit("price seems unrealistic: "), text_of(price))),
    ]


def general_rules(brand: Column, model: Column) -> list[Rule]:
    return [
        warning("brand", filled(brand) & ~F.upper(brand).isin(*fixed.KNOWN_BRANDS),
                F.concat(F.lit("Unknown brand: "), brand)),
        warning("model", filled(model) & (F.length(model) < 2),
                F.concat(F.lit("Model name seems too short: "), model)),
    ]


def consistency_rules(brand: Column, model: Column, engine: Column, engines: Column) -> list[Rule]:
    b, m = F.upper(brand), F.lower(model)
    return [
        error("lynx", (b == "LYNX") & m.contains("ski-doo"), "Brand/model mismatch: LYNX brand with SKI-DOO model"),
        error("skidoo", (b == "SKI-DOO") & m.contains("lynx"), "Brand/model mismatch: SKI-DOO brand with LYNX model"),
        warning("engine", filled(engine) & (F.size(engines) > 0) & ~F.array_contains(engines, engine),
                F.concat(F.lit("Engine '"), engine, F.lit("' not found in catalog"))),
    ]


def whitelist_layer(matched: DataFrame) -> DataFrame:
    """Messages for the outcome of a whitelist match."""
    kind, named = F.col("match_type"), F.col("model_text")
    rules = [
        error("model", named.isNull(), "Model name (malli) is required for validation"),
        warning("pattern", kind == "pattern", F.concat(F.lit("Model matched by pattern: "), F.col("pattern"))),
        warning("fuzzy", kind == "fuzzy", F.concat(
            F.lit("Close model match found: "), F.col("suggestion"), F.lit(" (confidence: "),
            F.format_string("%.2f", F.col("score")), F.lit(")"))),
        error("none", kind == "none", F.concat(F.lit("Model not found in BRP catalog: "), named)),
        suggestion("none", (kind == "none") & F.col("suggestion").isNotNull(),
                   F.concat(F.lit("Did you mean: "), F.col("suggestion"), F.lit("?"))),
    ]
    return apply_rules(matched, rules)


# --- field rules -----------------------------------------------------------------------------------
def field_rules(code: Column, brand: Column, year: Column, price: Column, currency: Column,
                price_basis: str = "reference") -> list[Rule]:
    """Price, code, brand and year rules; ``price_basis='rub'`` converts euro prices before the limits."""
    amount = F.when(currency == "EUR", price * 100).otherwise(price) if price_basis == "rub" else price
    low, high = fixed.YEAR_RANGE
    return [
        error("price_low", amount < fixed.MIN_PRICE, F.concat(
            F.lit("Price too low: "), text_of(price), F.lit(f" (minimum: {fixed.MIN_PRICE})"))),
        error("price_high", amount > fixed.MAX_PRICE, F.concat(
            F.lit("Price too high: "), text_of(price), F.lit(f" (maximum: {fixed.MAX_PRICE})"))),
        error("currency", price.isNotNull() & ~F.coalesce(currency, F.lit("")).isin(*fixed.CURRENCIES),
              F.concat(F.lit("Invalid currency: "), text_of(currency), F.lit(" (allowed: EUR, RUB)"))),
        warning("decimals", (currency == "RUB") & (price % 1 != 0), "RUB prices should not have decimal places"),
        error("code", filled(code) & ~code.rlike(fixed.CODE_SHAPE),
              f"model_code does not match required pattern: {fixed.CODE_SHAPE}"),
        error("brand", filled(brand) & ~brand.isin(*fixed.KNOWN_BRANDS),
              "brand not in allowed values: " + str(fixed.KNOWN_BRANDS)),
        error("year_low", (year != 0) & (year < low), F.concat(
            F.lit("year too low: "), text_of(year), F.lit(f" (minimum: {low})"))),
        error("year_high", year > high, F.concat(
            F.lit("year too high: "), text_of(year), F.lit(f" (maximum: {high})"))),
    ]


def text_rules(name: str, value: Column, limits: dict) -> list[Rule]:
    """Optional length and word rules of a title or description."""
    found = [
        error("short", F.length(value) < limits["min"], F.concat(
            F.lit(f"{name} too short: "), F.length(value).cast("string"),
            F.lit(f" characters (minimum: {limits['min']})"))),
        error("long", F.length(value) > limits["max"], F.concat(
            F.lit(f"{name} too long: "), F.length(value).cast("string"),
            F.lit(f" characters (maximum: {limits['max']})"))),
    ]
    found += [error("required", ~F.upper(value).contains(w.upper()), f"{name} must contain: {w}")
              for w in limits.get("required", [])]
    found += [error("forbidden", F.upper(value).contains(w.upper()), f"{name} contains forbidden word: {w}")
              for w in limits.get("forbidden", [])]
    return found


def business_rules(brand: Column, model: Column, engine: Column, currency: Column, market: Column,
                   fields: dict[str, Column], strict: bool = False) -> list[Rule]:
    """Brand-family, engine-family and market rules; ``strict`` leaves the engine rule out."""
    upper = F.upper(model)
    known = F.lit(False)
    for name, families in fixed.BRAND_FAMILIES.items():
        known = known | ((brand == name) & any_word(upper, families))
    found = [warning("family", filled(brand) & filled(model) & ~known, F.concat(
        F.lit("Unusual brand-model combination: "), brand, F.lit(" "), model))]
    if not strict:
        size = F.regexp_extract(engine, r"(\d{3})", 1)
        message = F.coalesce(*[
            F.when(upper.contains(family), F.when(~size.isin(*sizes), F.concat(
                F.lit("Unusual engine-model combination: "), size,
                F.lit(f" in {family} (typical: {sizes})"))).otherwise(F.lit("")))
            for family, sizes in fixed.ENGINE_FAMILIES])
        found.append(warning("engine", filled(engine) & filled(model) & (size != "") & filled(message), message))
    place = F.upper(market)
    for name, expected in fixed.MARKET_CURRENCY.items():
        found.append(warning("currency", (place == name) & ~F.coalesce(currency == expected, F.lit(False)), F.concat(
            F.lit(f"Currency mismatch for {name}: expected {expected}, got "), text_of(currency))))
        for field in fixed.MARKET_FIELDS.get(name, []):
            found.append(warning(field, (place == name) & ~filled(fields[field]),
                                 f"Missing recommended spec for {name}: {field}"))
    return found


def layered(df: DataFrame, layers: Sequence[tuple[Sequence[Rule], bool]], strict: bool = True,
            model_errors: str | None = None, model_warnings: str | None = None) -> DataFrame:
    """Concatenate rule layers; a layer marked lenient fails a row only in strict mode.

    ``layers`` holds (rules, always decisive); errors of a whitelist match may come as columns.
    """
    parts = [(messages(r, "error"), messages(r, "warning"), always) for r, always in layers]
    if model_errors:
        parts.insert(1, (F.col(model_errors), F.col(model_warnings), False))
    failing = [F.size(e) > 0 for e, _, always in parts if always or strict]
    out = df.withColumns({"errors": F.concat(*[e for e, _, _ in parts]), "warnings": F.concat(*[w for _, w, _ in parts]),
                          "success": ~reduce(lambda a, b: a | b, failing)})
    penalty = F.lit(1.0) - F.size("warnings") * 0.1
    return out.withColumn("confidence", F.when(F.size("errors") > 0, 0.0).otherwise(F.greatest(F.lit(0.0), penalty)))


# --- listings --------------------------------------------------------------------------------------
def listing_required(df: DataFrame, fields: Sequence[str], price: str = "price", images: str = "images") -> DataFrame:
    """Required listing fields, price range and at least one image."""
    def missing(field: str) -> Column:
        kind = df.schema[field].dataType.typeName()
        if kind == "array":
            return F.coalesce(F.size(field), F.lit(0)) <= 0
        if kind == "string":
            return ~filled(F.col(field))
        return F.coalesce(F.col(field), F.lit(0)) == 0

    rules = [error(f, missing(f), f"Required field '{f}' is missing or empty") for f in fields]
    amount = F.col(price)
    rules.append(error("range", (amount != 0) & ((amount < fixed.MIN_PRICE) | (amount > fixed.MAX_PRICE)), F.concat(
        F.lit("Price "), amount.cast("string"), F.lit(" is outside valid range (100,000 - 10,000,000 RUB)"))))
    rules.append(error("images", missing(images), "At least one image URL is required"))
    return apply_rules(df, rules)


def _number_field(value: Column, text: str, fix: str | None, low: int, high: int, below: str, above: str) -> Column:
    # digits that no long can hold are above every limit
    number = F.coalesce(F.ltrim(value, F.lit("0")).try_cast("long"), F.when(F.ltrim(value, F.lit("0")) == "", F.lit(0)), F.lit(2**63 - 1))
    return (F.when(~value.rlike(r"^\d+$"), _fail(text, fix)).when(number < low, _fail(below))
            .when(number > high, _fail(above)).otherwise(_pass()))


# outcomes of a listing check as numbers, for totals that need no texts
PASSED, CAUTION, FAILED = 0, 1, 2
_as_codes: ContextVar[bool] = ContextVar("as_codes", default=False)


def _constant(valid: bool, message: str | None, caution: str | None, fix: str | None) -> Column:
    if _as_codes.get():
        return F.lit(FAILED if not valid else PASSED if caution is None else CAUTION)
    return F.expr(f"named_struct('valid', {str(valid).lower()}, 'error', {sql_text(message)}, 'warning', {sql_text(caution)}, "
                  f"'fix', {sql_text(fix)})")


def _fail(message: Column | str, fix: Column | str | None = None) -> Column:
    if isinstance(message, str) or _as_codes.get():
        return _constant(False, message if isinstance(message, str) else "", None, fix if isinstance(fix, str) else None)
    return F.struct(F.lit(False).alias("valid"), message.alias("error"), F.lit(None).cast("string").alias("warning"),
                    (fix if isinstance(fix, Column) else F.lit(fix)).cast("string").alias("fix"))


def _pass(caution: str | None = None) -> Column:
    return _constant(True, None, caution, None)


def _optional(clean: Column, note: str, rest: Column) -> Column:
    return F.when(clean == "", _pass(note)).otherwise(rest)


def _bounded(clean: Column, label: str, low: int, high: int, rest: Column) -> Column:
    size = F.length(clean)
    return (F.when(clean == "", _fail(f"{label} is required"))
            .when(size < low, _fail(f"{label} must be at least {low} characters long"))
            .when(size > high, _fail(f"{label} must be no more than {high} characters long")).otherwise(rest))


def _check_id(value: Column, clean: Column) -> Column:
    return (F.when(clean == "", _fail("Id is required and cannot be empty"))
            .when(F.length(clean) < 3, _fail("Id must be at least 3 characters long"))
            .when(F.length(clean) > 50, _fail("Id must be no more than 50 characters long"))
            .when(~clean.rlike("^[a-zA-Z0-9_-]+$"),
                  _fail("Id should only contain letters, numbers, hyphens, and underscores",
                        "Use format like: ARTICLE-CODE-123 or MODEL_YEAR_2025")).otherwise(_pass()))


def _check_title(value: Column, clean: Column) -> Column:
    return _bounded(clean, "Title", 10, 100, F.when(any_word(F.lower(clean), fixed.LISTING_TERMS), _pass()).otherwise(
        _pass("Title should contain snowmobile-related terms for better visibility")))


def _check_price(value: Column, clean: Column) -> Column:
    return F.when(clean == "", _fail("Price is required")).otherwise(_number_field(
        clean, "Price must contain only numbers (no currency symbols, commas, or spaces)",
        "Use format: 2500000 (not 2,500,000 руб)", 100000, 5000000,
        "Price seems too low for a snowmobile (minimum 100,000 rubles)",
        "Price seems too high for a snowmobile (maximum 5,000,000 rubles)"))


def _check_images(value: Column, clean: Column) -> Column:
    return (F.when(clean == "", _fail("At least one image is required"))
            .when(~(value.startswith("http://") | value.startswith("https://")), _fail("Image must be a valid HTTP/HTTPS URL"))
            .when(any_word(F.lower(value), fixed.IMAGE_ENDINGS), _pass())
            .otherwise(_pass("Image URL should end with .jpg, .png, or .webp")))


def _number_check(note: str, text: str, fix: str | None, low: int, high: int, below: str, above: str):
    return lambda value, clean: _optional(clean, note, _number_field(clean, text, fix, low, high, below, above))


def _choice_check(label: str, note: str, allowed: Sequence[str]):
    return lambda value, clean: _optional(clean, note, F.when(value.isin(*allowed), _pass()).otherwise(
        _fail(f"{label} must be one of: " + ", ".join(allowed))))


def _exact_check(label: str, expected: str, tail: str):
    return lambda value, clean: F.when(F.coalesce(value, F.lit("")) == expected, _pass()).otherwise(
        _fail(f"{label} must be '{expected}'{tail}"))


def _date_check(note: str, day: str):
    return lambda value, clean: _optional(clean, note, F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), _pass()).otherwise(
        _fail("Date must be in YYYY-MM-DD format", f"Use format: {day}")))


# field -> check of (value, trimmed value); Model and Year need more and are added by check_listings
LISTING_CHECKS = {
    "Id": _check_id,
    "Title": _check_title,
    "Price": _check_price,
    "Power": _number_check(
        "Power is recommended for better visibility", "Power must be a number (HP only, no units)", "Use format: 165 (not 165 hp)",
        10, 300, "Power seems too low for a snowmobile (minimum 10 HP)", "Power seems too high for a snowmobile (maximum 300 HP)"),
    "EngineCapacity": _number_check(
        "Engine capacity is recommended", "Engine capacity must be a number (CC only, no units)", "Use format: 849 (not 849cc)",
        200, 2000, "Engine capacity seems too low (minimum 200 CC)", "Engine capacity seems too high (maximum 2000 CC)"),
    "PersonCapacity": _number_check(
        "Person capacity is recommended", "Person capacity must be a number", None, 1, 3,
        "Person capacity must be 1, 2, or 3", "Person capacity must be 1, 2, or 3"),
    "TrackWidth": _number_check(
        "Track width is recommended", "Track width must be a number (mm only, no units)", None, 300, 600,
        "Track width must be between 300-600mm", "Track width must be between 300-600mm"),
    "Description": lambda value, clean: _bounded(clean, "Description", 50, 5000, _pass()),
    "Images": _check_images,
    "Type": _choice_check("Type", "Type is recommended for better categorization", fixed.LISTING_TYPES),
    "Availability": _choice_check("Availability", "Availability is recommended", fixed.LISTING_STOCK),
    "DateBegin": _date_check("Date begin is optional", "2025-01-01"),
    "DateEnd": _date_check("Date end is optional", "2025-12-31"),
    **{name: _exact_check(name, expected, fixed.LISTING_EXACT_TAIL.get(name, "")) for name, expected in fixed.LISTING_EXACT.items()},
}


def _check_model(listed: Column, similar: Column):
    return lambda value, clean: F.when(clean == "", _fail("Model is required")).when(listed, _pass()).otherwise(_fail(
        F.concat(F.lit("Model '"), clean, F.lit("' not found in official BRP list")),
        F.when(similar.isNotNull(), F.concat(F.lit("Did you mean: "), similar, F.lit("?"))).otherwise(
            F.lit("Check official BRP model list for exact spelling"))))


def _check_year(this_year: int):
    def check(value: Column, clean: Column) -> Column:
        year = clean.try_cast("int")
        got = F.concat(F.lit(" (got "), year.cast("string"), F.lit(")"))
        return (F.when(clean == "", _fail("Year is required"))
                .when(~clean.rlike(r"^\d{4}$"), _fail("Year must be a 4-digit number", "Use format: 2025"))
                .when(year < 2000, _fail(F.concat(F.lit("Year must be 2000 or later"), got)))
                .when(year > this_year + 2, _fail(F.concat(F.lit("Year cannot be more than 2 years in the future"), got)))
                .otherwise(_pass()))
    return check


def _trimmed(name: str) -> Column:
    return F.btrim(F.coalesce(F.col(name), F.lit("")), F.lit(" \t\n\x0b\f\r"))


def _listing_checks(this_year: int, begin: str, end: str) -> dict:
    return {**LISTING_CHECKS, begin: LISTING_CHECKS["DateBegin"], end: LISTING_CHECKS["DateEnd"],
            "Model": _check_model(F.coalesce("listed", F.lit(False)), F.col("similar")), "Year": _check_year(this_year)}


def check_listings(listings: DataFrame, fields: Sequence[str], this_year: int, begin: str = "DateBegin", end: str = "DateEnd") -> DataFrame:
    """Add ``checks``: one outcome struct per listing field, read straight from the field's column.

    ``listings`` is wide and carries ``listed`` and ``similar`` of its model; fields without a rule
    pass through unjudged. ``begin`` and ``end`` name the date fields as the feed spells them. Nothing is shuffled.
    Trimmed values are columns of an earlier projection, so each is computed once, and no lambda keeps the checks from generated code.
    """
    known = _listing_checks(this_year, begin, end)

    judged = [name for name in fields if name in known]
    trimmed = listings.withColumns({f"_clean_{name}": _trimmed(name) for name in judged})
    checks = [F.struct(F.lit(name).alias("field"), F.col(name).alias("value"), known[name](F.col(name), F.col(f"_clean_{name}")).alias("outcome"))
              for name in judged]
    return trimmed.withColumn("checks", F.array(*checks)).drop(*[f"_clean_{name}" for name in judged])


def check_rows(checked: DataFrame, key: str = "listing_id") -> DataFrame:
    """Long form: one row per listing and field.

    For a plain ``inline`` Spark infers the filter ``size(checks) > 0`` and pushes it below the trimmed values, with every check and every use
    of a value written out: more than a small driver can optimise, and each check is done twice.
    """
    rows = checked.select(key, F.inline_outer("checks")).filter(F.col("field").isNotNull())
    return rows.select(key, "field", "value", "outcome.*")


def listing_summary(checked: DataFrame) -> DataFrame:
    """Passed and total checks per listing with a summary line, from its own array."""
    def number(keep) -> Column:
        return F.size(F.filter("checks", keep)).cast("long")

    return _summary(checked.withColumns({
        "total_checks": F.size("checks").cast("long"), "passed_checks": number(lambda c: c["outcome"]["valid"]),
        "n_errors": number(lambda c: ~c["outcome"]["valid"]),
        "n_warnings": number(lambda c: c["outcome"]["valid"] & c["outcome"]["warning"].isNotNull())}))


def listing_totals(listings: DataFrame, fields: Sequence[str], this_year: int, begin: str = "DateBegin", end: str = "DateEnd") -> DataFrame:
    """The summary of ``check_listings`` straight from the fields: every check is one number, no message is built.

    Trimmed values are columns of an earlier projection, so each is computed once.
    """
    known = _listing_checks(this_year, begin, end)
    judged = [name for name in fields if name in known]
    trimmed = listings.withColumns({f"_clean_{name}": _trimmed(name) for name in judged})
    token = _as_codes.set(True)
    try:
        codes = {f"_code_{name}": known[name](F.col(name), F.col(f"_clean_{name}")) for name in judged}
    finally:
        _as_codes.reset(token)
    coded = trimmed.withColumns(codes).drop(*[f"_clean_{name}" for name in judged])

    def number(code: int) -> Column:
        return reduce(lambda a, b: a + b, [(F.col(c) == code).cast("long") for c in codes], F.lit(0).cast("long"))

    return _summary(coded.withColumns({
        "total_checks": F.lit(len(judged)).cast("long"), "n_errors": number(FAILED), "n_warnings": number(CAUTION)}).withColumn(
        "passed_checks", F.col("total_checks") - F.col("n_errors")).drop(*codes))


def _summary(totals: DataFrame) -> DataFrame:
    noted = F.when(F.col("n_warnings") > 0, F.concat(F.lit(" ("), F.col("n_warnings").cast("string"),
                                                     F.lit(" warnings)"))).otherwise(F.lit(""))
    good = F.concat(F.lit("VALIDATION PASSED: "), F.col("passed_checks").cast("string"), F.lit("/"),
                    F.col("total_checks").cast("string"), F.lit(" checks passed"), noted)
    poor = F.concat(F.lit("VALIDATION FAILED: "), F.col("n_errors").cast("string"), F.lit(" errors, "),
                    F.col("n_warnings").cast("string"), F.lit(" warnings"))
    valid = F.col("n_errors") == 0
    return totals.withColumn("is_valid", valid).withColumn("summary", F.when(valid, good).otherwise(poor))


# --- generic checks --------------------------------------------------------------------------------
def required_fields(data: Column, fields: Sequence[str]) -> Column:
    """Messages for map keys that are missing, null or blank."""
    return F.array_compact(F.array(*[
        F.when(~F.map_contains_key(data, F.lit(f)), F.lit(f"Required field '{f}' is missing"))
        .when(F.try_element_at(data, F.lit(f)).isNull(), F.lit(f"Required field '{f}' is None"))
        .when(F.trim(F.try_element_at(data, F.lit(f))) == "", F.lit(f"Required field '{f}' is empty"))
        for f in fields]))


def share_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Share of pairs that are equal (two nulls count as equal)."""
    return reduce(lambda a, b: a + b, [left.eqNullSafe(right).cast("double") for left, right in pairs]) / len(pairs)


def fabricated(value: Column) -> Column:
    return any_word(F.lower(value), fixed.FABRICATED_WORDS)


def expected_difference(rows: DataFrame, fields: Sequence[str], price: str) -> DataFrame:
    """Compare with ``expected_*`` columns; prices may differ by 10 silently and by 100 with a warning."""
    want, got = F.col(f"expected_{price}"), F.col(price)
    gap = F.abs(want - got)
    rules = [error(f, F.col(f"expected_{f}").isNotNull() & F.col(f).isNotNull() & (F.col(f) != F.col(f"expected_{f}")),
                   F.concat(F.lit(f"{f}: expected '"), F.col(f"expected_{f}"), F.lit("', got '"), F.col(f), F.lit("'")))
             for f in fields]
    rules.append(error(price, gap > 100, F.concat(
        F.lit(f"{price}: expected ~"), text_of(want), F.lit(", got "), text_of(got), F.lit(" (diff: "), text_of(gap),
        F.lit(")"))))
    rules.append(warning(price, (gap > 10) & (gap <= 100), F.concat(
        F.lit(f"{price}: small difference - expected "), text_of(want), F.lit(", got "), text_of(got))))
    return apply_rules(rows, rules, "valid")
