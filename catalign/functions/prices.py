"""Price parsing, conversion and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.functions.text import code_lines, filled, or_null


def number(text: Column) -> Column:
    return text.try_cast("double")


def price_digits(text: Column) -> Column:
    """Digits, commas and dots only, comma as decimal point; 0 when that is no number."""
    kept = F.replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\d,.]", ""), F.lit(","), F.lit("."))
    return F.coalesce(number(kept), F.lit(0.0))


def price_number(text: Column, locale: str | None = None) -> Column:
    """First number of a price text without currency signs and spaces; null when there is none.

    ``locale='fi'`` drops dots between thousands when a decimal comma is present.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "€|EUR", ""), r"[\s\x{a0}]", "")
    if locale == "fi":
        bare = F.when(bare.contains(","), F.replace(bare, F.lit("."), F.lit(""))).otherwise(bare)
    return number(F.replace(F.regexp_extract(bare, r"[\d.,]+", 0), F.lit(","), F.lit(".")))


def euro_amount(line: Column) -> Column:
    """Amount before the euro sign of a line, accepted above 15000 only."""
    found = F.regexp_extract(line, fixed.EURO_PRICE, 1)
    text = F.replace(F.regexp_replace(found, r"\x{a0}", ""), F.lit(","), F.lit("."))
    tail = F.substring(text, -3, 3)
    cut = F.concat(F.left(text, F.length(text) - 2), F.lit("."), F.right(text, F.lit(2)))
    text = F.when(~tail.contains(".") & (F.length(text) > 3), cut).otherwise(text)
    value = number(text)
    return F.when(value > 15000, value)


def price_near_code(text: Column, code: Column) -> Column:
    """Euro price on the code's line, else on the next line, else 0."""
    own, following = code_lines(text, code)
    return F.coalesce(euro_amount(own), euro_amount(following), F.lit(0.0))


def listing_price(price: Column, currency: Column) -> Column:
    """Whole roubles, half-even; null for missing or non-positive prices."""
    roubles = F.when(currency == "EUR", price * 100).otherwise(price)
    return F.when(price > 0, F.bround(roubles, 0).cast("long"))


def display_price(price: Column, currency: Column) -> Column:
    present = F.coalesce(price, F.lit(0.0)) != 0
    return (F.when(present & (currency == "EUR"), F.concat(F.format_number(price, 2), F.lit("€")))
            .when(present & (currency == "RUB"), F.concat(F.format_number(price, 0), F.lit("₽")))
            .otherwise("Price not available"))


def market_price(amount: Column, currency: Column) -> Column:
    """Price text by currency for product pages."""
    return (F.when(currency == "EUR", F.concat(F.lit("€"), F.format_number(amount, 2)))
            .otherwise(F.concat(F.format_number(amount, 2), F.lit(" "), currency)))


def mm_to_inches(mm: Column) -> Column:
    return mm / 25.4


def inches_to_mm(inches: Column) -> Column:
    return inches * 25.4


def full_name(brand: Column, model: Column, package: Column) -> Column:
    return F.concat_ws(" ", brand, or_null(model), or_null(package))


def listing_title(code: Column, brand: Column, model: Column, year: Column, package: Column) -> Column:
    title = F.concat_ws(" ", or_null(brand), or_null(model), F.when(year != 0, year.cast("string")), or_null(package))
    return F.when(title != "", title).otherwise(F.concat(F.lit("Product "), code))


def listing_description(code: Column, fields: dict[str, Column], features: Column | None = None) -> Column:
    """One line per present field, then at most five catalog features."""
    lines = [F.concat(F.lit("Model Code: "), code)]
    lines += [F.when(filled(c), F.concat(F.lit(f"{label}: "), c)) for label, c in fields.items()]
    text = F.concat_ws("\n", *lines)
    if features is None:
        return text
    bullets = F.array_join(F.transform(F.slice(features, 1, 5), lambda f: F.concat(F.lit("• "), f)), "\n")
    return F.when(F.size(features) > 0, F.concat(text, F.lit("\n\nFeatures:\n"), bullets)).otherwise(text)


def usage_cost(input_tokens: Column, output_tokens: Column) -> Column:
    """Cost of a request, exact decimal."""
    def share(tokens: Column, price: str) -> Column:
        return tokens.cast("decimal(18,0)") * F.lit(price).cast("decimal(4,2)")

    total = share(input_tokens, fixed.INPUT_COST_PER_MILLION) + share(output_tokens, fixed.OUTPUT_COST_PER_MILLION)
    return (total / F.lit("1000000").cast("decimal(7,0)")).cast("decimal(18,8)")
