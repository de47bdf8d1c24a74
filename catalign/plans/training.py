"""Instruction rows from page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions.text import page_kind
from catalign.sources.pages import clean_pages

# fixed texts of the instruction rows
SPEC_OUTPUT = ("I need to identify model names, engine specifications, track dimensions, and key features from this "
               "specification text.")
LIST_INSTRUCTION = "List all technical specifications with their values:"
LIST_OUTPUT = ("I'll extract engine displacement, horsepower, track width, track length, suspension travel, and other technical "
               "specifications.")
PRICE_OUTPUT = "I'll identify model codes, full model names, and their corresponding prices in the specified currency."


def split_name(key: Column, buckets: int = 100) -> Column:
    """Stable 80/10/10 split by a key's bucket."""
    bucket = F.pmod(key, F.lit(buckets))
    return F.when(bucket < 80, "train").when(bucket < 90, "validation").otherwise("test")


def messages(instruction: Column, page: Column, answer: Column) -> Column:
    def said(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(said("user", F.concat(instruction, F.lit("\n\n"), page)), said("assistant", answer))


def instruction_rows(pages: DataFrame, file: str = "file", page: str = "text") -> DataFrame:
    """Two rows per specification page and one per price page, as messages."""
    kind = page_kind(F.col(file))
    rows = clean_pages(pages, page).withColumns({"doc_type": kind["doc_type"], "brand": kind["brand"], "year": kind["year"]})
    place = F.concat_ws(" ", "brand", "year")
    body = F.col(page)
    spec = F.array(
        messages(F.concat(F.lit("Extract all snowmobile model information from this "), place, F.lit(" specification page:")), body,
                 F.lit(SPEC_OUTPUT)),
        messages(F.lit(LIST_INSTRUCTION), body, F.lit(LIST_OUTPUT)))
    price = F.array(messages(F.concat(F.lit("Extract all model names and prices from this "), place, F.lit(" price list:")), body,
                             F.lit(PRICE_OUTPUT)))
    made = F.when(F.col("doc_type") == "spec_book", spec).otherwise(price)
    return rows.select("*", F.posexplode(made).alias("example_no", "messages"))
