"""Price-list cells to a marketplace feed, extraction runs, and the documented five-step variant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import bands, prices, text
from catalign.operators import assemble, joins, matching, rules
from catalign.sources import sinks


def products_from_cells(cells: DataFrame, brand: Column, year: Column, market: str = "FINLAND") -> DataFrame:
    """Products of price-list tables: records, then continuation rows folded in."""
    records = assemble.raw_records(cells).withColumn("price_value", F.col("price_value"))
    merged = assemble.merge_continuations(records, keep=["price_value"])
    return merged.withColumns({"brand": brand, "model_year": year, "currency": F.lit("EUR"), "market": F.lit(market),
                               "price": F.col("price_value")})


def with_search_text(products: DataFrame) -> DataFrame:
    c = F.col
    return products.withColumn("search_text", text.product_search_text(c("brand"), c("malli"), c("paketti"), c("moottori"), c("model_year")))


def validate_products(products: DataFrame, price_basis: str = "reference", strict: bool = True) -> DataFrame:
    c = F.col
    return rules.layered(products, [
        (rules.required_rules(c("model_code"), c("brand"), c("model_year"), c("price")), True),
        (rules.field_rules(c("model_code"), c("brand"), c("model_year"), c("price"), c("currency"), price_basis), True),
        (rules.business_rules(c("brand"), c("malli"), c("moottori"), c("currency"), c("market"),
                              {f: c(f) for f in ("telamatto", "kaynnistin")}), False)], strict)


def listings(products: DataFrame) -> DataFrame:
    """Valid products as listings with title, description, price and XML text."""
    c = F.col
    labels = {"Engine": c("moottori"), "Track": c("telamatto"), "Starter": c("kaynnistin"), "Gauge": c("mittaristo"), "Color": c("vari")}
    shaped = products.filter("success").withColumns({
        "listing_id": F.concat_ws("_", "brand", "model_code", "model_year"),
        "title": prices.listing_title(c("model_code"), c("brand"), c("malli"), c("model_year"), c("paketti")),
        "description": prices.listing_description(c("model_code"), labels),
        "roubles": prices.listing_price(c("price"), c("currency"))})
    xml = sinks.listing_xml({"Id": c("listing_id"), "Title": c("title"), "Description": c("description"), "Price": c("roubles"),
                             "Model": c("malli"), "Year": c("model_year")})
    return shaped.withColumn("xml", xml)


def matched_listings(products: DataFrame, catalog: DataFrame, matcher: matching.Matcher = matching.match_texts) -> DataFrame:
    """Products through a matcher, validation (roubles) and listing; invalid rows are left out."""
    return listings(validate_products(matcher(with_search_text(products), catalog), "rub"))


def feed(cells: DataFrame, catalog: DataFrame, brand: Column, year: Column, matcher: matching.Matcher = matching.match_texts) -> DataFrame:
    """Cells through assembly, match, validation and listing."""
    return matched_listings(products_from_cells(cells, brand, year), catalog, matcher)


def extraction_run(files: DataFrame, log: DataFrame, methods: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Rows of new files from the first method that found any, and the log rows of the run.

    ``methods``: ordered ``(name, rows with file_name)``. Known files are skipped. One count per file
    and method decides the winner, so rows are never gathered per file.
    """
    fresh = joins.unseen(files, log, "file_name")
    counts = None
    for rank, (name, rows) in enumerate(methods):
        one = rows.groupBy("file_name").agg(F.count("*").alias("articles")).withColumns({"method": F.lit(name), "_rank": F.lit(rank)})
        counts = one if counts is None else counts.unionByName(one)
    winner = counts.groupBy("file_name").agg(F.min_by(F.struct("method", "articles"), "_rank").alias("w"))
    run = fresh.join(winner, "file_name", "left").select(
        *files.columns, F.col("w.method").alias("extraction_method"), F.coalesce("w.articles", F.lit(0)).alias("articles_count"))
    run = run.withColumn("status", F.when(F.col("articles_count") > 0, "completed").otherwise("failed"))
    chosen = run.select("file_name", "extraction_method")
    out = None
    for name, rows in methods:
        part = rows.join(chosen.filter(F.col("extraction_method") == name), "file_name")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out, run


def documented_steps(entries: DataFrame, models: DataFrame, engines: DataFrame, registry: DataFrame) -> DataFrame:
    """Lookup key, inherited engine values, known options and the status decision.

    ``entries(entry_id, brand, model_family, model_year, engine, options_text)``, ``models(lookup_key,
    base_model_id)``, ``engines(base_model_id, engine, displacement)``, ``registry`` as for known options.
    """
    matched = matching.match_by_key(entries, models)
    selected = matched.join(engines.withColumnRenamed("base_model_id", "matched_base_model_id"), ["matched_base_model_id", "engine"], "left")
    options = joins.known_options(entries.select("entry_id", F.col("options_text").alias("text"), "brand",
                                                 F.col("model_family").alias("family")), registry, ["entry_id"])
    done = selected.join(options, "entry_id", "left")
    score = F.coalesce("confidence_score", F.lit(0.0)) - F.when(F.col("displacement").isNull(), 0.1).otherwise(0.0) - F.when(
        F.coalesce("remainder", F.lit("")) != "", 0.05).otherwise(0.0)
    done = done.withColumn("final_score", F.greatest(F.lit(0.0), score))
    return done.withColumns(bands.decision(F.col("final_score"), F.col("matched_base_model_id").isNotNull()))
