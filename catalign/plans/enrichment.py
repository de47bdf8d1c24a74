"""Plan model requests and take in their responses; no service is called here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalign.functions import jsons, prices, text
from catalign.operators.keep import top_per_key
from catalign.operators.scans import batches

BATCH = 5


def product_lines(number: Column, code: Column, brand: Column, specifications: Column) -> Column:
    def shown(c: Column) -> Column:
        return F.coalesce(c, F.lit("N/A"))
    return F.concat(F.lit("Product "), number.cast("string"), F.lit(":\n- Model Code: "), shown(code), F.lit("\n- Brand: "), shown(brand),
                    F.lit("\n- Specifications: "), F.coalesce(specifications, F.lit("{}")))


def batch_requests(rows: DataFrame, order: Sequence[str], code: str, brand: str, specifications: str,
                   kind: str = "complete", size: int = BATCH) -> DataFrame:
    """One prompt per batch of ``size`` rows in order, with its token and cost estimate.

    Rows are numbered without a global sort, and a batch never holds more than ``size`` rows.
    """
    numbered = batches(rows, order, size)
    packed = numbered.groupBy("batch_no").agg(F.array_sort(F.collect_list(F.struct(
        *order, F.col(code).alias("_code"), F.col(brand).alias("_brand"), F.col(specifications).alias("_specs")))).alias("_rows"))
    listed = F.array_join(F.transform("_rows", lambda r, i: product_lines(i + 1, r["_code"], r["_brand"], r["_specs"])), "\n\n")
    n = F.size("_rows")
    prompt = F.concat(
        F.lit(f"Batch Snowmobile Product Enrichment - {kind}\n\nProcess the following "), n.cast("string"), F.lit(" products:\n\n"), listed,
        F.lit(f"\n\nTask: Perform {kind} enrichment for each product.\n\nRespond with JSON array containing results for each product in order."))
    out = packed.select("batch_no", n.alias("expected"), prompt.alias("prompt"))
    out = out.withColumn("tokens", text.token_estimate(F.col("prompt"), 2000))
    return out.withColumn("estimated_cost", prices.usage_cost(F.col("tokens"), F.lit(0)))


def option_prompt(code: Column, brand: Column, name: Column, category: Column, base: Column, own: Column) -> Column:
    def shown(c: Column) -> Column:
        return F.coalesce(c, F.lit("N/A"))
    return F.concat(F.lit("Snowmobile Spring Options Analysis:\n- Model Code: "), shown(code), F.lit("\n- Brand: "), shown(brand),
                    F.lit("\n- Model Name: "), shown(name), F.lit("\n- Category: "), shown(category),
                    F.lit("\nBase Model Specifications:\n"), F.coalesce(base, F.lit("{}")), F.lit("\nCurrent Product Specifications:\n"),
                    F.coalesce(own, F.lit("{}")))


def matching_prompts(entries: DataFrame, base_models: DataFrame, top: int = 10) -> DataFrame:
    """Prompt per unmatched entry with the first ``top`` base models of its brand and year.

    The model list is built once per brand and year and joined to the entries.
    """
    first = top_per_key(base_models, ["brand", "model_year"], [F.col("model_name"), F.col("position")], top)
    lists = first.groupBy("brand", "model_year").agg(F.array_sort(F.collect_list(F.struct(
        "model_name", "position", "base_model_id", "category", "displacement"))).alias("_m"))
    lines = F.array_join(F.transform("_m", lambda m, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), m["base_model_id"], F.lit(" - "), m["model_name"], F.lit(" | Category: "), m["category"],
        F.lit(" | Engine: "), F.coalesce(m["displacement"], F.lit("N/A")))), "\n")
    lists = lists.select("brand", "model_year", lines.alias("_lines"))
    head = F.concat(F.lit("Snowmobile Base Model Matching Task:\n- Model Code: "), F.col("model_code"), F.lit("\n- Brand: "), F.col("brand"),
                    F.lit("\n- Model Year: "), F.col("model_year").cast("string"), F.lit("\n- Price: "), F.col("price").cast("string"),
                    F.lit(" "), F.col("currency"), F.lit("\nAvailable Base Models:\n"))
    return entries.join(lists, ["brand", "model_year"], "left").select(
        "*", F.concat(head, F.coalesce("_lines", F.lit(""))).alias("prompt")).drop("_lines")


def take_in(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """One row per requested item: its result, or a failed row that falls back to single requests."""
    joined = requests.join(responses, "batch_no", "left")
    items = jsons.batch_results(F.col("response"), F.col("expected"), F.col("used_tokens"), F.col("used_cost"))
    rows = joined.select("batch_no", F.posexplode(items).alias("item_no", "r")).select("batch_no", "item_no", "r.*")
    return rows.withColumn("needs_single_request", ~F.col("success"))
