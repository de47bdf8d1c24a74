"""Plans keep the shape they were designed for."""

import pytest

from __spark_entry__ import queries
from catalign.operators import rules

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


PAIRLESS = ["t06_reconciled_batch", "j01_base_model_candidates", "j05_first_containing", "j12_spec_price_match", "j14_whitelist_match",
            "j15_containment_suggestion", "j16_option_usage_in_text", "j17_known_options", "j20_per_language", "w03_continuation_merge",
            "w08_batches", "w09_confidence_change", "a22_listing_totals", "j03_text_match"]


@pytest.mark.parametrize("name", PAIRLESS)
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "s07_list_page")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


@pytest.mark.parametrize("name", ["w01_best_match", "w02_keep_last", "w04_most_recent", "a14_operation_timing"])
def test_ranked_rows_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["v05_layered_validation", "f20_flat_specification", "t09_specbook_pages", "p11_indexed_columns"])
def test_row_rules_do_not_shuffle_rows(spark, name):
    if name == "t09_specbook_pages":
        from pyspark.sql import functions as F  # noqa: F401
        from catalign.plans import specbook
        from catalign.tables import Tables
        from catalign.workloads.w_specbook import spec_pages
        text = specbook.extract_pages(spec_pages(Tables(spark, FOLDER)))._jdf.queryExecution().executedPlan().toString()
    else:
        text = plan(spark, name)
    assert "Exchange" not in text


def test_running_windows_have_a_bounded_partition(spark):
    for name in ("w08_batches", "w09_confidence_change", "w03_continuation_merge"):
        for line in plan(spark, name).splitlines():
            if "Window [" in line and "rank" not in line:
                assert "_block" in line or "[_part" in line, line  # _part: one row per partition of a sort


@pytest.mark.parametrize(("name", "most"), [("t06_batch_totals", 5), ("t01_base_model_levels", 3), ("t01_cascade_levels", 5), ("j06_fallback_cascade", 5),
                                           ("w03_continuation_merge", 2), ("s03_raw_records", 2), ("s04_keyword_records", 2), ("t08_marketplace_feed", 6)])
def test_inputs_are_read_a_few_times_only(spark, name, most):
    initial = plan(spark, name).split("== Initial Plan ==")[-1]
    assert initial.count("Scan ") <= most, initial


@pytest.mark.parametrize("name", ["t09_specbook_pages", "f17_page_title", "f05_block_ratio"])
def test_generated_code_compiles(spark, name):
    """Without the fallback a method that grows beyond 64 KB is an error."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


@pytest.mark.parametrize("name", ["a22_listing_totals", "a22_listing_summary", "v07_listing_fields", "v07_listing_suggested_fix", "j15_containment_suggestion"])
def test_listings_are_not_shuffled_by_model(spark, name):
    """A few models hold nearly all rows, so their outcomes go to the rows."""
    text = plan(spark, name)
    assert "BroadcastHashJoin [_clean" in text and "SortMergeJoin" not in text


def test_listing_checks_have_no_lambda(spark):
    """A lambda around a check would have it interpreted for every row."""
    row = spark.sql("SELECT '1' AS Price, true AS listed, 'x' AS similar")
    assert "lambda" not in rules.check_listings(row, ["Price"], 2026)._jdf.queryExecution().analyzed().toString()


def test_listing_rows_judge_each_field_once(spark):
    """A filter inferred from the rows' generator held every check again, below the trimmed values."""
    row = spark.sql("SELECT id AS listing_id, concat(id) AS Id, true AS listed, 'x' AS similar FROM range(3)")
    rows = rules.check_rows(rules.check_listings(row, ["Id"], 2026)).filter("fix IS NOT NULL")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Id must be at least 3 characters long") == 1
