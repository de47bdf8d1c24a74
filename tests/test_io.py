"""Sources, sinks and streams on temporary folders."""

import json

from pyspark.sql import functions as F

from catalign.operators import history
from catalign.plans import enrichment, feed, training
from catalign.sources import documents, files, sinks
from catalign.streaming import monitors


def test_files_are_listed_and_checked(spark, tmp_path):
    (tmp_path / "LYNX_2025_PRICE_LIST.pdf").write_bytes(b"x" * 10)
    (tmp_path / "SKI-DOO_MY26.pdf").write_bytes(b"")
    (tmp_path / "big.pdf").write_bytes(b"x" * 100)
    wanted = spark.createDataFrame([("SKI-DOO_MY26.pdf",), ("big.pdf",), ("gone.pdf",)], "name string")
    found = files.price_list_files(files.checked(files.discover(spark, str(tmp_path), "*.pdf"), 50, wanted))
    rows = {r.name: r for r in found.collect()}
    assert rows["LYNX_2025_PRICE_LIST.pdf"].brand == "LYNX" and rows["LYNX_2025_PRICE_LIST.pdf"].reject_reason is None
    assert rows["SKI-DOO_MY26.pdf"].year == "2026" and rows["SKI-DOO_MY26.pdf"].reject_reason == "missing or empty file"
    assert rows["gone.pdf"].reject_reason == "missing or empty file"
    assert rows["big.pdf"].brand is None and rows["big.pdf"].reject_reason == "file too large"


def test_json_files(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps([{"model_code": "LTTA", "brand": "Lynx", "price": 12000, "model_year": 2024}]))
    assert documents.read_entries(spark, str(tmp_path / "e.json")).first().price == 12000.0
    (tmp_path / "r.json").write_text(json.dumps({"reports_list": {"reports": [{"id": 1, "status": "error"}, {"id": 2, "status": "ok"}]}}))
    rows = documents.report_rows(documents.read_json(spark, str(tmp_path / "r.json"), documents.REPORTS))
    assert sorted((r.id, r.status) for r in rows.collect()) == [(1, "error"), (2, "ok")]
    (tmp_path / "w.json").write_text(json.dumps({"brp_models": ["A", "B"]}))
    listed = documents.whitelist(documents.read_json(spark, str(tmp_path / "w.json"), "brp_models array<string>"))
    assert [(r.position, r.name) for r in listed.orderBy("position").collect()] == [(0, "A"), (1, "B")]


def test_upsert_delete_and_retention(spark, tmp_path):
    base = str(tmp_path)
    sinks.append_rows(spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int"), base + "/t")
    sinks.upsert_table(spark.createDataFrame([("a", 5), ("c", 1)], "k string, n int"), base + "/t", base + "/t2", ["k"], ["n"])
    assert {(r.k, r.n) for r in spark.read.parquet(base + "/t2").collect()} == {("a", 5), ("b", 1), ("c", 1)}
    sinks.delete_from(base + "/t2", base + "/t3", spark.createDataFrame([("b",)], "k string"), ["k"])
    assert {r.k for r in spark.read.parquet(base + "/t3").collect()} == {"a", "c"}
    dated = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-02-01 00:00:00')) AS created_at")
    sinks.append_rows(dated, base + "/d")
    as_of = F.lit("2024-02-10 00:00:00").cast("timestamp_ntz")
    counts = sinks.retain_tables(spark, {"d": (base + "/d", base + "/d2")}, "created_at", as_of, 30).first()
    assert (counts.deleted, counts.kept) == (1, 1) and spark.read.parquet(base + "/d2").count() == 1


def test_xml_feed_roundtrip(spark, tmp_path):
    ads = spark.createDataFrame([("A-1", "Snow & ice <fast>", 2500000)], "Id string, Title string, Price long")
    sinks.write_feed(ads, str(tmp_path / "feed"))
    back = spark.read.format("xml").option("rowTag", "Ad").schema("Id string, Title string, Price long").load(str(tmp_path / "feed"))
    assert back.first() == ads.first()
    marks = spark.createDataFrame([("<a><b>1</b></a>",), ("<a><b>1</a>",)], "x string").select(sinks.well_formed(F.col("x"), "b STRING"))
    assert [r[0] for r in marks.collect()] == [True, False]


def test_audit_and_update(spark):
    products = spark.createDataFrame([("p", 0.5, "low"), ("q", 0.8, "medium")], "id string, overall_confidence double, confidence_level string")
    news = spark.createDataFrame([("p", 0.95, "final_validation")], "id string, new_confidence double, stage string")
    fresh, audit = history.update_confidence(products, news, "id")
    assert {(r.id, r.confidence_level) for r in fresh.collect()} == {("p", "high"), ("q", "medium")}
    row = audit.first()
    assert json.loads(row.before_data) == {"confidence": 0.5} and abs(row.confidence_change - 0.45) < 1e-9
    assert history.created_audit(products, "id").count() == 2


def test_extraction_run_takes_the_first_method_with_rows(spark):
    found = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "file_name string")
    log = spark.createDataFrame([("d",)], "file_name string")
    one = spark.createDataFrame([("a", 1)], "file_name string, x int")
    two = spark.createDataFrame([("a", 9), ("b", 2), ("b", 3), ("d", 4)], "file_name string, x int")
    rows, run = feed.extraction_run(found, log, [("first", one), ("second", two)])
    assert sorted((r.file_name, r.x) for r in rows.collect()) == [("a", 1), ("b", 2), ("b", 3)]
    assert {(r.file_name, r.extraction_method, r.status) for r in run.collect()} == {
        ("a", "first", "completed"), ("b", "second", "completed"), ("c", None, "failed")}


def test_training_rows_and_enrichment(spark):
    long = "A page with enough text to be kept, because it is longer than fifty characters."
    pages = spark.createDataFrame([(1, "LYNX 2026 SPEC BOOK.pdf", long), (2, "SKI-DOO_2025.pdf", long), (3, "x.pdf", "short")],
                                  "id long, file string, text string")
    rows = training.instruction_rows(pages).collect()
    assert sorted(r.id for r in rows) == [1, 1, 2]
    assert rows[0].messages[0].role == "user" and rows[0].messages[1].role == "assistant"
    items = spark.createDataFrame([(i, f"C{i}", "Lynx", "{}") for i in range(12)], "id long, code string, brand string, specs string")
    asked = enrichment.batch_requests(items, ["id"], "code", "brand", "specs")
    assert sorted(r.expected for r in asked.collect()) == [2, 5, 5]
    replies = spark.createDataFrame([(0, '[{"enrichment_result":{"a":1},"confidence":0.8}]', 10, 0.1)],
                                    "batch_no long, response string, used_tokens int, used_cost double")
    taken = enrichment.take_in(asked, replies).collect()
    assert len(taken) == 12 and all(r.needs_single_request for r in taken)


def test_streamed_files_come_in_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "k string, n long"
    spark.createDataFrame([("a", 1), ("a", 2)], schema).coalesce(1).write.mode("append").parquet(source)
    monitors.ingest(monitors.file_stream(spark, source, schema), target, mark, ["k"], ["n"])
    spark.createDataFrame([("a", 7), ("b", 1)], schema).coalesce(1).write.mode("append").parquet(source)
    monitors.ingest(monitors.file_stream(spark, source, schema), target, mark, ["k"], ["n"])
    monitors.ingest(monitors.file_stream(spark, source, schema), target, mark, ["k"], ["n"])
    assert {(r.k, r.n) for r in monitors.ingested(spark, target, ["k"]).collect()} == {("a", 7), ("b", 1)}
    assert spark.read.parquet(target).count() == 3


def test_duplicates_are_suppressed_across_batches(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "h string, ts timestamp"
    for day in ("2024-01-01", "2024-01-02"):
        spark.sql(f"SELECT explode(array('x', 'x', '{day}')) AS h, TIMESTAMP '{day} 10:00:00' AS ts").coalesce(1).write.mode("append").parquet(source)
        stream = monitors.file_stream(spark, source, schema)
        monitors.to_table(monitors.first_uploads(stream, "h", "ts", "5 days"), target, mark)
    assert sorted(r.h for r in spark.read.parquet(target).collect()) == ["2024-01-01", "2024-01-02", "x"]


def test_ingest_of_several_batches_and_compaction(spark, tmp_path):
    for day in range(3):
        spark.createDataFrame([(k, day * 10 + k) for k in range(day, day + 3)], "k long, n long").coalesce(1).write.parquet(str(tmp_path / f"in/day{day}"))
    stream = lambda: monitors.file_stream(spark, str(tmp_path / "in/*"), "k long, n long", per_trigger=1)
    monitors.ingest(stream(), str(tmp_path / "rows"), str(tmp_path / "checkpoint"), ["k"], ["n"])
    assert len(list((tmp_path / "rows").glob("batch_id=*"))) == 3
    want = {(0, 0), (1, 11), (2, 22), (3, 23), (4, 24)}
    assert {(r.k, r.n) for r in monitors.ingested(spark, str(tmp_path / "rows"), ["k"]).collect()} == want
    monitors.compact(spark, str(tmp_path / "rows"), str(tmp_path / "next"), ["k"])
    assert [p.name for p in (tmp_path / "next").glob("batch_id=*")] == ["batch_id=2"]
    spark.createDataFrame([(0, 99)], "k long, n long").coalesce(1).write.parquet(str(tmp_path / "in/day9"))
    monitors.ingest(stream(), str(tmp_path / "next"), str(tmp_path / "checkpoint"), ["k"], ["n"])
    assert {(r.k, r.n) for r in monitors.ingested(spark, str(tmp_path / "next"), ["k"]).collect()} == (want - {(0, 0)}) | {(0, 99)}


def test_option_usage_counts_recent_texts_of_live_options(spark):
    from catalign.operators import joins
    options = spark.sql("SELECT * FROM VALUES (1L, 'gold', 'a', CAST(NULL AS DATE)), (2L, 'x_z', 'a', NULL), (3L, 'gold', 'b', DATE '2024-01-01') AS t(option_id, name, brand, deleted_at)")
    texts = spark.sql("SELECT * FROM VALUES (1L, 'old gold', DATE '2025-01-01'), (2L, 'a gold xyz', DATE '2025-02-20'), (3L, 'gold', DATE '2025-01-30') AS t(id, text, created_at)")
    out = joins.option_usage_in_text(options, texts, ["id"], F.lit("2025-03-01").cast("date"))
    assert sorted((r.option_id, r.brand, r.recent_usage_count) for r in out.collect()) == [(1, "a", 2), (2, "a", 1)]
