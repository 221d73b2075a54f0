"""What the physical plans must and must not contain."""

import re
from datetime import date

from pyspark.sql import functions as F

from docrecords.operators import canonical, enrich, extract, intake, merge, parse, quality, validate
from docrecords.plans.ingest import IngestConfig, process_documents
from docrecords.plans.records import dual_source
from verify import bindings as b


def test_merge_joins_by_key(spark, sf_dir, plan):
    p, f = canonical.flatten(b.primary(spark, sf_dir)), canonical.flatten(b.fallback(spark, sf_dir))
    for df in (merge.merge_sources(p, f), quality.field_status(p, f), quality.coverage_status(p, f)):
        text = plan(df)
        assert "FullOuter" in text
        assert "NestedLoop" not in text and "Cartesian" not in text
    typed = [canonical.flatten(side(spark, sf_dir), extra=("line_items",)) for side in (b.primary, b.fallback)]
    assert "from_json" not in plan(merge.merge_sources(*typed)) and "from_json" in plan(merge.merge_sources(p, f))


def test_parsing_and_enrichment_do_not_shuffle(spark, sf_dir, plan):
    listing = b.with_content(b.files(spark, sf_dir))
    text = plan(process_documents(listing.withColumn("process_date", F.to_date("modificationTime")), IngestConfig("/x")))
    assert "Exchange" not in text and "Join" not in text


def test_extraction_rules_and_flattening_do_not_shuffle(spark, sf_dir, plan, tmp_path):
    folder = str(tmp_path / "records")
    b.primary(spark, sf_dir).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert "Exchange" not in plan(validate.validate(stored))
    assert "Exchange" not in plan(canonical.flatten(stored))
    docs = str(tmp_path / "docs")
    b.payloads(spark, sf_dir).write.parquet(docs)
    chain = canonical.canonicalize(extract.run_inference(spark.read.parquet(docs), extract.json_payload))
    assert "Exchange" not in plan(chain)
    assert plan(chain).count("try_parse_json") + plan(chain).count("tryParseJson") <= 1


def test_only_needed_columns_are_read(spark, sf_dir, plan, tmp_path):
    folder = str(tmp_path / "records")
    b.primary(spark, sf_dir).write.parquet(folder)
    flat = canonical.flatten(spark.read.parquet(folder))
    schema = re.search(r"ReadSchema: (\S+)", plan(flat.select("source_file_path", "shipping_city"))).group(1)
    assert schema == "struct<source_file_path:string,invoice_header:struct<shippingAddress:struct<city:string>>>"


def test_a_day_reaches_the_scan(spark, plan, tmp_path):
    folder = str(tmp_path / "intake")
    spark.sql("select 'a' path, timestamp '2025-09-05 01:00:00' modificationTime, X'00' content").write.parquet(folder)
    df = intake.pending_files(spark.read.parquet(folder), None, [date(2025, 9, 5)]).select("path")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(df)).group(1)
    assert "GreaterThanOrEqual(modificationTime" in pushed and "LessThan(modificationTime" in pushed
    assert "content" not in re.search(r"ReadSchema: (\S+)", plan(df)).group(1)


def test_pending_files_is_an_anti_join(spark, sf_dir, plan):
    listing = b.files(spark, sf_dir)
    assert "LeftAnti" in plan(intake.pending_files(listing, b.ledger(listing)))


def test_labels_are_computed_once(spark, sf_dir, plan):
    docs = b.table(spark, sf_dir, "documents")
    main, _ = enrich.route_by_type(enrich.classify(docs))
    assert plan(main).count("replace(_low") <= sum(map(len, enrich.LABEL_PHRASES.values()))


def test_exploded_elements_are_computed_once(spark, sf_dir, plan):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    text = plan(parse.elements_exploded(parse.parse_elements(docs).select("doc_id", "raw_parsed")))
    assert text.count("to_variant_object") <= 1


def test_bucketed_layers_join_in_place(spark, sf_dir, plan):
    views = dual_source(b.primary(spark, sf_dir), b.fallback(spark, sf_dir)).save(spark, "bucketed_", 4)
    for df in (
        merge.merge_sources(views.primary_flat, views.fallback_flat),
        quality.coverage(views.primary_flat, views.fallback_flat),
    ):
        assert "FullOuter" in plan(df) and "Exchange" not in plan(df)
    assert views.final.count() == views.nested.count()


def test_content_and_ledger_are_joined_where_they_lie(spark, plan, tmp_path):
    from docrecords.operators import intake
    from docrecords.plans import ingest
    from docrecords.session import kept_in_buckets

    rows = spark.sql("select concat('p', id) as path, timestamp_seconds(id) as modificationTime, repeat('x', 10) as content, date '2025-01-01' as process_date from range(100)")
    rows = rows.unionByName(spark.sql("select 'n' as path, cast(null as timestamp) as modificationTime, 'null' as content, date '2025-01-01' as process_date"))
    taken = kept_in_buckets(rows, "taken", 4, *intake.VERSION)
    ledger = kept_in_buckets(rows.filter("path < 'p5'").select(*intake.VERSION), "ledger", 4, *intake.VERSION)
    pending = intake.in_place(taken, ledger)
    assert "Exchange" not in plan(pending) and "Sort" not in plan(pending)
    want = {r["path"] for r in rows.collect() if not (r["path"] < "p5" and r["modificationTime"])}
    assert {r["path"] for r in pending.collect()} == want
    config = ingest.IngestConfig("", buckets=4)
    versions = kept_in_buckets(pending.select(*intake.VERSION, "process_date"), "pending", 4, *intake.VERSION)
    found = ingest.content_of(taken, versions, config)
    assert {r["path"] for r in found.collect()} == want


def test_days_make_neither_folders_in_buckets_nor_long_plans(spark, plan, tmp_path):
    import os
    import uuid

    from docrecords.plans import ingest
    from docrecords.schemas import DOCUMENT_INTAKE
    from docrecords.sources.tables import create_empty, write_table

    config = ingest.IngestConfig("", f"intake_{uuid.uuid4().hex[:8]}", buckets=2, location=str(tmp_path))
    rows = spark.sql("select concat('p', id) as path, timestamp_seconds(id * 86400) as modificationTime, X'41' as content from range(300)").withColumn("process_date", F.to_date("modificationTime"))
    layout = ingest.intake_layout(spark, config)
    create_empty(spark, config.intake_table, DOCUMENT_INTAKE, location=config.location, **layout)
    write_table(rows, config.intake_table, DOCUMENT_INTAKE, **layout)
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 4
    taken = spark.table(config.intake_table)
    pending = rows.select("path", "modificationTime", "process_date").filter("path <> 'p7'")
    for found in (ingest.content_of(taken, pending, config), ingest.content_of(taken, pending, ingest.IngestConfig("", config.intake_table))):
        assert found.count() == 299 and "1970-03-17" not in plan(found)
