"""Files to final records through tables and streams."""

import os
import re
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docrecords.operators import canonical, enrich, intake, parse
from docrecords.plans import ingest
from docrecords.plans.records import dual_source, quality_views, single_source
from docrecords.schemas import CANONICAL, DOCUMENT_INTAKE, RESPONSE
from docrecords.sources.tables import create_empty, table_exists, use_database, write_table
from docrecords.streaming import runners
from verify import bindings as b

INVOICE = """Invoice
Invoice Number: IN-1
Vendor Name: V
Total Amount: 12.5
Ship To City: X
Terms Net Due Days: 30
Flags: OK
Barcode: IN-1
1|P1|BOX|2.0|0.0|6.25|12.5
This invoice is long enough to be labelled by the phrases it contains.
"""
CONTRACT = "This agreement is made hereby. " * 5


def touch(path, content, when):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    stamp = datetime.fromisoformat(when + "+00:00").timestamp()
    os.utime(path, (stamp, stamp))


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    touch(folder / "a" / "one.pdf", INVOICE.encode(), "2025-09-02 10:00:00")
    touch(folder / "a" / "two.PDF", CONTRACT.encode(), "2025-09-02 11:00:00")
    touch(folder / "b" / "blank.pdf", b"\n \n", "2025-09-03 10:00:00")
    touch(folder / "b" / "note.txt", INVOICE.encode() + b"\xff", "2025-09-03 11:00:00")
    touch(folder / "b" / "page.html", b"<p>An invoice. Amount due: 5.</p>" + b"<p>text</p>" * 30, "2025-09-04 09:00:00")
    touch(folder / "old.pdf", INVOICE.encode(), "2025-08-01 10:00:00")
    return folder


@pytest.fixture
def config(spark, inbox):
    tag = uuid.uuid4().hex[:8]
    return ingest.IngestConfig(
        str(inbox), f"intake_{tag}", f"documents_{tag}", f"second_{tag}", suffixes=None
    )


def by_destination(spark, config):
    docs = spark.table(config.documents_table)
    return {
        (r.destination, r.path.rsplit("/", 1)[1], r.document_type, r.reason)
        for r in docs.collect()
    }


def test_intake_is_incremental(spark, config, inbox):
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    assert spark.table(config.intake_table).count() == 6
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    assert spark.table(config.intake_table).count() == 6
    touch(inbox / "new [1]{a}*.pdf", INVOICE.encode(), "2025-09-05 10:00:00")
    # A late file is taken in however old it is.
    touch(inbox / "late.pdf", INVOICE.encode(), "2019-09-04 10:00:00")
    ingest.run_intake(spark, config, datetime(2025, 9, 5, 12))
    assert spark.table(config.intake_table).count() == 8
    assert intake.high_water_mark(spark.table(config.intake_table)).first()[0] == datetime(2025, 9, 5, 12)


def test_intake_options_narrow_the_comparison(spark):
    files = spark.sql("select path, timestamp(t) as modificationTime from values ('a', '2025-01-01'), ('b', '2025-03-01'), (null, '2025-03-01') v(path, t)")
    done = spark.sql("select 'b' as path, timestamp('2025-03-01') as modificationTime, timestamp('2025-03-02') as ingestion_timestamp")
    fresh = lambda **o: sorted((str(r.path) for r in intake.incremental_intake(files, done, **o).collect()))
    assert fresh() == ["None", "a"]
    assert fresh(lookback=timedelta(days=5)) == ["None"]
    assert fresh(baseline="2025-02-01") == ["None"]


def test_content_of_known_files_is_not_moved(spark, config, plan):
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    ingest.run_backfill(spark, ingest.IngestConfig(config.folder, config.intake_table, config.documents_table, dates=(date(2025, 9, 2),)))
    taken = spark.table(config.intake_table)
    ledger = intake.ledger_of(spark.table(config.documents_table))
    pending = intake.pending_files(taken.select(*intake.VERSION), ledger)
    files = ingest._content_of(taken, pending)
    assert files.count() == 4
    text = plan(files)
    for exchange in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text):
        assert "content" not in exchange
    assert "process_date" in text and intake.pending_by_day(taken, pending)[1] == []


def test_first_run_without_files(spark, config, tmp_path):
    (tmp_path / "empty").mkdir()
    empty = ingest.IngestConfig(str(tmp_path / "empty"), config.intake_table)
    ingest.run_intake(spark, empty)
    assert spark.table(config.intake_table).schema == DOCUMENT_INTAKE
    assert spark.table(config.intake_table).count() == 0


def test_backfill_routes_once(spark, config):
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    ingest.run_backfill(spark, config)
    wanted = {
        ("main", "one.pdf", "invoice", None),
        ("main", "note.txt", "invoice", None),
        ("main", "page.html", "invoice", None),
        ("main", "old.pdf", "invoice", None),
        ("other", "two.PDF", "contract", None),
        ("rejected", "blank.pdf", "unknown", "no elements"),
    }
    assert by_destination(spark, config) == wanted
    ingest.run_backfill(spark, config)
    assert spark.table(config.documents_table).count() == 6
    summary = ingest.run_summary(spark, config)
    assert {tuple(r) for r in summary["documents"].collect()} == {("main", 4), ("other", 1), ("rejected", 1)}
    assert summary["latest"].first()["path"].endswith("page.html")
    assert {r["extension"]: r["n"] for r in summary["extensions"].collect()} == {"pdf": 3, "PDF": 1, "txt": 1, "html": 1}


def test_backfill_of_chosen_days(spark, config):
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    days = ingest.IngestConfig.parse_dates('["2025-09-02"]')
    assert days == (date(2025, 9, 2),)
    ingest.run_backfill(spark, ingest.IngestConfig(config.folder, config.intake_table, config.documents_table, dates=days))
    assert spark.table(config.documents_table).count() == 2
    left = intake.pending_dates(spark.table(config.intake_table), spark.table(config.documents_table))
    assert [r[0] for r in left.collect()] == [date(2025, 8, 1), date(2025, 9, 3), date(2025, 9, 4)]


def test_second_source_reads_kept_documents(spark, config):
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    ingest.run_backfill(spark, config)
    ingest.run_second_source(spark, config, lambda content: content.decode("utf-8", "strict"))
    rows = {r.path.rsplit("/", 1)[1]: r for r in spark.table(config.second_table).collect()}
    assert set(rows) == {"one.pdf", "old.pdf", "note.txt", "page.html"}
    assert rows["note.txt"].text is None and rows["note.txt"].error.startswith("UnicodeDecodeError")
    assert rows["one.pdf"].text == INVOICE and rows["one.pdf"].error is None
    assert rows["one.pdf"].document_type == "invoice"
    # A failed document is tried again, the others are not.
    ingest.run_second_source(spark, config)
    again = [r for r in spark.table(config.second_table).collect() if r.path.endswith("note.txt")]
    assert spark.table(config.second_table).count() == 5
    assert sorted(r.error is None for r in again) == [False, True]


def test_binary_files_are_rejected_or_parsed(spark, config, inbox):
    touch(inbox / "scan.pdf", b"%PDF\xff\xfe", "2025-09-02 12:00:00")
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    ingest.run_backfill(spark, config)
    assert ("rejected", "scan.pdf", "unknown", "not text") in by_destination(spark, config)

    def parser(content: bytes) -> list[str]:
        if content.startswith(b"%PDF"):
            return ["An invoice.", "Amount due: 3"]
        return content.decode().splitlines()

    other = ingest.IngestConfig(config.folder, config.intake_table, config.documents_table + "_p", parser=parser)
    ingest.run_backfill(spark, other)
    found = by_destination(spark, other)
    assert ("main", "scan.pdf", "invoice", None) in found and ("main", "one.pdf", "invoice", None) in found


def test_extraction_chain_runs_once_per_row(spark, config):
    ingest.run_intake(spark, config, datetime(2025, 9, 4, 12))
    ingest.run_backfill(spark, config)
    responses, records = f"responses_{config.intake_table}", f"records_{config.intake_table}"
    for _ in range(2):
        runners.extraction_chain(
            spark, config.documents_table, responses, records, only=runners.only_destination("main")
        )
        assert spark.table(responses).count() == 4
        assert spark.table(records).count() == 3
    (one,) = spark.table(records).filter("source_file_name = 'one.pdf'").collect()
    assert one.invoice_header.totalAmount == 12.5
    assert one.invoice_header.shippingAddress.city == "X"
    assert [x.lineTotal for x in one.line_items] == [12.5]
    assert spark.table(responses).filter("error is not null").first()["source_file_path"].endswith("page.html")


def test_streamed_intake_sees_late_files(spark, inbox):
    table = f"streamed_{uuid.uuid4().hex[:8]}"
    runners.intake_stream(spark, str(inbox), table)
    assert spark.table(table).count() == 6
    touch(inbox / "late.pdf", b"x", "2025-01-01 00:00:00")
    runners.intake_stream(spark, str(inbox), table)
    assert spark.table(table).count() == 7
    assert spark.table(table).schema == DOCUMENT_INTAKE


def test_tables(spark):
    use_database(spark, "default")
    name = f"t_{uuid.uuid4().hex[:8]}"
    assert not table_exists(spark, name)
    create_empty(spark, name, RESPONSE)
    row = spark.sql("select 'e' as error, 'i' as input, parse_json('{\"a\":1}') as response")
    write_table(row, name, RESPONSE)
    found = spark.table(name).selectExpr("input", "error", "to_json(response)", "summary").first()
    assert tuple(found) == ("i", "e", '{"a":1}', None)


def test_older_parser_layout(spark):
    df = spark.sql(
        """select parse_json('{"document": {"pages": [{"content": "b"}, {"content": "a"}]}}') as raw_parsed
        union all select parse_json('{"document": {"pages": [{"content": "c"}]}, "error_status": "bad"}')"""
    )
    texts = parse.elements_to_text(df, sep="|", array_field="pages").select("text").collect()
    assert sorted(str(r[0]) for r in texts) == ["None", "b|a"]


def test_routing_keeps_rows_without_a_type(spark):
    docs = spark.createDataFrame([("a", "invoice"), ("b", None), ("c", "receipt")], "path string, document_type string")
    main, other = enrich.route_by_type(docs)
    assert [r.path for r in main.collect()] == ["a"]
    assert sorted(r.path for r in other.collect()) == ["b", "c"]


def test_short_texts_are_not_labelled(spark):
    df = spark.createDataFrame([("invoice",), (None,), ("z" * 101,)], "text string")
    found = {(r.summary, r.document_type) for r in enrich.enrich(df, {"min_length": 100}, min_length=100).collect()}
    assert found == {("No summary available", "unknown"), ("z" * 101, "other")}
    whole = {(r.summary, r.document_type) for r in enrich.enrich(df).collect()}
    assert whole == {("invoice", "invoice"), ("No summary available", "unknown"), ("z" * 101, "other")}


def test_summary_and_label_of_the_caller(spark):
    df = spark.createDataFrame([("some text",), (None,)], "text string")
    done = enrich.enrich(df, {"fn": F.upper}, fn=lambda text: F.concat(F.lit("kind-"), F.left(text, F.lit(4))))
    assert {(r.summary, r.document_type) for r in done.collect()} == {("SOME TEXT", "kind-some"), ("No summary available", "unknown")}


def test_views(spark, sf_dir):
    views = dual_source(b.primary(spark, sf_dir), b.fallback(spark, sf_dir))
    views.register("t_")
    assert spark.sql("select count(*) from t_canonical_final").first()[0] == views.final.count()
    reports = quality_views(views)
    assert reports["differences"].count() > 0 and reports["missing"].count() == 20
    one = single_source(b.primary(spark, sf_dir))
    assert one.final.count() == one.primary_flat.count()
    assert "violations" in quality_views(one)


def test_latest_versions_of_records_are_merged(spark, sf_dir):
    p, f = b.primary(spark, sf_dir), b.fallback(spark, sf_dir)
    newer = p.withColumn("processing_timestamp", F.lit("2031-01-01").cast("timestamp")).withColumn("flags", F.lit("newer"))
    twice = dual_source(p.unionByName(newer), f, version=["processing_timestamp"])
    assert twice.final.count() == dual_source(p, f).final.count()
    assert twice.primary_flat.filter("flags <> 'newer'").count() == 0


def test_stream_equals_batch(spark, sf_dir, rows):
    from verify.queries import QUERIES, REPORTED

    assert rows(QUERIES["stream_canonical"](spark, sf_dir), *REPORTED) == rows(
        QUERIES["payload_header"](spark, sf_dir), *REPORTED
    )


def test_canonical_layout_is_the_declared_one(spark, sf_dir):
    from verify.queries import _responses

    df = canonical.canonicalize(_responses(spark, sf_dir))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CANONICAL]
    assert df.select(F.col("invoice_header.invoiceNumber")).count() > 0
