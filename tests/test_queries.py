"""Queries against their SQL on DuckDB. ``check.py`` runs all of them at any scale."""

import pytest

import __spark_entry__ as contract
from check import compare, connect
from verify.oracles import ORACLES
from verify.queries import QUERIES

SAMPLE = [
    "pending_dates",
    "route_by_extension",
    "html_elements",
    "classify_documents",
    "lead_summary",
    "extract_lines",
    "payload_header",
    "merge_nested",
    "field_diff_report",
    "coverage_status",
    "violation_summary",
    "stream_inference",
    "intake_incremental",
    "pending_files_for_day",
    "rejected_documents",
    "parse_with_function",
    "second_source_errors",
    "field_diff_summary",
]


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, db, sf_dir, name):
    assert compare(spark, db, name, sf_dir) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.schema == contract.entry(spark).schema


def test_daily_counts_write_no_folder_a_day(spark, tmp_path, monkeypatch):
    from verify import queries

    spark.sql(
        """select id * 25 as doc_id, 'x' as text, 'en' as lang, 's' as source, 1L as n_chars from range(400)"""
    ).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "run_dir", lambda spark, name: str(tmp_path / name))
    found = QUERIES["backfill_daily_counts"](spark, str(tmp_path))
    assert found.count() == 266 and found.agg({"n_files": "sum"}).first()[0] == 266
    assert len(list((tmp_path / "backfill").rglob("*.parquet"))) <= 20
