"""Kept listings: tasks list and read files, batches count once, streams resume."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from docrecords.schemas import DOCUMENT_INTAKE
from docrecords.sources import files, listing
from docrecords.streaming import runners


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in box"
    for i in range(40):
        place = folder / ["", "a", "a/b c", "d=1"][i % 4]
        place.mkdir(parents=True, exist_ok=True)
        (place / f"f{i} [x]{{y}}*.txt").write_bytes(bytes([i]) * (i + 1))
    (folder / "_hidden").mkdir()
    (folder / "_hidden" / "x").write_text("x")
    (folder / ".dot").write_text("x")
    return folder


def by_path(df):
    return sorted(tuple(r) for r in df.collect())


def test_walk_equals_sparks_listing(spark, inbox):
    assert by_path(listing.walk(spark, str(inbox))) == by_path(files.list_files(files.read_files(spark, str(inbox))))
    whole = files.read_files(spark, str(inbox))
    assert by_path(listing.with_content(listing.walk(spark, f"file://{inbox}"))) == by_path(whole)


def test_batches_hold_each_version_once(spark, inbox, tmp_path):
    kept = str(tmp_path / "listing")
    assert listing.batch_numbers(kept) == [] and listing.listed(spark, kept).count() == 0
    assert [listing.update(spark, str(inbox), kept) for _ in range(2)] == [1, 1]
    (inbox / "empty").write_bytes(b"")
    old = inbox / "a" / "f1 [x]{y}*.txt"
    os.utime(old, (1, 1))
    assert listing.update(spark, str(inbox), kept) == 2
    assert listing.listed(spark, kept).count() == 42
    fresh = spark.read.schema(listing.FILE).parquet(f"{kept}/batch=000000002").collect()
    assert {os.path.basename(r.path) for r in fresh} == {"empty", old.name}


def test_a_killed_update_is_written_over(spark, inbox, tmp_path):
    kept = str(tmp_path / "listing")
    listing.update(spark, str(inbox), kept)
    os.remove(f"{kept}/batch=000000001/_SUCCESS")
    assert listing.batch_numbers(kept) == []
    assert listing.update(spark, str(inbox), kept) == 1
    assert listing.listed(spark, kept).count() == 40


def test_stream_reads_each_file_once(spark, inbox, tmp_path):
    kept, table, checkpoint = str(tmp_path / "listing"), f"listed_{uuid.uuid4().hex[:8]}", str(tmp_path / "checkpoint")
    run = lambda: runners.listed_intake_stream(spark, str(inbox), kept, table, checkpoint=checkpoint)
    run()
    assert spark.table(table).count() == 40 and spark.table(table).schema == DOCUMENT_INTAKE
    late = inbox / "late.txt"
    late.write_bytes(b"late")
    os.utime(late, (-10**9, -10**9))
    run()
    run()
    rows = spark.table(table)
    assert rows.count() == 41 and rows.filter(F.col("path").endswith("late.txt")).first()["content"] == b"late"


def test_names_of_many_files_stay_in_tasks(spark, tmp_path):
    """200,000 names, streamed without opening: part files reach the driver, names do not."""
    kept, out = str(tmp_path / "listing"), str(tmp_path / "out")
    names = spark.range(200_000).select(
        F.concat(F.lit("file:/none/"), F.col("id").cast("string")).alias("path"),
        F.timestamp_seconds("id").alias("modificationTime"),
        F.lit(1).cast("bigint").alias("length"),
    )
    assert listing.append_batch(names, kept) == 1 and listing.append_batch(names, kept) == 1
    reader = listing._StreamReader(kept, False)
    parts = reader.partitions({"batch": 0}, reader.latestOffset())
    assert 200 <= len(parts) <= 220
    runners.drain_to_folder(listing.stream_listing(spark, kept, content=False), out, spark.read.schema(listing.FILE).parquet(kept).select("path").schema)
    assert spark.read.parquet(out).select("path").distinct().count() == 200_000


def test_tables_and_empty_listings(spark, tmp_path):
    kept = str(tmp_path / "listing")
    assert listing.read_listing(spark, kept).count() == 0
    (tmp_path / "nothing").mkdir()
    assert listing.update(spark, str(tmp_path / "nothing"), kept) == 0
    assert listing.read_listing(spark, kept, content=False).columns == ["path", "modificationTime", "length"]


def test_schemes():
    assert listing.readable("/a") and listing.readable("file:///a:b") and listing.readable("s3a://b/k") and not listing.readable("viewfs://x/y")
