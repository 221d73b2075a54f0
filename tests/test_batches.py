"""Batches that count once: killed writers, reruns, replaced days."""

import uuid
from datetime import date

import pytest
from pyspark.sql import types as T

from docrecords.sources import batches

SCHEMA = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("process_date", T.DateType()), T.StructField("destination", T.StringType())])
D1, D2 = date(2025, 1, 1), date(2025, 1, 2)


class Killed(Exception):
    pass


def die(days):
    raise Killed


@pytest.fixture
def name():
    return f"batches_{uuid.uuid4().hex[:8]}"


def write(spark, name, rows, days, **options):
    batches.write_days(spark.createDataFrame(rows, SCHEMA), name, SCHEMA, days, **options)


def held(spark, name):
    return sorted((tuple(r) for r in batches.committed(spark, name).select("x", "process_date", "destination").collect()), key=repr)


def test_uncommitted_rows_are_not_read_and_written_over(spark, name):
    first = [(1, D1, "main"), (2, None, "other")]
    write(spark, name, first, [D1, None])
    with pytest.raises(Killed):
        write(spark, name, [(3, D1, "main"), (4, D1, "rejected"), (5, D2, "main")], [D1, D2], before_commit=die)
    assert held(spark, name) == sorted(first, key=repr)
    assert spark.table(name).count() == 5
    # The new attempt has no rows for 'rejected'; what the old one left there stays unseen.
    again = [(3, D1, "main"), (5, D2, "main")]
    write(spark, name, again, [D1, D2])
    assert held(spark, name) == sorted(first + again, key=repr)
    assert {(r["destination"], r["process_date"], r["batch"], r["n_rows"]) for r in batches.commits(spark, name).collect()} == {
        ("main", D1, 1, 1), ("other", None, 1, 1), ("main", D1, 2, 1), ("main", D2, 1, 1)
    }


def test_replacing_a_day(spark, name):
    write(spark, name, [(1, D1, "main"), (2, D2, "main"), (3, None, "main")], [D1, D2, None])
    write(spark, name, [(4, D1, "other")], [D1], replace=True)
    assert held(spark, name) == sorted([(4, D1, "other"), (2, D2, "main"), (3, None, "main")], key=repr)
    write(spark, name, [(5, D1, "other")], [D1])
    assert held(spark, name) == sorted([(4, D1, "other"), (5, D1, "other"), (2, D2, "main"), (3, None, "main")], key=repr)
    with pytest.raises(Killed):
        write(spark, name, [(6, D1, "main")], [D1], replace=True, before_commit=die)
    assert (4, D1, "other") in held(spark, name)


def test_empty_days(spark, name):
    write(spark, name, [], [D1])
    write(spark, name, [], [])
    assert held(spark, name) == [] and batches.commits(spark, name).count() == 0


def test_settings_stay(spark, name):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    write(spark, name, [(1, D1, "main")], [D1])
    assert spark.conf.get(key) == before


def test_folders_do_not_grow_with_days(spark, name, tmp_path):
    from datetime import timedelta

    days = [D1 + timedelta(k) for k in range(200)]
    batches.create(spark, name, SCHEMA, str(tmp_path))
    write(spark, name, [(k, day, ("main", "other")[k % 2]) for k, day in enumerate(days)], days)
    assert len(list((tmp_path / name).rglob("*.parquet"))) <= 8 and len(held(spark, name)) == 200


def test_other_days_after_a_killed_writer(spark, name):
    with pytest.raises(Killed):
        write(spark, name, [(1, D1, "main"), (2, D1, "rejected"), (3, D2, "main")], [D1, D2], before_commit=die)
    # Both days are written by themselves, with the numbers that the killed writer used.
    write(spark, name, [(3, D2, "main")], [D2])
    write(spark, name, [(1, D1, "main"), (4, D1, "rejected")], [D1])
    assert held(spark, name) == [(1, D1, "main"), (3, D2, "main"), (4, D1, "rejected")]


def test_folders_of_days_that_are_there_stay(spark, name):
    from docrecords.sources.tables import create_empty

    more = [T.StructField("attempt", T.StringType()), T.StructField("batch", T.IntegerType())]
    create_empty(spark, name, T.StructType([*SCHEMA.fields, *more]), batches.PARTITIONS)
    create_empty(spark, batches.commits_of(name), T.StructType(batches.COMMITS.fields[:5]))
    write(spark, name, [(1, D1, "main"), (2, None, "other")], [D1, None])
    with pytest.raises(Killed):
        write(spark, name, [(3, D1, "main")], [D1], before_commit=die)
    write(spark, name, [(4, D1, "main")], [D1])
    assert held(spark, name) == sorted([(1, D1, "main"), (2, None, "other"), (4, D1, "main")], key=repr)
    assert batches.commits(spark, name).count() == 3
