"""What is on disk beside the data: shuffled rows go with their execution, large changes are dealt in slices."""

import glob
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.sources import views
from docrecords.sources.views import DerivedView, KeyedView
from docrecords.streaming import runners, state

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def shuffled(spark) -> set[str]:
    """The files of shuffled rows."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def left_since(spark, before: set[str], seconds: int = 20) -> set[str]:
    """Files of shuffled rows that are new and stay; they go in the background."""
    until = time.time() + seconds
    while (left := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def chain(spark, folder):
    one, total = [KeyedView(spark, f"{folder}/{n}", SCHEMA, ("k",), buckets=4).create() for n in ("one", "total")]
    return one, total, DerivedView(total, (one,), lambda a: a.withColumn("v", F.col("v") + 1))


def test_a_change_leaves_no_shuffled_rows(spark, tmp_path):
    one, total, derived = chain(spark, tmp_path)
    data = spark.createDataFrame([(f"k{i}", i) for i in range(40)], SCHEMA)
    before = shuffled(spark)
    one.upsert(data)
    derived.refresh(data)
    assert not left_since(spark, before)
    assert total.read().count() == 40


@pytest.mark.parametrize("rows", [1, 500_000])
def test_slices_give_what_one_change_gives(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(views, "SLICE_ROWS", rows, raising=False)
    one, total, derived = chain(spark, tmp_path)
    dealt = []
    monkeypatch.setattr(KeyedView, "_rewrite_some", lambda self, *a, f=KeyedView._rewrite_some: (dealt.append(a[2]), f(self, *a))[1])
    draw, want = random.Random(2), {}
    for n in range(2):
        part, gone = {f"k{draw.randint(0, 30)}": n * 100 + i for i in range(12)}, draw.sample(sorted(want), min(len(want), 6))
        want = {k: v for k, v in want.items() if k not in gone} | part
        change = spark.createDataFrame([*part.items()], SCHEMA)
        deleted = spark.createDataFrame([(k, None) for k in gone], SCHEMA)
        one.upsert(change, f"b{n}", deleted=deleted)
        derived.refresh(change.unionByName(deleted), f"b{n}")
        one.vacuum()
        assert sorted(map(tuple, one.read().collect())) == sorted(want.items())
        assert sorted(map(tuple, total.read().collect())) == sorted((k, v + 1) for k, v in want.items())
    assert (max(map(len, dealt)) == 1) == (rows == 1)


def test_paired_streams_leave_the_last_state_alone(spark, tmp_path):
    settings = [*state.STOPPING, *state.MERGED]
    sources, sink, before = [str(tmp_path / n) for n in "pf"], str(tmp_path / "out"), shuffled(spark)
    chosen = [spark.conf.get(k, None) for k in settings]
    for n in range(3):
        for side, folder in enumerate(sources):
            rows = spark.createDataFrame([(f"k{i}", n) for i in range(30) if (i + n) % 3 != side], SCHEMA)
            rows.write.mode("append").parquet(folder)
        done = state.pair_streams(*[runners.read_folder(spark, f, SCHEMA) for f in sources], "k", delay="0 seconds", groups=4)
        runners.drain_to_folder(done, sink, done.schema)
    assert not left_since(spark, before)
    batches = max(int(f.rsplit("/", 1)[1]) for f in glob.glob(f"{sink}/_checkpoint/commits/[0-9]*"))
    versions = [glob.glob(f"{p}/*.zip") for p in glob.glob(f"{sink}/_checkpoint/state/0/[0-9]*")]
    assert batches >= 4 and versions and max(map(len, versions)) <= 3
    last = state.latest_revision(spark.read.schema(done.schema).parquet(sink))
    assert {tuple(r) for r in last.select("key", "p_v", "f_v").collect()} == {(f"k{i}", 2 - (i % 3 == 1), 2 - (i % 3 == 2)) for i in range(30)}
    assert [spark.conf.get(k, None) for k in settings] == chosen
