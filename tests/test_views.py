"""Views that follow their sources: equal to recomputation, touched buckets alone, whole changes."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.sources.views import DerivedView, KeyedView
from docrecords.streaming import runners

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("at", T.IntegerType())])


@pytest.fixture
def view(spark, tmp_path):
    return KeyedView(spark, str(tmp_path / "view"), SCHEMA, ("k",), buckets=8).create()


def rows(view, *args):
    return sorted((tuple(r) for r in view.read(*args).collect()), key=repr)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upserts_equal_recomputation(spark, view):
    draw, want = random.Random(1), {}
    assert rows(view) == []
    for n in range(4):
        part = {f"k{draw.randint(0, 30)}": (draw.randint(0, 9), n) for _ in range(6)}
        want |= part
        view.upsert(frame(spark, [(k, *v) for k, v in part.items()]), f"b{n}")
        view.upsert(frame(spark, [("k0", -1, -1)]), f"b{n}")
        assert rows(view) == sorted(((k, *v) for k, v in want.items()), key=repr)


def test_order_and_repeated_keys(spark, tmp_path):
    view = KeyedView(spark, str(tmp_path / "v"), SCHEMA, ("k",), ("at",), 4).create()
    view.upsert(frame(spark, [("a", 1, 5), ("a", 2, 7), ("a", 3, 6)]))
    view.upsert(frame(spark, [("a", 4, 6), ("b", 1, None)]))
    assert rows(view) == [("a", 2, 7), ("b", 1, None)]


def test_untouched_buckets_are_not_read(spark, view, plan):
    view.upsert(frame(spark, [(f"k{i}", i, 0) for i in range(200)]))
    before = view.versions()
    touched = view.upsert(frame(spark, [("k7", -7, 1)]))
    assert len(touched) == 1 and set(before) == set(range(8))
    assert {b for b, v in view.versions().items() if v != before[b]} == set(touched)
    text = plan(view.read(touched))
    assert f"bucket={touched[0]}" in text and all(f"bucket={b}" not in text for b in before if b != touched[0])
    assert len(view.read(touched).inputFiles()) < len(view.read().inputFiles())


def test_a_killed_change_is_not_seen(spark, view, monkeypatch):
    view.upsert(frame(spark, [("a", 1, 0), ("b", 1, 0)]))
    with monkeypatch.context() as m:
        m.setattr(KeyedView, "_append", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            view.upsert(frame(spark, [("a", 2, 0), ("c", 1, 0)]))
    assert rows(view) == [("a", 1, 0), ("b", 1, 0)]
    view.upsert(frame(spark, [("a", 3, 0)]))
    assert rows(view) == [("a", 3, 0), ("b", 1, 0)]


def test_deletions_and_emptied_buckets(spark, view):
    view.upsert(frame(spark, [("a", 1, 0), ("b", 1, 0)]))
    view.upsert(frame(spark, []), deleted=frame(spark, [("a", None, None), ("none", None, None)]))
    assert rows(view) == [("b", 1, 0)]
    view.upsert(frame(spark, [("b", 2, 0)]), deleted=frame(spark, [("b", None, None)]))
    assert rows(view) == [("b", 2, 0)]


def test_follows_a_stream(spark, view, tmp_path):
    source, checkpoint = str(tmp_path / "source"), str(tmp_path / "checkpoint")
    for n in range(3):
        frame(spark, [("a", n, n), (f"x{n}", n, n)]).write.mode("append").parquet(source)
        for _ in range(2):
            view.follow(runners.read_folder(spark, source, SCHEMA), checkpoint)
    assert rows(view) == [("a", 2, 2), ("x0", 0, 0), ("x1", 1, 1), ("x2", 2, 2)]


def test_derived_view(spark, view, tmp_path):
    other = KeyedView(spark, str(tmp_path / "other"), SCHEMA, ("k",), buckets=8).create()
    total = KeyedView(spark, str(tmp_path / "total"), SCHEMA, ("k",), buckets=8).create()
    derived = DerivedView(total, (view, other), lambda a, b: a.join(b.select("k", F.col("v").alias("w")), "k").select("k", (F.col("v") + F.col("w")).alias("v"), "at"))
    changes = [(view, [("a", 1, 0), ("b", 2, 0)]), (other, [("a", 10, 0), ("c", 30, 0)]), (other, [("b", 20, 0)]), (view, [("a", 5, 0)])]
    for source, data in changes:
        source.upsert(frame(spark, data))
        derived.refresh(frame(spark, data))
    assert rows(total) == [("a", 15, 0), ("b", 22, 0)]
    other.upsert(frame(spark, []), deleted=frame(spark, [("a", None, None)]))
    derived.refresh(frame(spark, [("a", None, None)]))
    assert rows(total) == [("b", 22, 0)]


def test_nothing_is_left_but_the_last_versions(spark, tmp_path):
    import os

    from docrecords.session import shared_dir

    def left():
        top = f"{shared_dir(spark)}/docrecords"
        return {n for n in os.listdir(top) if n.startswith(("changes-", "deleted-", "changed-keys-"))} if os.path.isdir(top) else set()

    before = left()
    one, total = [KeyedView(spark, str(tmp_path / n), SCHEMA, ("k",), buckets=2).create() for n in ("one", "total")]
    derived = DerivedView(total, (one,), lambda a: a)
    data = frame(spark, [(f"k{i}", i, 0) for i in range(20)] + [(None, 1, 1)])
    for n in range(3):
        one.upsert(data.withColumn("v", F.lit(n)))
        derived.refresh(data)
    want = sorted([(f"k{i}", 2, 0) for i in range(20)], key=repr)
    for view in (one, total):
        view.vacuum()
        assert [r for r in rows(view) if r[0] is not None] == want
        assert len(os.listdir(f"{view.folder}/rows")) == 3
        assert [len([f for f in os.listdir(f"{view.folder}/rows/{v}") if f.startswith("bucket=")]) for v in sorted(os.listdir(f"{view.folder}/rows"))] == [0, 0, 2]
    assert left() == before
