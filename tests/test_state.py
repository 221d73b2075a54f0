"""Streams with state per key: changes of rewritten upstreams, and the merge of two streams."""

import pytest

from docrecords.streaming import runners, state

ROWS = "path string, v int, note string, at timestamp"


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("a", "b", "out")}


def add(spark, folder, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).selectExpr("path", "v", "note", "cast(at as timestamp) as at").write.mode("append").parquet(folder)


def schema_of(spark):
    return spark.createDataFrame([], ROWS).schema


def changes(spark, folders, **options):
    stream = runners.read_folder(spark, folders["a"], schema_of(spark))
    rows = state.emit_changes(stream, ["path"], **options)
    runners.drain_to_folder(rows, folders["out"], rows.schema)
    return sorted((r["path"] or "", r["v"], r["emission"]) for r in spark.read.schema(rows.schema).parquet(folders["out"]).collect())


def test_each_state_of_a_key_once(spark, folders):
    add(spark, folders["a"], [("x", 1, None, None), ("y", 1, "n", None), (None, 7, "", None), ("x", 1, None, None)])
    assert changes(spark, folders, compared=["v"]) == [("", 7, 1), ("x", 1, 1), ("y", 1, 1)]
    # The whole upstream comes again, one value has changed, and a column that is not compared.
    add(spark, folders["a"], [("x", 2, None, None), ("y", 1, "other", None), (None, 7, "", None)])
    assert changes(spark, folders, compared=["v"]) == [("", 7, 1), ("x", 1, 1), ("x", 2, 2), ("y", 1, 1)]
    add(spark, folders["a"], [("x", 1, None, None)])
    assert ("x", 1, 3) in changes(spark, folders, compared=["v"])


def test_first_only(spark, folders):
    add(spark, folders["a"], [("x", 1, None, None)])
    changes(spark, folders, first_only=True)
    add(spark, folders["a"], [("x", 2, None, None), ("z", None, None, None)])
    assert changes(spark, folders, first_only=True) == [("x", 1, 1), ("z", None, 1)]


def test_order_within_a_batch(spark, folders):
    from datetime import datetime

    add(spark, folders["a"], [("x", k, None, datetime(2025, 1, k)) for k in (3, 1, 2)])
    assert changes(spark, folders, compared=["v"], order="at") == [("x", 1, 1), ("x", 2, 2), ("x", 3, 3)]


def pairs(spark, folders):
    streams = [runners.read_folder(spark, folders[n], schema_of(spark)) for n in ("a", "b")]
    done = state.pair_streams(*streams, "path", delay="0 seconds", order="at")
    runners.drain_to_folder(done, folders["out"], done.schema)
    return spark.read.schema(done.schema).parquet(folders["out"])


def seen(df):
    return sorted(((r["key"], r["revision"], r["p_v"], r["f_v"], r["in_left"], r["in_right"]) for r in df.collect()), key=repr)


def test_partners_meet_and_late_ones_correct(spark, folders):
    add(spark, folders["a"], [("both", 1, "né", None), ("early", 2, None, None), (None, 9, None, None)])
    add(spark, folders["b"], [("both", 10, None, None), ("only", 30, None, None), (None, 8, None, None)])
    first = [("both", 1, 1, 10, True, True), ("early", 1, 2, None, True, False), ("only", 1, None, 30, False, True)]
    first += [(None, 1, 9, None, True, False), (None, 1, None, 8, False, True)]
    assert seen(pairs(spark, folders)) == sorted(first, key=repr)
    # A late partner, a new record of a side, and a record that comes again.
    add(spark, folders["b"], [("early", 20, None, None), ("both", 10, None, None)])
    add(spark, folders["a"], [("both", 5, None, None)])
    done = pairs(spark, folders)
    more = [("early", 2, 2, 20, True, True), ("both", 2, 5, 10, True, True)]
    assert seen(done) == sorted(first + more, key=repr)
    assert seen(state.latest_revision(done)) == sorted([*more, *first[2:]], key=repr)


def test_a_record_alone_waits_for_the_watermark(spark, folders):
    add(spark, folders["a"], [("x", 1, None, None)])
    add(spark, folders["b"], [])
    streams = [runners.read_folder(spark, folders[n], schema_of(spark)) for n in ("a", "b")]
    done = state.pair_streams(*streams, "path", delay="1 hour")
    runners.drain_to_folder(done, folders["out"], done.schema)
    assert spark.read.schema(done.schema).parquet(folders["out"]).count() == 0
    add(spark, folders["b"], [("x", 2, None, None)])
    runners.drain_to_folder(done, folders["out"], done.schema)
    assert seen(spark.read.schema(done.schema).parquet(folders["out"])) == [("x", 1, 1, 2, True, True)]


def test_keys_of_a_group_share_a_value_and_a_call(spark, folders):
    from datetime import datetime

    rows = lambda ks, v, hour: [(f"k{k}", v, None, datetime(2025, 1, 1, hour)) for k in ks]
    add(spark, folders["a"], rows(range(0, 40), 1, 1))
    add(spark, folders["b"], rows(range(20, 60), 2, 5))
    streams = [runners.read_folder(spark, folders[n], schema_of(spark)) for n in ("a", "b")]
    done = state.pair_streams(*streams, "path", delay="1 hour", clock="at", groups=2)
    want = {(f"k{k}", 1, 1, 2) for k in range(20, 40)} | {(f"k{k}", 1, 1, None) for k in range(20)}

    def run():
        runners.drain_to_folder(done, folders["out"], done.schema)
        return [(r["key"], r["revision"], r["p_v"], r["f_v"]) for r in spark.read.schema(done.schema).parquet(folders["out"]).collect()]

    # The watermark is at four: of each group's lone records those of one o'clock are due, those of five wait.
    assert sorted(run(), key=str) == sorted(want, key=str)
    add(spark, folders["a"], rows(range(50, 60), 3, 6))
    add(spark, folders["b"], rows(range(0, 5), 4, 9))
    want |= {(f"k{k}", 1, 3, 2) for k in range(50, 60)} | {(f"k{k}", 2, 1, 4) for k in range(5)} | {(f"k{k}", 1, None, 2) for k in range(40, 50)}
    assert sorted(run(), key=str) == sorted(want, key=str)
    # State is read and written a group at a time.
    checkpoint = f"{folders['out']}/_checkpoint"
    assert spark.read.format("statestore").option("stateVarName", "held").load(checkpoint).count() == 2
