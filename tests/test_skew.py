"""Joins and numbering on keys that hold much of the data."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docrecords.operators import quality
from docrecords.operators.merge import pair_sources
from docrecords.operators.skew import latest, number_within, outer_join


def bag(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'hot' holds a third of the rows, many of them exact copies."""
    ids = spark.range(3000)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))
    )
    return ids.select(key.alias("key"), (F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b")).repartition(4)


def test_number_within(skewed):
    numbered = number_within(skewed, "key", ["a", "b"], "rn")
    assert numbered.schema["rn"].dataType.simpleString() == "bigint"
    hot = numbered.filter("key = 'hot'").orderBy("rn").collect()
    assert [r["rn"] for r in hot] == list(range(1, 1001))
    assert [(r["a"], r["b"]) for r in hot] == sorted((r["a"], r["b"]) for r in hot)


def test_latest_keeps_one_row_per_key_and_all_without_one(skewed, plan):
    rows = skewed.collect()
    best = {}
    for r in rows:
        if r.key is not None:
            best[r.key] = max((r.a, r.b), best.get(r.key, (-1, -1)))
    found = latest(skewed, ["key"], ["a", "b"])
    got = found.collect()
    assert {r.key: (r.a, r.b) for r in got if r.key} == best
    assert len(got) == len(best) + sum(r.key is None for r in rows)
    # Each task keeps one row of a hot key before the shuffle.
    assert plan(found).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("how", ["full", "left"])
@pytest.mark.parametrize("spread", [False, True])
def test_outer_join(spark, skewed, how, spread):
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3), ("zzz", 4), (None, 5), (None, 5)], "key string, c int")
    joined = outer_join(skewed, right, "key", how, spread_nulls=spread)
    assert joined.columns == ["key", "a", "b", "c", "in_left", "in_right"]
    plain = skewed.alias("l").join(right.alias("r"), F.col("l.key") == F.col("r.key"), how)
    wanted = Counter(tuple(r) for r in plain.select(F.coalesce("l.key", "r.key"), "l.a", "l.b", "r.c").collect())
    assert bag(joined, ["key", "a", "b", "c"]) == wanted
    assert joined.filter("in_left and key is null").count() == skewed.filter("key is null").count()


def test_equal_rows_without_a_key_are_spread(spark):
    same = spark.range(0, 1000, 1, 8).select(F.lit(None).cast("string").alias("key"), F.lit(1).alias("a"), F.array(F.lit(2)).alias("n"))
    other = same.select("key", F.col("a").alias("c"))
    joined = outer_join(same, other, "key", spread_nulls=True)
    assert joined.count() == 2000
    from docrecords.operators.skew import null_spread

    assert same.select(null_spread(same, ["key"])).distinct().count() == 8


def test_joins_on_several_columns(spark):
    left = spark.createDataFrame([("p", 1, "a"), ("p", 2, "b"), (None, 1, "c")], "path string, t int, x string")
    right = spark.createDataFrame([("p", 2, "d"), ("q", 1, "e"), (None, 1, "f")], "path string, t int, y string")
    got = bag(outer_join(left, right, ["path", "t"]), ["path", "t", "x", "y"])
    assert got == Counter([("p", 1, "a", None), ("p", 2, "b", "d"), ("q", 1, None, "e"), (None, 1, "c", None), (None, 1, None, "f")])


def test_versions_of_a_file_do_not_multiply(skewed):
    pairs = pair_sources(skewed, skewed, "key", ["a", "b"], version=["a", "b"])
    named = pairs.filter("key is not null")
    assert named.count() == named.select("key").distinct().count()
    assert named.filter("p_a <> f_a or p_b <> f_b").count() == 0


def test_a_view_follows_its_tables(spark):
    schema, name = "key string, a int", f"left_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([("hot", 1)] * 500, schema).write.saveAsTable(name)
    right = spark.createDataFrame([("hot", 1)], "key string, c int")
    outer_join(spark.table(name), right, "key").createOrReplaceTempView("joined_view")
    assert spark.table("joined_view").count() == 500
    spark.createDataFrame([("hot", 2), ("new", 3)], schema).write.mode("append").saveAsTable(name)
    assert spark.table("joined_view").count() == 502


def test_coverage_counts_pairs_without_making_them(skewed):
    other = skewed.limit(500).checkpoint()
    status = {r[0]: r[1] for r in quality.coverage_status(skewed, other, key="key").collect()}
    joined = skewed.alias("l").join(other.alias("r"), F.col("l.key") == F.col("r.key"), "full")
    wanted = Counter(
        "BOTH" if r[0] is not None and r[1] is not None else ("AI_ONLY" if r[2] is not None else "OCR_ONLY")
        for r in joined.select("l.key", "r.key", "l.a").collect()
    )
    assert status == dict(wanted)
