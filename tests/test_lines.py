"""Numbering and running totals of lines across tasks."""

import random
from itertools import groupby

from docrecords.operators import lines


def test_numbers_and_totals_across_tasks(spark):
    draw = random.Random(3)
    rows = [(draw.choice([0, 0, 0, None, None, *range(1, 9)]), draw.choice([None, *range(500)]), i, draw.choice([None, 1, 5])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, a int, i int, v bigint")
    got = lines.numbered(df, "k", ["a", "i"], "n", {"total": "v", "ones": "v"})
    assert got.columns == ["k", "a", "i", "v", "n", "total", "ones"]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2])
    want = set()
    for _, group in groupby(sorted(rows, key=order), key=lambda r: r[0]):
        total = 0
        for n, (k, a, i, v) in enumerate(group, 1):
            total += v or 0
            want.add((k, a, i, v, n, total, total))
    assert {tuple(r) for r in got.collect()} == want


def test_equal_lines_are_spread_and_numbered(spark):
    df = spark.sql("select 7 as k, 1 as a, 2L as v from range(1000)")
    got = lines.numbered(df, "k", ["a"], "n", {"total": "v"}).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 1001)) and all(r["total"] == 2 * r["n"] for r in got)


def test_a_crowded_key_is_split(spark, plan):
    df = spark.sql("select if(id % 3 = 0, 0, id) as k, id as a from range(3000)")
    text = plan(lines.numbered(df, "k", ["a"], "n"))
    assert "hashpartitioning(_part" in text and "hashpartitioning(k#" not in text


def test_violations_of_rows(spark):
    schema = "source_file_path string, position bigint, lineNumber int, quantityShipped double, unitPrice double, lineTotal double"
    rows = [("a", 1, 1, 2.0, 3.0, 6.0), ("a", 2, 3, 1.0, 1.0, 5.0), ("a", 3, None, None, 1.0, None), ("b", 1, 1, 1.0, 1.0, 1.0)]
    heads = spark.createDataFrame([("a", 11.0), ("b", 2.0), ("c", 0.0), ("d", None), ("e", 3.0)], "source_file_path string, subtotalAmount double")
    found = lines.line_violations(spark.createDataFrame(rows, schema), heads)
    assert {tuple(r) for r in found.collect()} == {
        ("a", "line_sequence", "lineItems[3].lineNumber", "3"), ("a", "line_sequence", "lineItems[?].lineNumber", None),
        ("a", "line_total", "lineItems[3].lineTotal", "5.0"), ("b", "subtotal", "subtotalAmount", "2.0"), ("e", "subtotal", "subtotalAmount", "3.0"),
    }


def test_parts_grow_in_number_and_not_in_size(spark, plan, monkeypatch):
    monkeypatch.setattr(lines, "ROWS_TOGETHER", 100)
    df = spark.sql("select if(id % 3 = 0, 0, id) as k, id as a, 1L as v from range(3000)")
    got = lines.numbered(df, "k", ["a"], "n", {"total": "v"})
    assert "hashpartitioning(_part" in plan(got) and ", 30)" in plan(got)
    assert sorted(r["n"] for r in got.filter("k = 0").collect()) == list(range(1, 1001))
    assert got.filter("n <> total or (k <> 0 and n <> 1)").count() == 0
