import math
from collections import Counter

import pytest

from docrecords.llm import mixing

SCHEMA = "doc_id long, text string, source string, copy string"


def rows_of(n=4000):
    return [(i, f"text {i:05d}", "hot" if i % 3 == 0 else f"s{i % 4}", "clash") for i in range(n)]


def test_shares_follow_the_weights(spark):
    docs = spark.createDataFrame(rows_of(), SCHEMA)
    got = Counter(r.source for r in mixing.mix(docs, {"hot": 1.0, "s0": 1.0, "s1": 2.0}).collect())
    assert set(got) == {"hot", "s0", "s1"}
    for name, share in (("hot", 0.25), ("s0", 0.25), ("s1", 0.5)):
        assert got[name] == pytest.approx(4000 * share, abs=5 * math.sqrt(4000))


def test_counts_are_poisson(spark):
    docs = spark.createDataFrame([(i, "abcd", "one") for i in range(5000)], "doc_id long, text string, source string")
    got = Counter(r.doc_id for r in mixing.mix(docs, total=2 * 4 * 5000).collect())
    times = Counter(got[i] for i in range(5000))
    for k in range(6):
        want = 5000 * math.exp(-2) * 2**k / math.factorial(k)
        assert times[k] == pytest.approx(want, abs=5 * math.sqrt(want))


def test_salted_join_and_shuffle_give_the_same(spark, rows):
    docs = spark.createDataFrame(rows_of(600), SCHEMA)
    a, b = mixing.mix(docs), mixing.mix(docs.repartition(5), broadcast_sources=0)
    assert rows(a) == rows(b) and a.columns == docs.columns
    ids = [r.doc_id for r in a.collect()]
    assert ids != sorted(ids) and sum(x > y for x, y in zip(ids, ids[1:])) > len(ids) / 4


def test_nulls_empties_repeats(spark):
    data = [(None, None, None, "x"), (None, "a", None, "x"), (1, "", "e", "x"), (2, "bb", "s", "x"), (2, "bb", "s", "x"), (3, "c" * 100_000, "s", "x")]
    docs = spark.createDataFrame(data, SCHEMA)
    got = [tuple(r) for r in mixing.mix(docs, total=10 * 100_005).collect()]
    assert Counter(g[:3] for g in got if g[0] == 2 and g[3] == 1)[(2, "bb", "s")] in (0, 2)
    assert {g[2] for g in got} <= {None, "e", "s"} and sum(g[0] == 3 for g in got) > 2
    assert mixing.mix(docs.limit(0)).collect() == []


@pytest.mark.parametrize("rate", [0.0, 0.3, 4.0, 900.0])
def test_distribution_function(spark, rate):
    want, total = [], 0.0
    for k in range(int(rate + 12 * math.sqrt(rate) + 30) + 1 if rate else 0):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        want.append(total)
    # Numbers between the steps of the distribution function, at its ends and evenly spread.
    numbers = [1e-12, 1 - 1e-6, *(k / 997 for k in range(1, 997)), *((a + b) / 2 for a, b in zip(want, want[1:]))]
    numbers = [u for u in numbers if 0 < u < 1 and all(abs(u - c) > 1e-9 for c in want)]
    rows = spark.createDataFrame([(rate, u) for u in numbers], "rate double, u double").selectExpr("u", f"{mixing.COUNT} AS n").collect()
    assert {r.u: r.n for r in rows} == {u: sum(c <= u for c in want) for u in numbers}
    assert rate == 0 or want[-1] == pytest.approx(1)


def test_a_source_of_little_text(spark):
    """A rate of many thousands neither grows an array nor the table of rates."""
    docs = spark.createDataFrame([(1, "ab", "tiny"), *((i, "word " * 2000, "large") for i in range(2, 12))], "doc_id long, text string, source string")
    got = Counter(r.doc_id for r in mixing.mix(docs, weights={"tiny": 1, "large": 1}).select("doc_id").collect())
    assert abs(got[1] - 25_000) < 5 * math.sqrt(25_000)
