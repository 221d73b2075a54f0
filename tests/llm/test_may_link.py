from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docrecords.llm import jaccard_join as jj
from tests.llm.test_near_copies import brute, corpus


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (3, 50), (1, 90), (2, 95)])
def test_all_sets_that_link_stay(spark, words, percent):
    rows = [*corpus(2), *((1000 + i, " ".join(f"own{i}.{j}" for j in range(400))) for i in range(20))]
    rows += [(1100, None), (1101, ""), (1102, "a"), (1103, "a b c d"), (1104, "a b c d"), (1105, "A b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.key for r in jj.may_link(docs, "text", words, percent).collect()}
    texts = [(i, t) for i, t in rows[:-6]]
    groups = Counter(found := brute(texts, words, percent))
    keys = [jj.set_key(jj.shingles(t, words)) for _, t in texts]
    differing = {c: len({k for k, g in zip(keys, found, strict=True) if g == c}) for c in groups}
    assert {k for k, c in zip(keys, found, strict=True) if differing[c] > 1} <= kept
    assert percent == 50 or not kept & set(keys[-20:])  # at 50 % a text of its own needs half of its shingles to be shared, too
    assert sum(differing[c] > 1 for c in groups) >= (5 if percent < 95 else 1)


def test_texts_of_their_own_are_not_joined_however_many_shingles_there_are(spark, monkeypatch):
    """Millions of shingles are some for each counter, which hides that passages of two texts are not their rarest; they fill chunks, too."""
    text = "concat_ws(' ', transform(sequence(1, IF(id = 48, 249000, 250000)), i -> concat(IF(i > 75000, concat('', id % 48), concat('p', id % 48 div 2)), 'x', i))) AS text"
    docs = spark.range(49, numPartitions=4).selectExpr("id AS doc_id", text)
    joined, join_sets = [], jj.join_sets
    monkeypatch.setattr(jj, "join_sets", lambda rows, *more: joined.append(rows.count()) or join_sets(rows, *more))
    got = {r.doc_id: r.component_id for r in jj.jaccard_classes(docs, words=5, percent=80, by_rarest=True).select("doc_id", "component_id").collect()}
    assert got == {i: i % 48 for i in range(49)}
    assert joined == [2]


def test_counters_take_a_byte_and_keep_the_order(spark):
    often = [1, 2, 63, 64, 90, 1000, 70_000]
    sets = spark.createDataFrame([(n, i.to_bytes(8, "little")) for i, n in enumerate(often)], "n int, data binary")
    data = sets.select(F.explode(F.sequence(F.lit(1), "n")), "data")
    counts = jj.shingle_counts(data)
    assert counts.nbytes == jj.COUNTERS and counts[: len(often)].tolist()[:4] == [1, 2, 63, 64]
    assert (np.diff(counts[: len(often)].astype(int)) > 0).all() and not counts[len(often) :].any()
