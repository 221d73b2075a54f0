import zlib

import numpy as np
import pytest

from docrecords.llm import quality_model as qm

SCHEMA = "doc_id long, text string, score string"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in qm.op6_quality_model(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = {d: q for d, q in labels.items() if zlib.crc32(str(d).encode()) % 5 == 0}
    assert all(got[d].held_out == (d in held) for d in labels)
    right = sum(got[d].predicted == q for d, q in held.items())
    assert right / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_flat_arrays_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(qm.FEATURES)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(np.int64)
    forest = qm.train(x, y)

    def walk(row):
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert forest.score(x) == pytest.approx([walk(r) for r in x])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.95


def test_edge_texts_and_missing_labels(spark):
    texts = [None, "", " \n", "a", "!!! ### $$$", "long " * 50_000, "\U0001f600é"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "b", "x"), (0, None, "x")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = qm.score(docs, qm.fit(docs, none)).collect()
    assert len(rows) == 9 and {r.score for r in rows} == {0.5}
    one = spark.createDataFrame([(1, 1), (3, 1), (3, 0), (None, 0), (4, None)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in qm.score(docs, qm.fit(docs, one)).collect())
    both = spark.createDataFrame([(1, 1), (3, 1), (4, 0)], "doc_id long, quality int")
    assert qm.score(docs, qm.fit(docs, both)).count() == 9
    assert qm.score(docs.limit(0), qm.fit(docs, both)).collect() == []
    assert np.isfinite([qm.statistics(t or "") for t in texts]).all()


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in range(50)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    a, b = qm.fit(docs, labels, most=20), qm.fit(docs.orderBy("text"), labels, most=20)
    assert np.array_equal(a.leaf, b.leaf) and np.array_equal(a.threshold, b.threshold)
