import random

import numpy as np
import pyarrow as pa
import pytest

from docrecords.llm import decontamination as dc

SCHEMA = "doc_id long, text string, item long"


def prose(seed, n):
    rng = random.Random(seed)
    return [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bdgklmnrst')}{rng.choice('aeiouy')}{rng.randrange(9)}" for _ in range(n)]


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_words_equal_the_table():
    rng = random.Random(2)
    for _ in range(200):
        a, b = [[rng.choice("abcd") for _ in range(rng.randrange(1, 20))] for _ in range(2)]
        item = dc.Item.of(1, " ".join(a))
        assert dc.common_words(item.masks, len(a), dc.words_of(" ".join(b)).tolist()) == brute_common(a, b)


def test_decomposition_is_that_of_the_whole_matrix(spark):
    texts = [" ".join(prose(i % 7, 48)) for i in range(60)]
    hashed = dc.hashed_words(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3), "text")
    idf = dc.inverse_frequencies(hashed)
    latent = dc.decompose(hashed, idf)
    rows = np.concatenate(list(dc.passages([pa.RecordBatch.from_arrays([pa.array([dc.words_of(t).tobytes() for t in texts])], names=["w"])])))
    a = np.zeros((len(rows), dc.BINS + 1))
    for i, r in enumerate(rows):
        np.add.at(a[i], r, idf[r])
    left, singular, _ = np.linalg.svd(a, full_matrices=False)
    rank = int((singular > singular[0] * 1e-6).sum())
    assert rank == 7 == np.linalg.matrix_rank(latent)
    # Scaled latent rows are the left singular vectors, up to a rotation.
    scaled = np.array([latent[r].sum(0) for r in rows])
    assert scaled @ scaled.T == pytest.approx(left[:, :rank] @ left[:, :rank].T, abs=1e-3)


def test_paraphrases_answers_and_clean_documents(spark):
    items = [" ".join(prose(100 + i, 30)) + ". The answer is " + " ".join(prose(500 + i, 5)) + "." for i in range(20)]
    benchmark = spark.createDataFrame([*enumerate(items), (77, None), (78, ""), (None, items[0]), (3, items[3])], "item_id long, text string")
    pad = lambda i: prose(1000 + i, 200)
    docs, want = [], set()
    for i, text in enumerate(items):
        words = text.split()
        for k in range(0, len(words), 6):
            words[k] = "changed"
        docs.append((i, " ".join([*pad(i)[:90], *words, *pad(i)[90:]]), 0))
        want.add((i, i))
        docs.append((100 + i, " ".join([*pad(300 + i), *text.split()[:10]]), 0))
        half = text.split()
        half = [w if k % 9 < 5 or k >= 30 else "zzz" for k, w in enumerate(half)]
        docs.append((200 + i, " ".join([*pad(600 + i)[:50], *half, *pad(600 + i)[50:]]), 0))
        want.add((200 + i, i))
    docs += [(900, None, 0), (901, "", 0), (None, items[5], 0), (902, items[5].upper(), 0), (902, items[5].upper(), 0), (903, "long " * 60_000, 0)]
    want |= {(None, 5), (902, 5)}
    df = spark.createDataFrame(docs, SCHEMA)
    got = dc.find_leaks(df, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert sum(r.doc_id == 902 for r in got) == 2
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(df, benchmark, at_once=7).collect()} == want
    kept = dc.decontaminate(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*(100 + i for i in range(20)), 900, 901, 903])


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h i j", 0)], SCHEMA)
    assert dc.find_leaks(docs, items).collect() == [] and dc.find_leaks(some, items).collect() == []
    assert dc.decontaminate(docs, items).collect() == [] and dc.decontaminate(some, items).count() == 1
    assert dc.find_leaks(docs, spark.createDataFrame([(1, "a b c")], items.schema)).collect() == []


def test_recall_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    norm = lambda t: b" " + b" ".join(t.lower().encode().translate(dc._FOLD).split()) + b" "
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, q in items if q in norm(r.text)}
    got = {(r.doc_id, r.item_id) for r in dc.op9_decontamination(spark, sf).collect()}
    assert want and len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.02 * len(want) + 1
