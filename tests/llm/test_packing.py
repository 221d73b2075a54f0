import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docrecords.llm import packing as pk


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_decreasing_equals_a_plain_search(lengths):
    rows = pk.best_fit_decreasing(np.array(lengths, np.int64), 40)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(40 - n)
    assert sorted(40 - sum(lengths[i] for i in r) for r in rows) == sorted(rooms)


def test_round_trip(spark, tmp_path):
    texts = [None, "", "a", "Some text. <|endoftext|> é日本", "w " * 5000, "xyz " * 300, "tail"]
    rows = [(i, t, b"x") for i, t in enumerate(texts)] + [(None, "no id", None), (6, "tail", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, input_ids binary")
    root = str(tmp_path / "packed")
    manifest = pk.write_packed(docs, root, length=64)
    encoding = pk.encoder(public_tokenizers.path(pk.VOCABULARY))
    found = {}
    got = pk.read_packed(manifest, root, length=64).collect()
    for r in got:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert r.position_resets == r.cu_seqlens[:-1] and (ids[r.n_tokens :] == encoding.n_vocab).all()
        for doc, part, a, b in zip(r.doc_ids, r.doc_parts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            found.setdefault(doc, []).append((part, tuple(ids[a:b])))
    for i, t in [*enumerate(texts), (None, "no id")]:
        want = [*encoding.encode_ordinary(t or ""), encoding.n_vocab]
        times = 2 if i == 6 else 1
        assert sorted(found[i]) == sorted([(k, tuple(want[k * 64 : k * 64 + 64])) for k in range(-(-len(want) // 64))] * times)
    assert not (tmp_path / "packed" / "_temporary").exists()


def test_blocks_and_rolling_lose_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 90)) for i in range(400)], "doc_id long, text string").coalesce(1)
    root = str(tmp_path / "p")
    manifest = pk.write_packed(docs, root, length=128, file_bytes=5000, block_ids=4000)
    assert manifest.count() > 4
    got = pk.read_packed(manifest, root, length=128).collect()
    assert {d for r in got for d in r.doc_ids} == set(range(400))
    assert sum(r.n_tokens for r in got) / (128 * len(got)) > 0.9


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    root = str(tmp_path / "p")
    assert pk.read_packed(pk.write_packed(docs, root), root).collect() == []


def test_given_documents(spark, sf_dir):
    rows = pk.op3_packing(spark, sf_dir).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {d for r in rows for d in r.doc_ids} == ids
    assert sum(r.n_tokens for r in rows) / (pk.LENGTH * len(rows)) == pytest.approx(1, abs=0.05)
