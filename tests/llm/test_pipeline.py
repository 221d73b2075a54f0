import hashlib
import math
from collections import Counter

import pytest
from tests.llm.test_jaccard_join import brute

import corpus_pipeline as cp
from docrecords.llm import decontamination as dc
from docrecords.llm import packing as pk

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows of the documents and of each stage."""
    base, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    found.append(docs.collect())
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns or name == "packing"
        out.write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        found.append(docs.collect())
    return found


def test_quality_follows_the_labels(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    assert kept < {r.doc_id for r in stages[0]}
    right = sum((r.doc_id in kept) == labels[r.doc_id] for r in stages[0] if r.doc_id in labels)
    assert right >= 0.95 * sum(r.doc_id in labels for r in stages[0])


def test_one_document_of_each_component(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    want = {c for _, c in brute(rows, width=5, percent=80)}
    assert want < {c for _, c in brute(rows)}
    assert Counter(r.doc_id for r in stages[2]) == Counter(dict.fromkeys(want, 1))


def test_leaks_go_and_the_rest_stays(spark, stages):
    norm = lambda t: b" " + b" ".join(t.lower().encode().translate(dc._FOLD).split()) + b" "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in stages[2] if any(i in norm(r.text) for i in items)}
    gone = {r.doc_id for r in stages[2]} - {r.doc_id for r in stages[3]}
    assert len(gone & leaks) >= 0.9 * len(leaks) and len(gone - leaks) <= 1


def test_copies_follow_the_hash(stages):
    volume = Counter()
    for r in stages[3]:
        volume[r.source] += len(r.text)
    targets, total = {s: v**0.7 for s, v in volume.items()}, sum(volume.values())
    want = Counter()
    for r in stages[3]:
        rate = targets[r.source] / sum(targets.values()) * total / volume[r.source]
        u = (int(hashlib.md5(f"mix|{r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, sum_ = 0, math.exp(-rate)
        while u >= sum_:
            k += 1
            sum_ += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if k:
            want[r.doc_id] = k
    assert Counter(r.doc_id for r in stages[4]) == want


def test_packed_ids_are_the_texts(stages):
    import numpy as np
    import public_tokenizers

    encoding = pk.encoder(public_tokenizers.path(pk.VOCABULARY))
    want = Counter()
    for r in stages[4]:
        ids = [*encoding.encode_ordinary(r.text), encoding.n_vocab]
        want.update((r.doc_id, k // pk.LENGTH, tuple(ids[k : k + pk.LENGTH])) for k in range(0, len(ids), pk.LENGTH))
    got = Counter()
    for r in stages[5]:
        ids = np.frombuffer(r.input_ids, "<u2").tolist()
        got.update((d, p, tuple(ids[a:b])) for d, p, a, b in zip(r.doc_ids, r.doc_parts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True))
    assert got == want


def test_run_gives_the_rows_of_the_stages(spark, stages):
    assert cp.run(spark, SF).count() == len(stages[5])
