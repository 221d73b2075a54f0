import random

import numpy as np
import pytest

from docrecords.llm import decontamination as dc
from tests.llm.test_decontamination import brute_common, prose


def planted(seed):
    """Items, and texts with 40 to 90 % of an item's words at any offset, some with its answer or two copies."""
    rng, common = random.Random(seed), prose(7, 40)
    fill = lambda s, n: [rng.choice(common) if rng.random() < 0.5 else w for w in prose(s, n)]
    items = [" ".join(fill(100 + i, rng.choice([5, 12, 20, 30, 60, 130]))) + (". " + " ".join(fill(900 + i, 6)) + "." if i % 2 else "") for i in range(24)]
    texts = []
    for k in range(240):
        words, host = items[k % 24].split(), fill(2000 + k, rng.choice([20, 90, 300, 2500]))
        share, answer = rng.choice([0.4, 0.5, 0.6, 0.7, 0.8, 0.9]), rng.random() < 0.5
        words = [w if rng.random() < share or (answer and j >= len(words) - 6) else host[j % len(host)] for j, w in enumerate(words)]
        at = rng.randrange(len(host))
        texts.append(" ".join([*host[:at], *words, *host[at:]]))
    return items, [*texts, "", "the", *items]


def leaks_of(words, items):
    """What the verifier accepts at any window, by item."""
    found = {}
    for item in items:
        hits = [c for w in range(max(1, -(-len(words) // dc.HALF) - 1)) for c, _, leak in [item.match(words, w)] if leak]
        if hits:
            found[item.number] = max(hits)
    return found


def recall(retriever, texts):
    """Leaks found and leaks there are; none may be found that the verifier does not accept."""
    found = there = 0
    for words, want in texts:
        got = {m["item"]: m["lcs_words"] for m in retriever.find(words)}
        assert got.keys() <= want.keys() and all(got[k] <= want[k] for k in got)
        found, there = found + len(got), there + len(want)
    return found, there


@pytest.fixture(scope="module")
def case(spark):
    items, texts = planted(3)
    hashed = dc.hashed_words(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text")
    items, words = [i for n, t in enumerate(items) if (i := dc.Item.of(str(n), t))], [dc.words_of(t) for t in texts]
    return dc.latent_space(hashed), items, [(w, leaks_of(w, items)) for w in words]


def test_the_cosine_finds_what_the_verifier_accepts(case):
    latent, items, texts = case
    found, there = recall(dc.Retriever(latent, items), texts)
    assert there > 120 and found >= 0.95 * there


def test_noise_in_the_latent_space_finds_nothing(case):
    latent, items, texts = case
    nothing = dc.Retriever(np.zeros_like(latent), items)
    assert recall(nothing, texts)[0] == 0
    noisy = dc.Retriever(latent, items)
    noisy.queries = np.random.default_rng(1).standard_normal(noisy.queries.shape).astype(np.float32)
    noisy.queries /= np.linalg.norm(noisy.queries, axis=0)
    found, there = recall(noisy, texts)
    assert found < 0.1 * there


def test_word_bags_only_discard(case):
    latent, items, texts = case
    retriever, every = dc.Retriever(latent, items), dc.Retriever(latent, items)
    every.bags.find = lambda words, first, last: ((w, k) for w in range(first, last) for k in range(len(items)))
    for words, _ in texts[::4]:
        one, two = ({m["item"]: (m["lcs_words"], m["first_word"]) for m in r.find(words)} for r in (retriever, every))
        assert one == two


def test_ids_of_any_type(spark):
    text = " ".join(prose(1, 30))
    docs = spark.createDataFrame([("d0", text, 1), (None, text, 2)], "doc_id string, text string, _body int")
    benchmark = spark.createDataFrame([("q-1", text), (None, text)], "item_id string, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, benchmark).collect()} == {("d0", "q-1"), (None, "q-1")}
    assert dc.decontaminate(docs, benchmark).count() == 0


@pytest.mark.parametrize("kept", [0.7, 0.8])
def test_paraphrases_among_other_words_are_leaks(spark, kept):
    rng = random.Random(5)
    items = [prose(100 + i, 37) for i in range(20)]
    docs = []
    for i, words in enumerate(items):
        stay = set(rng.sample(range(37), round(kept * 37 + 0.49)))
        words, host = [w if k in stay else f"other{i}x{k}" for k, w in enumerate(words)], prose(1000 + i, 200)
        docs += [(i * 24 + at, " ".join([*host[: 60 + at], *words, *host[60 + at :]])) for at in range(24)]
        assert brute_common(items[i], docs[-1][1].split()) >= 0.7 * 37
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, benchmark).collect()} == {(d, d // 24) for d in range(480)}


def test_two_texts_of_one_item_are_both_searched(spark):
    one, two = (" ".join(prose(s, 30)) for s in (1, 2))
    benchmark = spark.createDataFrame([(1, one), (1, two)], "item_id long, text string")
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, benchmark).collect()} == {(1, 1), (2, 1)}
