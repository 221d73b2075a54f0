import random
import re
from collections import Counter

import numpy as np
import pytest

from docrecords.llm import jaccard_join as jj
from docrecords.llm.components import components

SCHEMA = "doc_id long, text string, key string"


def brute(rows, width=3, percent=90):
    """(number of shingles, component) of each row, by comparing all pairs."""
    sets, parent = [], list(range(len(rows)))
    for _, text, *_ in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append(frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset())

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(len(sets[i]), least.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def corpus(seed, bases=12, copies=12, words=(3, 160)):
    rng, rows = random.Random(seed), []
    for b in range(bases):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(*words))]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                k = rng.randrange(len(text))
                text[k : k + rng.randrange(2)] = [f"x{rng.randrange(99)}"] * rng.randrange(2)
                text = text or ["w"]
            rows.append((len(rows), " ".join(text).title() if rng.random() < 0.2 else " ".join(text), "k"))
    rng.shuffle(rows)
    return rows


def check(spark, rows, **options):
    got = jj.jaccard_classes(spark.createDataFrame(rows, SCHEMA), **options).collect()
    want = Counter((r[0], *w) for r, w in zip(rows, brute(rows), strict=True))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    check(spark, corpus(seed))


def test_small_sets_chains_nulls_and_repeats(spark):
    base = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(base[8 * i : 8 * i + 150]), "c") for i in range(12)]
    small = [(100 + i, " ".join(f"s{j}" for j in range(i)), "c") for i in range(16)] + [(130 + i, " ".join(f"s{j}" for j in range(i)) + " z", "c") for i in range(16)]
    odd = [(200, None, None), (201, "", None), (202, " \n", None), (None, base[0], None), (None, None, None), (203, "a b c d", None), (203, "a b c d", None), (204, "A B\tC\nD", None), (None, "a b c d", None), (205, "É b c", None), (206, "é b c", None)]
    check(spark, chain + small + odd)


def test_large_blocks_are_cut(spark):
    rows = corpus(5, bases=3, copies=80, words=(60, 120))
    check(spark, rows, block_bytes=20_000, block_sets=15)
    check(spark, rows, block_bytes=60_000)


def test_block_join_equals_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 200, dtype=np.uint64)
    sets = []
    for i in range(400):
        s = base.copy() if i % 3 else rng.integers(0, 1 << 60, 150, dtype=np.uint64)
        n = int(rng.integers(0, 40))
        s[rng.choice(len(s), n, replace=False)] = rng.integers(0, 1 << 60, n, dtype=np.uint64)
        sets.append(np.unique(s))
    join = jj.Block(sets)
    join.join(np.arange(len(sets)))
    plain = list(range(len(sets)))
    find = lambda i: i if plain[i] == i else find(plain[i])
    frozen = [frozenset(s.tolist()) for s in sets]
    for i, a in enumerate(frozen):
        for j in range(i):
            if 100 * len(a & frozen[j]) >= 90 * len(a | frozen[j]):
                plain[find(i)] = find(j)
    pairs = {(find(i), int(join.root[i])) for i in range(len(sets))}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_linked_sets_share_a_region():
    rng = random.Random(4)
    for _ in range(3000):
        n = rng.randrange(9, 400)
        a = [rng.getrandbits(63) for _ in range(n)]
        drop = rng.randrange(jj.changes(n) + 1)
        b = a[drop:] + [rng.getrandbits(63) for _ in range(rng.randrange(jj.changes(n) + 1))]
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 90 * (len(a) + len(b) - common):
            (x, ask_x), (y, ask_y) = jj.signatures(a), jj.signatures(b)
            shared = set(x[ask_x].tolist()) & set(y.tolist()) | set(x.tolist()) & set(y[ask_y].tolist())
            assert shared


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(5, 5), (1, 0), (None, 3)]
    parent = {v: v for e in edges for v in e if v is not None}
    find = lambda v: v if parent[v] == v else find(parent[v])
    for a, b in edges:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {v for a, b in edges if a is not None and a != b for v in (a, b)}
    assert got == {v: find(v) for v in linked}


def test_one_document_of_each_component_stays(spark):
    rows = corpus(9) + [(None, None, None), (900, "", "k"), (900, "", "k"), (901, "p q r s", "k"), (901, "p q r s", "k"), (None, "p q r s", "k")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = jj.drop_near_copies(docs)
    got = kept.collect()
    want = brute(rows)
    groups = {c for n, c in want if n}
    assert kept.columns == docs.columns and len(got) == len(groups) + 3
    assert {r.doc_id for r in got if (r.text or "").strip()} == groups


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jj.jaccard_classes(docs).collect() == [] and jj.drop_near_copies(docs).collect() == []
