import random
import re

import numpy as np

from docrecords.llm import jaccard_join as jj


def brute(rows, width, percent):
    """The least id of each row's component, by comparing all pairs."""
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        words = re.findall(r"\S+", text)
        sets.append(frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))))

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                a_root, b_root = sorted((find(i), find(j)))
                parent[b_root] = a_root
    return [rows[find(i)][0] for i in range(len(rows))]


def corpus(seed):
    rng, rows = random.Random(seed), []
    for _ in range(14):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(4, 300))]
        for _ in range(9):
            text = list(base)
            for _ in range(rng.randrange(max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(99)}"
            rows.append((len(rows), " ".join(text + [f"foot{rng.randrange(9)}" for _ in range(rng.randrange(len(base) // 4 + 1))])))
    return rows


def test_any_width_and_percentage_equals_all_pairs(spark):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"block_bytes": 20_000, "block_sets": 15}, {"by_rarest": True}, {"by_rarest": True, "block_bytes": 20_000, "block_sets": 15}):
        got = {r.doc_id: r.component_id for r in jj.jaccard_classes(docs, words=5, percent=80, **options).collect()}
        assert [got[i] for i, _ in rows] == brute(rows, 5, 80) != brute(rows, 3, 90)


def test_five_words_and_80_percent_drop_scattered_edits_and_footers(spark):
    base = [f"w{i}" for i in range(500)]
    edited = [f"edit{i}" if i % 50 == 20 else w for i, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(edited)), (3, " ".join([*base, *(f"foot{i}" for i in range(90))])), (4, " ".join(f"v{i}" for i in range(500)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in jj.drop_near_copies(docs, words=5, percent=80).collect()) == [1, 4]
    assert len(jj.drop_near_copies(docs).collect()) == 4


def test_linked_sets_share_a_region_at_80_percent():
    rng = random.Random(4)
    for _ in range(2000):
        n = rng.randrange(2, 400)
        a = [rng.getrandbits(63) for _ in range(n)]
        b = a[rng.randrange(jj.changes(n, 80) + 1) :] + [rng.getrandbits(63) for _ in range(rng.randrange(jj.changes(n, 80) + 1))]
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common) and len(a) + len(b) > 2 * common:
            (x, ask_x), (y, ask_y) = jj.signatures(a, 80), jj.signatures(b, 80)
            assert set(x[ask_x].tolist()) & set(y.tolist()) | set(x.tolist()) & set(y[ask_y].tolist())


def test_linked_sets_share_a_rare_shingle():
    rng = random.Random(5)
    counts = np.array([rng.choice([2, 2, 3, 9]) for _ in range(jj.COUNTERS)], np.int32)
    linked = 0
    for _ in range(2000):
        n, percent = rng.randrange(1, 60), rng.choice([50, 80, 90])
        a = [rng.getrandbits(63) for _ in range(n)]
        b = a[rng.randrange(n // 4 + 1) :] + [rng.getrandbits(63) for _ in range(rng.randrange(n // 4 + 1))]
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common) and len(a) + len(b) > 2 * common:
            linked += 1
            assert len(np.intersect1d(jj.rarest(a, counts, percent), jj.rarest(b, counts, percent)))
    assert linked > 300
