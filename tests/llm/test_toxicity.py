"""Toxicity models against plain counts, hard inputs, held-out labels."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docrecords.llm import toxicity as tox

ORDER, D = tox.ORDER, tox.DISCOUNT


def ratios(texts: list[tuple[list[str], int]]) -> dict[str, float]:
    """The ratio of every gram by the definition; classes are 1, 0, and -1 for texts that do not count."""
    pairs = {1: Counter(), 0: Counter()}
    every = set()
    for words, kind in texts:
        for w in set(words):
            marked = f"^{w}$"
            found = [marked[max(0, i - ORDER) : i] for i in range(2, len(marked) + 1)]
            every.update(found)
            if kind >= 0:
                pairs[kind].update(found)
    long = {g[-k:] for g in every for k in range(2, len(g) + 1)}
    before = Counter(x[1:] for x in long)
    after = defaultdict(list)
    for part, k in before.items():
        after[part[:-1]].append(k)

    def shared(part: str) -> float:
        below = shared(part[1:]) if len(part) > 1 else 1e-6
        total = sum(after[part[:-1]])
        return (before[part] - D) / total + D * len(after[part[:-1]]) / total * below

    def own(gram: str, kind: int) -> float:
        same = [n for g, n in pairs[kind].items() if g[:-1] == gram[:-1]]
        if not same:
            return shared(gram[1:])
        return max(pairs[kind][gram] - D, 0) / sum(same) + D * len(same) / sum(same) * shared(gram[1:])

    return {g: math.log(own(g, 1)) - math.log(own(g, 0)) for g in every}


def test_ratios_equal_plain_counts(spark):
    draw = random.Random(4)
    syllables = ["ba", "né", "ti", "ox", "s"]
    texts = [(["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.randint(0, 12))], draw.choice([1, 0, 0, -1])) for _ in range(60)]
    rows, classes, wanted = [], [], []
    for block in (0, 1):
        known = {}
        for at, (text, kind) in enumerate(texts[block::2]):
            rows.append((block, at, tox._packed(np.array([known.setdefault(w, len(known)) for w in text], np.int64))))
            classes += [(block, at, kind)] * (kind >= 0)
        rows.append((block, -1, zlib.compress("\n".join(known).encode())))
        wanted += [(block, g) for g in {g for w in known for g in tox.grams(w)}]
    blocks = spark.createDataFrame(rows, "block bigint, at bigint, data binary")
    found = tox.gram_ratios(blocks, spark.createDataFrame(wanted, "of bigint, gram string"), spark.createDataFrame(classes, "of bigint, place bigint, toxic int"))
    # Words of all texts shape the backoff; classes count those of the texts given.
    assert {r["gram"]: r["ratio"] for r in found.collect()} == pytest.approx(ratios(texts))


def test_packing_of_places():
    for places in ([], [0], [3, 70_000, 2**31, 3]):
        assert tox._unpacked(tox._packed(np.array(places, np.int64))).tolist() == places


def test_evidence():
    low, high = tox.FLOOR, tox.CEILING
    assert tox.evidence(np.zeros(0)) == [0.0] * 4
    assert tox.evidence(np.array([high + 5, low - 9])) == pytest.approx([(high - low) / 2, *[(high - low) / w for w in tox.WINDOWS]])
    long = np.zeros(1000)
    long[500:516] = high
    assert tox.evidence(long) == pytest.approx([0.016 * (high - low), high - low, (high - low) / 4, (high - low) / 16])


def scores(spark, docs, labels, kind="bigint"):
    found = tox.toxicity(spark.createDataFrame(docs, f"doc_id {kind}, text string"), spark.createDataFrame(labels, f"doc_id {kind}, toxic int"))
    return sorted(((r["doc_id"], r["score"]) for r in found.collect()), key=repr)


def test_hard_inputs(spark):
    assert scores(spark, [], []) == []
    docs = [(1, None), (1, ""), (None, "word"), (2, "§§ 12 --"), (3, "ä" * 200_000), (3, "ä" * 200_000), (4, "A\x00b " * 10)]
    assert [s for _, s in scores(spark, docs, [])] == [0.5] * 7
    assert [s for _, s in scores(spark, docs, [(1, 1), (2, 1), (2, 0), (None, 0)])] == [1.0] * 7
    assert {i for i, _ in scores(spark, [("d0", "a b"), (None, "c")], [("d0", 0)], "string")} == {"d0", None}


def test_learns_parts_of_rare_words(spark):
    """Insults share a beginning with those learnt, and are words of their own."""
    draw = random.Random(6)
    plain = ["".join(draw.choices(["ta", "ro", "mi", "sel", "un"], k=k)) for k in (2, 3, 4) for _ in range(150)]
    insults = [f"zgrum{''.join(draw.choices(['ta', 'ro', 'mi', 'sel'], k=3))}" for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        words = draw.choices(plain, k=80)
        toxic = i % 4 == 0
        for place in range(0, 80 if toxic else 0, 20):
            words[place] = draw.choice(insults)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    found = dict(scores(spark, docs, labels[:450]))
    assert all((found[i] >= 0.3) == bool(y) for i, y in labels[450:])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    done = tox.op13_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    done = done.filter("held_out").groupBy("toxic").agg(F.avg("predicted").alias("found"), F.count("*").alias("n"))
    share = {r["toxic"]: r["found"] for r in done.collect()}
    # 120 toxic texts, of which 4 hold none of the expressions of the others.
    assert share[1] >= 0.9 and share[0] <= 0.01
