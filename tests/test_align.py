"""Alignment of line items against all alignments."""

import random
import time
from functools import cache

import numpy as np
from docrecords.operators import align
from docrecords.schemas import LINE_ITEM

WIDTH = len(LINE_ITEM.fields)


def plain(left, right):
    """The steps by the definition: least cost, then pair before remove before add from the front."""

    @cache
    def best(i, j):
        options = []
        if i < len(left) and j < len(right):
            options.append((sum(x != y for x, y in zip(left[i], right[j])) + best(i + 1, j + 1)[0], align.PAIR))
        if i < len(left):
            options.append((align.GAP + best(i + 1, j)[0], align.REMOVE))
        if j < len(right):
            options.append((align.GAP + best(i, j + 1)[0], align.ADD))
        return min(options) if options else (0, None)

    found, i, j = [], 0, 0
    while (step := best(i, j)[1]) is not None:
        found.append((step, i, j))
        i, j = i + (step != align.ADD), j + (step != align.REMOVE)
    return best(0, 0)[0], found


def cost(left, right, found):
    return sum(align.GAP if s != align.PAIR else sum(x != y for x, y in zip(left[i], right[j])) for s, i, j in found)


def test_least_cost_and_order():
    draw = random.Random(1)
    for _ in range(400):
        line = lambda: tuple(draw.choice([None, 1, 2]) if f < 5 else 0 for f in range(WIDTH))
        left = [line() for _ in range(draw.randint(0, 7))]
        right = [line() if draw.random() < 0.3 else x for x in left if draw.random() < 0.8] + [line() for _ in range(draw.randint(0, 2))]
        found = align.steps(*align.codes(left, right))
        least, chosen = plain(tuple(left), tuple(right))
        assert cost(left, right, found) == least
        assert [s for s, _, _ in found].count(align.PAIR) + [s for s, _, _ in found].count(align.REMOVE) == len(left)
        # Where no first or last lines are equal the rule for ties is met step by step.
        if left and right and left[0] != right[0] and left[-1] != right[-1]:
            assert found == chosen


def test_statuses():
    one, two = (1, "P1", "BOX", 1.0, 0.0, 2.0, 2.0), (2, "P2", "BOX", 1.0, 0.0, 3.0, 3.0)
    other = (2, "P9", "EACH", 7.0, 1.0, 4.0, 28.0)
    assert align.changes([one, two], [one, two]) == []
    assert align.changes([one, two], [one]) == [("removed", 1, None, None)]
    assert align.changes([], [one]) == [("added", None, 0, None)]
    assert align.changes([one, two], [one, (2, "P2", None, 1.0, 0.0, 3.0, 4.0)]) == [("changed", 1, 1, "uom,lineTotal")]
    assert align.changes([two], [other]) == [("removed", 0, None, None), ("added", None, 0, None)]


def test_long_lists():
    left = np.arange(3000)[:, None].repeat(WIDTH, 1)
    right = np.delete(left, [5, 1500], 0)
    right[2000, 0] = -1
    start = time.time()
    found = align.steps(left, right)
    assert time.time() - start < 20
    assert [(s, i) for s, i, _ in found if s == align.REMOVE] == [(align.REMOVE, 5), (align.REMOVE, 1500)]


def test_rows(spark):
    kind = f"array<{LINE_ITEM.simpleString()}>"
    a = [(1, "P1", "BOX", 1.0, 0.0, 2.0, 2.0)]
    b = [(1, "P1", "BOX", 1.0, 0.0, 2.0, 9.0)]
    rows = [("same", a, a), ("changed", a, b), ("none", None, None), ("left", a, None), ("right", None, b), ("empty", [], None), (None, [None], a)]
    found = align.line_changes(spark.createDataFrame(rows, f"key string, p_line_items {kind}, f_line_items {kind}"))
    assert {tuple(r) for r in found.collect()} == {
        ("changed", "changed", 0, 0, "lineTotal"), ("left", "removed", 0, None, None), ("right", "added", None, 0, None),
        (None, "removed", 0, None, None), (None, "added", None, 0, None),
    }
    counts = {r["key"]: (r["n_changed"], r["n_removed"], r["n_added"]) for r in align.change_counts(found).collect()}
    assert counts["changed"] == (1, 0, 0) and counts[None] == (0, 1, 1)
