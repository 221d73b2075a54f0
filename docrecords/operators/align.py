"""Differences between two lists of line items, line by line.

Two lists are aligned in order at least cost: a pair of lines costs the number of fields in
which they differ, a line without a partner costs ``GAP``. So up to 2 * GAP differing fields
make a changed line, more make one removed and one added. Of alignments of equal cost the one
counts that, from the first line on, pairs lines rather than removes one, and removes rather
than adds.

Lists that are equal are told apart by built-in expressions and never reach Python. Of others
equal first and last lines are paired at once; what remains of n and m lines takes n * m cells
of one byte and as many steps, a row of cells at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrecords.schemas import LINE_ITEM

GAP = 2
PAIR, REMOVE, ADD = 0, 1, 2
CHANGES = "array<struct<status string, p_position int, f_position int, fields string>>"


def codes(left: Sequence[tuple], right: Sequence[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the values of each field; NULLs equal each other."""
    width = len(LINE_ITEM.fields)
    out = np.zeros((len(left) + len(right), width), np.int64)
    for f in range(width):
        known: dict = {}
        for i, line in enumerate([*left, *right]):
            out[i, f] = known.setdefault(line[f], len(known))
    return out[: len(left)], out[len(left) :]


def steps(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, int]]:
    """(step, place on the left, place on the right) of the chosen alignment."""
    n, m = len(left), len(right)
    head = 0
    while head < min(n, m) and (left[head] == right[head]).all():
        head += 1
    tail = 0
    while tail < min(n, m) - head and (left[n - 1 - tail] == right[m - 1 - tail]).all():
        tail += 1
    a, b = left[head : n - tail], right[head : m - tail]
    best = np.zeros((len(a), len(b) + 1), np.uint8)
    ahead = GAP * np.arange(len(b), -1, -1)
    lanes = GAP * np.arange(len(b) + 1)
    for i in range(len(a) - 1, -1, -1):
        pair = np.append((b != a[i]).sum(1) + ahead[1:], np.iinfo(np.int64).max)
        without = ahead + GAP
        either = np.minimum(pair, without)
        now = np.minimum.accumulate((either + lanes)[::-1])[::-1] - lanes
        best[i] = np.where(now == pair, PAIR, np.where(now == without, REMOVE, ADD))
        ahead = now
    found = [(PAIR, k, k) for k in range(head)]
    i = j = 0
    while i < len(a) or j < len(b):
        step = ADD if i == len(a) else int(best[i, j])
        found.append((step, head + i, head + j))
        i, j = i + (step != ADD), j + (step != REMOVE)
    return found + [(PAIR, n - k, m - k) for k in range(tail, 0, -1)]


def changes(left: Sequence[tuple], right: Sequence[tuple]) -> list[tuple]:
    """(status, position on the left, on the right, differing fields) of lines that are not equal."""
    x, y = codes(left, right)
    names, found = LINE_ITEM.fieldNames(), []
    for step, i, j in steps(x, y):
        if step == REMOVE:
            found.append(("removed", i, None, None))
        elif step == ADD:
            found.append(("added", None, j, None))
        elif (x[i] != y[j]).any():
            found.append(("changed", i, j, ",".join(n for n, off in zip(names, x[i] != y[j], strict=True) if off)))
    return found


def line_changes(pairs: DataFrame, key: str = "key", left: str = "p_line_items", right: str = "f_line_items") -> DataFrame:
    """(key, status, p_position, f_position, fields): one row for each line that is not equal.

    ``pairs`` has two arrays of line items; NULL is a list without lines. Positions are from 0,
    ``fields`` names what differs in a changed line. Repeated keys are compared each for itself.
    """
    names = LINE_ITEM.fieldNames()

    def lines(items) -> list[tuple]:
        return [] if items is None else [tuple(None if x is None else x[n] for n in names) for x in items]

    @F.pandas_udf(CHANGES)
    def compare(p: pd.Series, f: pd.Series) -> pd.Series:
        out = [[dict(zip(("status", "p_position", "f_position", "fields"), c, strict=True)) for c in changes(lines(a), lines(b))] for a, b in zip(p, f, strict=True)]
        return pd.Series(out, dtype=object)

    none = F.array().cast("array<" + LINE_ITEM.simpleString() + ">")
    sides = pairs.select(key, *[F.coalesce(F.col(c), none).alias(n) for c, n in ((left, "_p"), (right, "_f"))])
    differing = sides.filter(~F.col("_p").eqNullSafe(F.col("_f")))
    found = differing.withColumn("_changes", compare("_p", "_f")).select(key, F.explode("_changes").alias("_c"))
    return found.select(key, "_c.*")


def change_counts(found: DataFrame, key: str = "key") -> DataFrame:
    """(key, n_changed, n_removed, n_added) of the files with any."""
    kinds = ("changed", "removed", "added")
    return found.groupBy(key).agg(*[F.count_if(F.col("status") == k).alias(f"n_{k}") for k in kinds])
