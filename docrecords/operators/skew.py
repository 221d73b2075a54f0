"""Joins and numbering on keys of which one may hold a large share of all rows.

Everything here is lazy and made of built-in operations: no job runs while a plan is
built, nothing is written, and results and types do not depend on the data's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order``, NULLs last.

    Spark takes the first row of each key in every task before the shuffle, so a key
    with very many rows costs one row per task. Rows with a NULL in the key are all kept.
    """
    some_null = any_null(key)
    window = Window.partitionBy(*key).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    known = df.filter(~some_null).withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")
    return known.unionByName(df.filter(some_null))


def any_null(key: Sequence[str]) -> Column:
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    return null


def null_spread(df: DataFrame, key: Sequence[str]) -> Column:
    """0, or for rows with a NULL in the key a number that spreads them over tasks.

    NULL equals no key, so such rows may go anywhere. The number is the same when a
    task runs again; equal rows of different input partitions get different ones.
    """
    hashed = [c for c, kind in df.dtypes if c not in key and "variant" not in kind and "map<" not in kind]
    return F.when(any_null(key), F.xxhash64(F.spark_partition_id(), *hashed)).otherwise(F.lit(0).cast("long"))


def number_within(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each key from 1 in the given order."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def outer_join(
    left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "full", spread_nulls: bool = False
) -> DataFrame:
    """``left`` full or left outer join ``right`` on the columns ``key`` of both.

    Output: the key (from whichever side has it), the other columns of both sides, and
    the flags ``in_left`` and ``in_right``. The sides must share no other column. NULL
    keys match nothing and are kept as one-sided rows.

    An outer join cannot be split at run time on its null-supplying side, so both sides
    of a full join, and the right of a left join, should hold one row per key (see
    ``latest``). ``spread_nulls`` deals rows with NULL keys over all tasks; without it
    the join is on the key alone, so that tables bucketed by it are joined in place.
    """
    if how not in ("full", "left"):
        raise ValueError(f"unsupported join type: {how}")
    keys = [key] if isinstance(key, str) else list(key)
    columns = keys + [c for c in left.columns + right.columns if c not in keys]
    left = left.withColumn("_left", F.lit(True))
    right = right.withColumn("_right", F.lit(True))
    on = keys
    if spread_nulls:
        on = [*keys, "_spread"]
        left = left.withColumn("_spread", null_spread(left, keys))
        right = right.withColumn("_spread", null_spread(right, keys))
    joined = left.join(right, on, how)
    return joined.select(
        *columns,
        F.coalesce("_left", F.lit(False)).alias("in_left"),
        F.coalesce("_right", F.lit(False)).alias("in_right"),
    )
