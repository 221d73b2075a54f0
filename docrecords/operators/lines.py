"""Line items as rows: numbering, running totals and the rules on lines, without arrays.

An order may hold a large share of all lines, so nothing here sorts or collects the lines of
one key in one task. Rows are sorted by range over (key, order); each task's part of a key is
numbered by itself, and parts of keys that begin in an earlier task get what came before them
added: an exclusive sum over parts, of which a key has at most as many as there are tasks.
More rows make more parts and not larger ones, so that the memory of a task stays the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrecords.session import kept

PART, PLACE = "_part", "_place"
#: Rows of a part, about; a task sorts and holds those of a few parts.
ROWS_TOGETHER = 100_000


def numbered(df: DataFrame, key: str, order: Sequence[str], name: str, totals: Mapping[str, str] | None = None) -> DataFrame:
    """The rows with ``name``, their number in their key's order from 1, and running totals.

    ``totals`` has a new column for each column to sum; NULL counts as 0, and values should be
    exact (integers or decimals), for sums are made in parts. Rows that are equal in ``order``
    are numbered in any order. A NULL key is a key like others. The sorted rows are written
    once to the shared folder.
    """
    totals = dict(totals or {})
    tasks = max(1, -(-df.count() // ROWS_TOGETHER))
    width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks)
    # A salt in the range spreads rows that are equal in key and order.
    by_range = df.repartitionByRange(width, key, *order, F.xxhash64(*df.columns)).sortWithinPartitions(key, *order)
    rows = kept(by_range.withColumns({PART: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}), "sorted-lines")
    values = {new: F.coalesce(F.col(old), F.lit(0)) for new, old in totals.items()}
    here = Window.partitionBy(PART, key).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A given number of partitions is not made smaller again to few large ones.
    inside = rows.repartition(tasks, PART, key).withColumns({name: F.row_number().over(here).cast("long")} | {new: F.sum(v).over(here) for new, v in values.items()})
    before = _before(rows, key, values, name)
    done = inside.join(F.broadcast(before), (F.col(PART) == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    sums = {c: F.col(c) + F.coalesce(F.col(f"_before_{c}"), F.lit(0)) for c in (name, *totals)}
    return done.withColumns(sums).select(*df.columns, name, *totals)


def _before(rows: DataFrame, key: str, values: Mapping[str, Column], name: str) -> DataFrame:
    """What precedes a key's part in other parts: one row for each key that goes on in a part.

    A part can only continue the key that the part before it ended with, so there are fewer
    such rows than parts, whatever the data.
    """
    parts = rows.groupBy(F.col(PART).alias("_of"), F.col(key).alias("_key"))
    parts = parts.agg(F.count("*").alias(name), *[F.sum(v).alias(new) for new, v in values.items()])
    # Keys of one part alone need nothing; those of several are fewer than twice the parts.
    several = parts.groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("_key").alias("_k"))
    parts = parts.join(F.broadcast(several), F.col("_key").eqNullSafe(F.col("_k")), "left_semi")
    earlier = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum(c).over(earlier).alias(f"_before_{c}") for c in (name, *values)]
    return parts.select("_of", "_key", *sums).filter(F.col(f"_before_{name}").isNotNull())


def line_violations(lines: DataFrame, headers: DataFrame | None = None, key: str = "source_file_path", tolerance: float = 0.01) -> DataFrame:
    """(key, rule, field, value) of lines that are rows: (key, position, the fields of a line item).

    ``line_sequence``: the number of a line is not its position, one row for each such line.
    ``line_total``: the total is not quantity times price. With ``headers`` (key,
    subtotalAmount) ``subtotal``: the lines do not add up to it; a header without lines has
    the sum 0. Lines are summed per key before they meet the headers.
    """
    field = lambda name: F.concat(F.lit("lineItems["), F.coalesce(F.col("lineNumber").cast("string"), F.lit("?")), F.lit(f"].{name}"))
    wrong = [
        (~F.col("lineNumber").cast("long").eqNullSafe(F.col("position")), "line_sequence", field("lineNumber"), F.col("lineNumber").cast("string")),
        (F.abs(F.col("lineTotal") - F.col("quantityShipped") * F.col("unitPrice")) > tolerance, "line_total", field("lineTotal"), F.col("lineTotal").cast("string")),
    ]
    each = [F.when(test, F.struct(F.lit(rule).alias("rule"), at.alias("field"), value.alias("value"))) for test, rule, at, value in wrong]
    found = lines.select(key, F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("v")).select(key, "v.*")
    if headers is None:
        return found
    sums = lines.groupBy(F.col(key).alias("_key")).agg(F.sum("lineTotal").alias("_sum"))
    joined = headers.join(sums, F.col(key) == F.col("_key"), "left")
    off = joined.filter(F.abs(F.col("subtotalAmount") - F.coalesce("_sum", F.lit(0.0))) > tolerance)
    return found.unionByName(off.select(key, F.lit("subtotal").alias("rule"), F.lit("subtotalAmount").alias("field"), F.col("subtotalAmount").cast("string").alias("value")))
