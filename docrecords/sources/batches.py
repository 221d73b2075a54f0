"""Tables of days that are written in batches, each of which counts once.

A batch number belongs to a day: the day's first batch is 1, the next one 2, and so on. The
batches of a call lie together in one folder for each destination, sorted by day, so that
files are as many as the data needs and not as there are days. The folder is named after the
days and their numbers (``slice``). Writing overwrites it (dynamic partition overwrite), and
then one small append to the commit table says which days' rows of which attempt count.
Whatever a writer leaves behind when it is killed between these steps is of an attempt that
is not committed: readers of ``committed`` never see it, and the next run, which finds the same
days pending, writes the same folder over.

The commit table has one row per destination, day and batch with its number of rows. A batch
committed with ``replace`` takes the place of all earlier batches of its day. Tables that were
made with a folder for each destination, day and batch keep them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.sources.tables import conform, create_empty, table_exists

PARTITIONS = ("destination", "process_date", "batch")
FOLDERS = ("destination", "slice")
COMMITS = T.StructType(
    [
        T.StructField("destination", T.StringType()),
        T.StructField("process_date", T.DateType()),
        T.StructField("batch", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("replaces", T.BooleanType()),
        T.StructField("attempt", T.StringType()),
    ]
)
#: Called between writing a batch and committing it.
Hook = Callable[[Sequence[date | None]], None]


def commits_of(name: str) -> str:
    return f"{name}_commits"


def create(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None) -> None:
    """The table and its commit table, empty, unless they exist. ``schema`` has no batch."""
    if not table_exists(spark, name):
        more = [T.StructField("attempt", T.StringType()), T.StructField("batch", T.IntegerType()), T.StructField("slice", T.StringType())]
        create_empty(spark, name, T.StructType([*schema.fields, *more]), FOLDERS, location)
    if not table_exists(spark, commits_of(name)):
        create_empty(spark, commits_of(name), COMMITS, (), location)


def commits(spark: SparkSession, name: str) -> DataFrame:
    """The batches that count, one row each; NULL days are a day of their own."""
    return _counted(spark, name).select(*PARTITIONS, "n_rows")


def _counted(spark: SparkSession, name: str) -> DataFrame:
    log = spark.table(commits_of(name))
    since = log.groupBy("process_date").agg(F.coalesce(F.max(F.when(F.col("replaces"), F.col("batch"))), F.lit(0)).alias("_since"))
    since = since.withColumnRenamed("process_date", "_day")
    counted = log.join(since, F.col("process_date").eqNullSafe(F.col("_day"))).filter("batch >= _since")
    # A commit that was appended twice is one commit.
    return counted.drop("_day", "_since", "replaces").distinct()


def committed(spark: SparkSession, name: str) -> DataFrame:
    """The rows of committed batches, without the batch number and the attempt."""
    found, counted = spark.table(name), _counted(spark, name)
    # In folders of days a committed folder holds one attempt, and older commit tables do not name it.
    keys = [c for c in (*PARTITIONS, "attempt") if c in counted.columns]
    wanted = counted.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return found.join(wanted, same, "left_semi").drop("batch", "attempt", "slice")


def write_days(
    rows: DataFrame,
    name: str,
    schema: T.StructType,
    days: Sequence[date | None],
    replace: bool = False,
    before_commit: Hook | None = None,
) -> None:
    """Write the next batch of each of these days, and commit them together.

    ``rows`` holds rows of these days only. The days reach the driver, their rows do not.
    """
    spark = rows.sparkSession
    create(spark, name, schema)
    listed = spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField("_day", T.DateType())]))
    last = spark.table(commits_of(name)).groupBy("process_date").agg(F.max("batch").alias("_last"))
    numbers = listed.join(last, F.col("_day").eqNullSafe(F.col("process_date")), "left")
    # One row of a few bytes for each day of a calendar.
    numbers = {r["_day"]: (r["_last"] or 0) + 1 for r in numbers.select("_day", "_last").collect()}
    numbered = spark.createDataFrame(list(numbers.items()), T.StructType([T.StructField("_day", T.DateType()), T.StructField("batch", T.IntegerType())]))
    out = conform(rows, schema).join(F.broadcast(numbered), F.col("process_date").eqNullSafe(F.col("_day"))).drop("_day")
    attempt, folder = uuid.uuid4().hex, _slice_of(numbers)
    out = out.withColumns({"attempt": F.lit(attempt), "slice": F.lit(folder)}).select(*spark.table(name).columns)
    # By day as well, so that a destination is written by many tasks and a day lies in few files.
    out = out.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    if "slice" in out.columns:
        out = out.sortWithinPartitions(*FOLDERS, "process_date")
    with _dynamic_overwrite(spark):
        out.write.mode("overwrite").insertInto(name)
    if before_commit is not None:
        before_commit(days)
    _commit(spark, name, numbered, attempt, folder, replace)


def _slice_of(numbers: dict[date | None, int]) -> str:
    """A name for these batches of these days, the same in each attempt at them."""
    text = ",".join(sorted(f"{day}:{batch}" for day, batch in numbers.items()))
    return hashlib.md5(text.encode()).hexdigest()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserting into a table takes the mode from the session, not from the writer."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _commit(spark: SparkSession, name: str, numbered: DataFrame, attempt: str, folder: str, replace: bool) -> None:
    """Count what this attempt wrote, and append the counts in one file.

    Folders that another attempt at the same batches left, and this one has no rows for, are
    not counted and so stay unseen.
    """
    spark.catalog.refreshTable(name)
    mine = F.col("process_date").eqNullSafe(F.col("_day")) & (F.col("batch") == F.col("_batch"))
    written = spark.table(name).filter(F.col("attempt") == attempt)
    if "slice" in written.columns:
        written = written.filter(F.col("slice") == folder)
    written = written.join(F.broadcast(numbered.withColumnRenamed("batch", "_batch")), mine)
    counts = written.groupBy(*PARTITIONS).agg(F.count("*").alias("n_rows")).withColumns({"replaces": F.lit(replace), "attempt": F.lit(attempt)})
    columns = spark.table(commits_of(name)).columns
    counts.select(*columns).coalesce(1).write.mode("append").insertInto(commits_of(name))
    spark.catalog.refreshTable(commits_of(name))
