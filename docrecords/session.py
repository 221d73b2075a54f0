"""Session settings and the shared folder for data that must outlive a task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings every run relies on: days are UTC days, plans adapt at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Settings that can only be given when a session is built. Recording the Python
#: call site of every column expression takes much of the time to build wide plans.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

#: Shuffled rows go when the execution that made them ends, instead of some time after the driver
#: has forgotten it. For executions that are not run again: those would shuffle anew.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Runtime settings for what is executed, and streams that are started, inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="docrecords-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/docrecords/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, held: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read from there: fixed, and without lineage.

    The place is added to ``held``, for callers that ``discard`` it. ``compression`` is the
    session's unless given.
    """
    path = run_dir(df.sparkSession, name)
    if held is not None:
        held.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_in_buckets(df: DataFrame, name: str, buckets: int, *key: str) -> DataFrame:
    """The same in buckets of ``key``: a join by it with a table in as many buckets needs no shuffle.

    Buckets need a table's description, which is dropped again; the files stay.
    """
    spark, path, table = df.sparkSession, run_dir(df.sparkSession, name), f"docrecords_{uuid.uuid4().hex}"
    df.write.option("path", path).bucketBy(buckets, *key).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store that nothing reads any more."""
    store, place = _place(spark, path)
    store.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared store has this file or folder."""
    store, place = _place(spark, path)
    return store.exists(place)


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
