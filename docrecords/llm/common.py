"""What the operators of this folder share: tables, stored intermediate results, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.session import run_dir

#: A word: a run without space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A name for a working column that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_row(df: DataFrame, *left_out: str) -> Column:
    """All columns but some as one struct, so that names of working columns beside it cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in left_out])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read from there.

    Cuts the lineage, so a lost executor costs one read, and lets adaptive execution
    see exchanges on both sides of a later join, which it needs to split hot keys.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows.stored_at = path
    return rows


def forget(*stored_rows: DataFrame) -> None:
    """Remove files of ``stored`` whose rows nothing will read again, which were all written from."""
    for rows in stored_rows:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(rows.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_in_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """The rows, written in buckets of ``key``; reading them grouped by it needs no shuffle.

    Buckets need a table's description, which is dropped again; the files stay.
    """
    spark, path = df.sparkSession, run_dir(df.sparkSession, name)
    table_name = f"docrecords_{uuid.uuid4().hex}"
    df.write.option("path", path).bucketBy(shuffle_width(spark), key).saveAsTable(table_name)
    rows = spark.table(table_name)
    spark.sql(f"DROP TABLE {table_name}")
    return rows


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
