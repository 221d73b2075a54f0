"""Tables in the session catalog: existence, typed creation, by-name appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def use_database(spark: SparkSession, name: str) -> None:
    """Resolve unqualified table names in this database."""
    spark.catalog.setCurrentDatabase(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types, nested fields included."""
    return df.select(*_conformed(df, schema))


def create_empty(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: tuple[str, ...] = (),
    location: str | None = None,
    buckets: int | None = None,
    bucket_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
) -> None:
    """An empty table with the declared layout, for a first run without input.

    With ``location`` its files are kept in the folder of its name below that place.
    """
    writer = spark.createDataFrame([], schema).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        writer = writer.sortBy(*sort_by) if sort_by else writer
    if location is not None:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    writer.saveAsTable(name)


def write_table(
    df: DataFrame,
    name: str,
    schema: T.StructType,
    replace: bool = False,
    partition_by: tuple[str, ...] = (),
    buckets: int | None = None,
    bucket_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
) -> None:
    """Create the table on first use, then append; columns are matched by name.

    With ``partition_by`` the rows are rebalanced first: each folder is written by
    few tasks, and a folder that gets much of the data is split over several. A table
    in buckets gets its rows dealt by bucket instead, so that a bucket has few files. With
    ``sort_by`` alone rows that are equal in it lie together, and files are sorted.
    """
    spark = df.sparkSession
    out = conform(df, schema)
    if table_exists(spark, name) and not replace:
        # saveAsTable appends by position, so follow the stored column order.
        out = out.select(*spark.table(name).columns)
    if buckets:
        out = out.repartition(buckets, *bucket_by)
    elif partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    elif sort_by:
        out = out.hint("rebalance", *[F.col(c) for c in sort_by]).sortWithinPartitions(*sort_by)
    writer = out.write.mode("overwrite" if replace else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        writer = writer.sortBy(*sort_by) if sort_by else writer
    writer.saveAsTable(name)


def _conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    have = set(df.columns)
    return [
        _by_name(F.col(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name)
        if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


def _by_name(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast that pairs struct fields by name, where a plain cast pairs them by position."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        known = set(have.fieldNames())
        parts = [
            _by_name(c[f.name], have[f.name].dataType, f.dataType).alias(f.name)
            if f.name in known
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _by_name(x, have.elementType, want.elementType))
    return c.cast(want)
