"""Document files as rows of (path, modificationTime, length, content)."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def _options(modified_after: datetime | str | None, glob: str | None) -> dict[str, str]:
    options = {"recursiveFileLookup": "true"}
    if modified_after is not None:
        if isinstance(modified_after, datetime):
            modified_after = modified_after.strftime("%Y-%m-%dT%H:%M:%S")
        options["modifiedAfter"] = modified_after.replace(" ", "T")
    if glob is not None:
        options["pathGlobFilter"] = glob
    return options


def read_files(
    spark: SparkSession, folder: str, modified_after: datetime | str | None = None, glob: str | None = None
) -> DataFrame:
    """Files below ``folder``, optionally only those newer than a cutoff."""
    return spark.read.format("binaryFile").options(**_options(modified_after, glob)).load(folder)


def stream_files(
    spark: SparkSession,
    folder: str,
    modified_after: datetime | str | None = None,
    glob: str | None = None,
    max_age: str = "3650d",
) -> DataFrame:
    """The same as an unbounded stream; the checkpoint remembers which files were seen.

    Files more than ``max_age`` older than the newest one seen are passed over. Spark's
    own limit of a week would lose late arrivals that keep an old modification time.
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).options(**_options(modified_after, glob))
    return reader.option("maxFileAge", max_age).load(folder)


def list_files(files: DataFrame) -> DataFrame:
    """The files without content; Spark then opens none of them."""
    return files.drop("content")


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Exactly these files; characters that Spark takes for patterns are escaped."""
    escaped = [re.sub(r"([\\*?{}\[\]])", r"\\\1", p) for p in paths]
    return spark.read.format("binaryFile").load(escaped)


def stamp(files: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Intake rows: the files with the time they were taken in and their day."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    day = F.to_date("modificationTime").alias("process_date")
    return files.select("path", "content", "modificationTime", "length", now.alias("ingestion_timestamp"), day)
