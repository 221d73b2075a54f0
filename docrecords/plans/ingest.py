"""Files to routed documents: intake, backfill of pending days, second source.

Documents are written once, to one table partitioned by ``destination``: 'main'
(the wanted type), 'other' and 'rejected' (no text, with the reason). One write
routes a whole batch of days, so nothing is deleted afterwards. Batches count once
they are committed (``sources.batches``): a run that is killed and run again gives
the rows of a run that was not. All three destinations are the ledger of what has
been handled.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.operators import enrich, intake, parse
from docrecords.schemas import (
    DOCUMENT_INTAKE,
    PARSED_DOCUMENT,
    PARSED_EXTENSIONS,
    SECOND_SOURCE_DOCUMENT,
)
from docrecords.operators.skew import any_null
from docrecords.session import kept, kept_in_buckets
from docrecords.sources import batches, listing
from docrecords.sources.files import list_files, read_files, read_paths, stamp
from docrecords.sources.tables import create_empty, table_exists, write_table

VERSION = tuple(intake.VERSION)
MAIN, OTHER, REJECTED = "main", "other", "rejected"
#: New files whose paths the driver holds at once.
PATHS_AT_ONCE = 20_000
#: Days that a filter lists; more are joined.
DAYS_IN_PLAN = 100

ROUTED_DOCUMENT = T.StructType(
    PARSED_DOCUMENT.fields
    + [
        T.StructField("reason", T.StringType()),
        T.StructField("process_date", T.DateType()),
        T.StructField("destination", T.StringType()),
    ]
)


SECOND_SOURCE_ROW = T.StructType(
    SECOND_SOURCE_DOCUMENT.fields
    + [T.StructField("process_date", T.DateType()), T.StructField("destination", T.StringType())]
)


@dataclass(frozen=True)
class IngestConfig:
    """Parameters of a run. ``dates`` narrows the pending days."""

    folder: str
    intake_table: str = "document_intake"
    documents_table: str = "documents"
    second_table: str = "second_source_documents"
    baseline: str | None = None
    lookback: timedelta | None = None
    suffixes: tuple[str, ...] | None = None
    parsed_extensions: tuple[str, ...] = PARSED_EXTENSIONS
    keep: str = "invoice"
    dates: tuple[date, ...] | None = None
    #: Pending days that are written and committed together; all of them unless given.
    days_per_commit: int | None = None
    #: Buckets of (path, modificationTime) in which the intake table is made; files are then
    #: compared with the ledger, and opened, where they lie.
    buckets: int | None = None
    #: Where the files of new tables are kept, if not in the session's warehouse.
    location: str | None = None
    #: Bytes of a file with a parsed extension to its elements, for formats such as PDF.
    parser: parse.Parser | None = None
    classify_options: dict = field(default_factory=dict)

    @staticmethod
    def parse_dates(text: str | None) -> tuple[date, ...] | None:
        """A JSON list of ISO days, as job parameters are passed; None when empty."""
        if not text:
            return None
        return tuple(date.fromisoformat(d) for d in json.loads(text))


def intake_layout(spark: SparkSession, config: IngestConfig) -> dict:
    """Files sorted by day, or buckets of versions, each sorted by day.

    A day may have few files, and folders of days would be as many files as there are days, or
    days times buckets; sorted files are read by their pages of the wanted days. Tables that
    were made with folders of days keep them.
    """
    name, days = config.intake_table, ("process_date",)
    buckets = {"buckets": config.buckets, "bucket_by": VERSION} if config.buckets else {}
    if table_exists(spark, name) and any(c.isPartition for c in spark.catalog.listColumns(name)):
        return {"partition_by": days, **buckets}
    return {**buckets, "sort_by": days}


def run_intake(spark: SparkSession, config: IngestConfig, as_of: datetime | None = None) -> None:
    """Append files that are not yet in the intake table; create it on the first run.

    Tasks list the folders and open the new files, and no others, where they can reach the
    store; of other stores Spark's file index lists the folder on the driver, and the new
    files' paths come to it in batches.
    """
    name, known = config.intake_table, None
    layout = intake_layout(spark, config)
    if table_exists(spark, name):
        known = spark.table(name)
    else:
        create_empty(spark, name, DOCUMENT_INTAKE, location=config.location, **layout)
    by_tasks = listing.readable(config.folder)
    files = listing.walk(spark, config.folder) if by_tasks else list_files(read_files(spark, config.folder))
    fresh = kept(intake.incremental_intake(files, known, config.baseline, config.lookback), "fresh")
    if by_tasks:
        stamped = stamp(listing.with_content(fresh), as_of)
        write_table(stamped, name, DOCUMENT_INTAKE, **layout)
        return
    paths = (r["path"] for r in fresh.select("path").toLocalIterator())
    while batch := list(islice(paths, PATHS_AT_ONCE)):
        stamped = stamp(read_paths(spark, batch), as_of)
        write_table(stamped, name, DOCUMENT_INTAKE, **layout)


def documents(spark: SparkSession, config: IngestConfig, destination: str = MAIN) -> DataFrame:
    """Committed documents of one destination; only its folders are read."""
    return batches.committed(spark, config.documents_table).filter(F.col("destination") == destination)


def process_documents(files: DataFrame, config: IngestConfig) -> DataFrame:
    """Pending files to routed documents. Local to each row: no shuffle."""
    parsed = parse.parse_documents(files, config.parsed_extensions, parser=config.parser)
    typed = enrich.enrich(parsed, **config.classify_options)
    destination = (
        F.when(F.col("reason").isNotNull(), REJECTED)
        .when(F.col("document_type").eqNullSafe(F.lit(config.keep)), MAIN)
        .otherwise(OTHER)
    )
    return typed.withColumn("destination", destination)


def run_backfill(spark: SparkSession, config: IngestConfig, before_commit: batches.Hook | None = None) -> None:
    """Process all pending days (or the configured ones), ``days_per_commit`` at a time.

    A day is pending while a committed batch lacks one of its file versions.
    """
    batches.create(spark, config.documents_table, ROUTED_DOCUMENT, config.location)
    taken = spark.table(config.intake_table)
    ledger = intake.ledger_of(batches.committed(spark, config.documents_table))
    # Versions alone are kept; each slice is then joined to what was pending when the run began.
    pending = _kept_versions(intake.pending_files(taken.select(*intake.VERSION), ledger, config.dates, config.suffixes), config)
    days = [r[0] for r in pending.select("process_date").distinct().orderBy("process_date").collect()]
    for some in _slices(days, config.days_per_commit):
        files = content_of(taken.filter(_between(some)), pending.filter(_between(some)), config)
        routed = process_documents(files.drop("length"), config)
        batches.write_days(routed, config.documents_table, ROUTED_DOCUMENT, some, before_commit=before_commit)


def _kept_versions(versions: DataFrame, config: IngestConfig) -> DataFrame:
    return kept_in_buckets(versions, "pending", config.buckets, *VERSION) if config.buckets else kept(versions, "pending")


def content_of(taken: DataFrame, pending: DataFrame, config: IngestConfig) -> DataFrame:
    """The intake rows of pending versions, from where their days lie."""
    if not config.buckets:
        return _content_of(taken, pending)
    some = _on_days(taken, [r[0] for r in pending.select("process_date").distinct().collect()])
    # Versions with NULL parts equal each other, but not in the buckets' join.
    unnamed = any_null(VERSION)
    return intake.in_place(some, pending, "left_semi").unionByName(intake.having(some.filter(unnamed), pending.filter(unnamed)))


def _slices(days: list[date | None], size: int | None) -> list[list[date | None]]:
    size = size or max(1, len(days))
    return [days[i : i + size] for i in range(0, len(days), size)]


def _among(days: list[date | None]) -> Column:
    day = F.col("process_date")
    return day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False))


def _between(days: list[date | None]) -> Column:
    """The same for a slice of all days that there are, in order: two bounds, however many days it has."""
    day, known = F.col("process_date"), [d for d in days if d is not None]
    bounds = day.between(F.lit(known[0]), F.lit(known[-1])) if known else F.lit(False)
    return bounds | (day.isNull() if None in days else F.lit(False))


def _on_days(df: DataFrame, days: list[date | None]) -> DataFrame:
    """The rows of these days; many days are joined, for a plan should not grow with them."""
    if len(days) <= DAYS_IN_PLAN:
        return df.filter(_among(days))
    wanted = df.sparkSession.createDataFrame([(d,) for d in days], T.StructType([T.StructField("_day", T.DateType())]))
    return df.join(F.broadcast(wanted), F.col("process_date").eqNullSafe(F.col("_day")), "left_semi")


def _content_of(taken: DataFrame, pending: DataFrame) -> DataFrame:
    """The intake rows of pending versions; content of other days is not read.

    A day that is pending as a whole needs no join, so its content is not moved.
    """
    whole, partly = intake.pending_by_day(taken, pending)
    return _on_days(taken, whole).unionByName(intake.having(_on_days(taken, partly), pending))


def run_second_source(
    spark: SparkSession,
    config: IngestConfig,
    fn: Callable[[bytes], str] | None = None,
    replace: bool = False,
    before_commit: batches.Hook | None = None,
) -> None:
    """Run the second text extractor over the kept documents it has not read.

    A failure is a row with its ``error``; failed documents are tried again by each run.
    With ``replace`` the configured days (or all) are read anew, and their rows take the
    place of the days' earlier rows.
    """
    name, schema = config.second_table, SECOND_SOURCE_ROW
    batches.create(spark, name, schema, config.location)
    ledger = None if replace else intake.ledger_of(batches.committed(spark, name).filter("error IS NULL"))
    taken = spark.table(config.intake_table).drop("length")
    wanted = enrich.second_source(
        taken.select(*intake.VERSION),
        # Only documents of the wanted type are read again, and these all are in 'main'.
        documents(spark, config, MAIN),
        ledger,
        keep=config.keep,
        dates=config.dates,
        suffixes=config.suffixes,
    )
    wanted = kept(wanted, "second-source")
    files = enrich.attach_labels(intake.having(taken, wanted), wanted).withColumn("process_date", F.to_date("modificationTime"))
    days = [r[0] for r in wanted.select("process_date").distinct().orderBy("process_date").collect()]
    for some in _slices(days, config.days_per_commit):
        texts = parse.extract_text(files.filter(_between(some)), fn).withColumnRenamed("text_error", "error")
        texts = texts.withColumn("destination", F.lit(MAIN))
        batches.write_days(texts, name, schema, some, replace, before_commit)


def run_summary(spark: SparkSession, config: IngestConfig) -> dict[str, DataFrame]:
    """Tables that describe the state after a run."""
    taken_in = spark.table(config.intake_table)
    docs = batches.committed(spark, config.documents_table)
    return {
        "files": taken_in.agg(F.count("*").alias("n")),
        "documents": docs.groupBy("destination").agg(F.count("*").alias("n")),
        "types": intake.breakdown(docs, "document_type"),
        "extensions": intake.extension_breakdown(taken_in),
        "latest": intake.latest_files(taken_in),
    }
