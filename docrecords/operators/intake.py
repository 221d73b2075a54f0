"""Taking files in once, and finding what is still to be processed.

A file version is identified by (path, modificationTime).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrecords.functions.text import extension
from docrecords.schemas import INTAKE_BASELINE

VERSION = ["path", "modificationTime"]


def high_water_mark(intake: DataFrame, baseline: str = INTAKE_BASELINE, column: str = "ingestion_timestamp") -> DataFrame:
    """One row: the latest intake time, or the baseline when nothing was taken in."""
    latest = F.coalesce(F.max(column), F.lit(baseline).cast(intake.schema[column].dataType))
    return intake.agg(latest.alias("high_water_mark"))


def newer_than(files: DataFrame, cutoff: datetime | str) -> DataFrame:
    kind = files.schema["modificationTime"].dataType
    return files.filter(F.col("modificationTime") > F.lit(cutoff).cast(kind))


def not_in(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose version the ledger does not hold.

    Versions alone are compared, so content is not moved for files that are known. The
    ledger is reduced to distinct versions first: a version recorded very often then
    weighs as much as any other. A version with a NULL part is in no ledger.
    """
    narrow = files.select(*VERSION).join(ledger.select(*VERSION).distinct(), VERSION, "left_anti")
    return narrow if files.columns == VERSION else having(files, narrow)


def having(files: DataFrame, versions: DataFrame) -> DataFrame:
    """The files of these versions; NULL parts of a version equal each other."""
    wanted = versions.select(F.col("path").alias("_path"), F.col("modificationTime").alias("_time")).distinct()
    same = F.col("path").eqNullSafe(F.col("_path")) & F.col("modificationTime").eqNullSafe(F.col("_time"))
    return files.join(wanted, same, "left_semi")


def in_place(files: DataFrame, versions: DataFrame, how: str = "left_anti") -> DataFrame:
    """The files whose version is not (``left_semi``: is) among ``versions``, joined where they lie.

    With both in as many buckets of (path, modificationTime) neither is shuffled, and the
    content is not sorted: each task holds its bucket's versions and streams the files past
    them. A version with a NULL part is among none.
    """
    if how not in ("left_anti", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    return files.join(versions.select(*VERSION).hint("shuffle_hash"), VERSION, how)


def incremental_intake(
    files: DataFrame,
    existing: DataFrame | None = None,
    baseline: str | None = None,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Files not yet taken in: those whose version is not there, however old they are.

    Two options narrow the comparison where late files cannot occur: ``baseline`` leaves
    out files up to that time, ``lookback`` those older than the high-water mark of
    intake less that interval (one value, read by the driver, so that it reaches the
    scans as a filter).
    """
    if baseline is not None:
        files = newer_than(files, baseline)
    if existing is None:
        return files
    if lookback is not None:
        mark = high_water_mark(existing, baseline or INTAKE_BASELINE).first()["high_water_mark"]
        files, existing = newer_than(files, mark - lookback), newer_than(existing, mark - lookback)
    return not_in(files, existing)


def recent_count(intake: DataFrame, as_of: datetime | str, interval: str, column: str = "ingestion_timestamp") -> DataFrame:
    """One row: how many rows are at most ``interval`` older than ``as_of``."""
    start = F.lit(as_of).cast(intake.schema[column].dataType) - F.expr(f"INTERVAL {interval}")
    return intake.filter(F.col(column) >= start).agg(F.count("*").alias("n_recent"))


def _pending(intake: DataFrame, ledger: DataFrame | None, suffixes: Iterable[str] | None) -> DataFrame:
    if suffixes is not None:
        low = F.lower("path")
        wanted = F.lit(False)
        for suffix in suffixes:
            wanted = wanted | low.endswith(suffix.lower())
        intake = intake.filter(wanted)
    return intake if ledger is None else not_in(intake, ledger)


def pending_dates(
    intake: DataFrame,
    ledger: DataFrame | None = None,
    suffixes: Iterable[str] | None = None,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """Distinct days with unprocessed files, oldest first; ``dates`` narrows them."""
    versions = intake if dates is None else _on_days(intake, dates)
    versions = versions.select(*VERSION)
    days = _pending(versions, ledger, suffixes).select(F.to_date("modificationTime").alias("process_date"))
    return days.distinct().orderBy("process_date")


def pending_files(
    intake: DataFrame,
    ledger: DataFrame | None = None,
    dates: Iterable[date] | None = None,
    suffixes: Iterable[str] | None = None,
) -> DataFrame:
    """Unprocessed files of all days, or of the given ones, with their ``process_date``."""
    if dates is not None:
        intake = _on_days(intake, dates)
    pending = _pending(intake, ledger, suffixes)
    return pending.withColumn("process_date", F.to_date("modificationTime"))


def pending_by_day(intake: DataFrame, pending: DataFrame) -> tuple[list[date | None], list[date | None]]:
    """(days of which every version is pending, other days with pending versions).

    One narrow pass over versions; the driver gets a few numbers per day.
    """
    days = [
        df.groupBy(F.to_date("modificationTime").alias("day")).agg(F.count("*").alias(name))
        for df, name in ((intake.select(*VERSION), "present"), (pending.select(*VERSION), "pending"))
    ]
    same = F.col("l.day").eqNullSafe(F.col("r.day"))
    rows = days[0].alias("l").join(days[1].alias("r"), same).select("l.day", "present", "pending").collect()
    whole = [r["day"] for r in rows if r["present"] == r["pending"]]
    return whole, [r["day"] for r in rows if r["present"] != r["pending"]]


def _on_days(df: DataFrame, dates: Iterable[date]) -> DataFrame:
    # A stored day prunes folders; else comparing the day pushes a time range to the scan.
    day = F.col("process_date") if "process_date" in df.columns else F.to_date("modificationTime")
    wanted = F.lit(False)
    for d in dates:
        wanted = wanted | (day == F.lit(d))
    return df.filter(wanted)


def ledger_of(*tables: DataFrame) -> DataFrame:
    """Versions already handled: main, other and rejected rows alike."""
    ledger = tables[0].select(*VERSION)
    for t in tables[1:]:
        ledger = ledger.unionByName(t.select(*VERSION))
    return ledger


def latest_files(intake: DataFrame, k: int = 5) -> DataFrame:
    """The k most recently modified files."""
    columns = [c for c in ("path", "modificationTime", "ingestion_timestamp") if c in intake.columns]
    return intake.select(*columns).orderBy(F.desc("modificationTime"), F.asc("path")).limit(k)


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column))


def extension_breakdown(intake: DataFrame) -> DataFrame:
    return breakdown(intake.select(extension("path").alias("extension")), "extension")
