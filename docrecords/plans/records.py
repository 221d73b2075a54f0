"""Canonical records of one or two sources to final records and quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docrecords.operators import canonical, merge, quality, validate
from docrecords.operators.skew import latest

#: Flat records carry the typed array beside its text, so that merging parses nothing.
ITEMS = ("line_items",)


@dataclass(frozen=True)
class RecordViews:
    """The layers between canonical records and their readers. All lazy."""

    primary_flat: DataFrame
    fallback_flat: DataFrame | None
    nested: DataFrame
    final: DataFrame

    def register(self, prefix: str = "") -> None:
        """Make the layers available to SQL as temporary views."""
        names = {
            "canonical_primary_view": self.primary_flat,
            "canonical_fallback_view": self.fallback_flat,
            "canonical_nested_view": self.nested,
            "canonical_final": self.final,
        }
        for name, df in names.items():
            if df is not None:
                df.createOrReplaceTempView(prefix + name)

    def save(self, spark: SparkSession, prefix: str = "", buckets: int | None = None) -> RecordViews:
        """Store the layers as tables and return them as read from there.

        A view is computed again by each reader; a stored layer is not. With
        ``buckets`` the tables are bucketed by file path, and later joins of two
        layers by path need no shuffle.
        """
        stored = {}
        for name, df in self.__dict__.items():
            if df is None:
                stored[name] = None
                continue
            writer = df.write.mode("overwrite")
            if buckets:
                writer = writer.bucketBy(buckets, "source_file_path").sortBy("source_file_path")
            writer.saveAsTable(f"{prefix}{name}")
            stored[name] = spark.table(f"{prefix}{name}")
        return RecordViews(**stored)


def single_source(records: DataFrame, lenient_dates: bool = False) -> RecordViews:
    """One extraction: flatten, nest again, flatten for readers."""
    flat = canonical.flatten(records, lenient_dates, ITEMS)
    nested = canonical.renest(flat)
    return RecordViews(flat, None, nested, canonical.final_records(nested))


def dual_source(
    primary: DataFrame, fallback: DataFrame, lenient_dates: bool = False, version: Sequence[str] | None = None
) -> RecordViews:
    """Two extractions of the same files: flatten both, merge, flatten for readers.

    ``version`` names flat columns, the most important first; the latest record of each
    path by them counts, in the merge and in all reports.
    """
    p = canonical.flatten(primary, lenient_dates, ITEMS)
    f = canonical.flatten(fallback, lenient_dates, ITEMS)
    if version is not None:
        p, f = latest(p, [merge.KEY], version), latest(f, [merge.KEY], version)
    merged = merge.merge_sources(p, f)
    return RecordViews(p, f, merged, canonical.final_records(merged))


def quality_views(views: RecordViews) -> dict[str, DataFrame]:
    """Differences, coverage and contract violations of a two-source run."""
    p, f = views.primary_flat, views.fallback_flat
    out = {"violations": validate.validate(views.nested)}
    if f is not None:
        out["differences"] = quality.field_diff_report(p, f)
        out["difference_summary"] = quality.field_diff_summary(quality.field_status(p, f))
        out["coverage"] = quality.coverage_status(f, p)
        out["missing"] = quality.missing_files_sample(f, p)
    return out
