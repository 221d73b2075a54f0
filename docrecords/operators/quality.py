"""Comparing two extractions, and counting records across layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrecords.operators.merge import KEY, pair_sources
from docrecords.schemas import BY_NAME, COMPARED_COLUMNS, Field

# What a NULL counts as when values are compared.
NULL_AS = {"string": "''", "date": "DATE '1900-01-01'", "number": "0.0D", "integer": "0"}


def _differs(field: Field, null_safe: bool) -> Column:
    p, f = F.col(f"p_{field.name}"), F.col(f"f_{field.name}")
    if null_safe or field.kind == "array":
        return ~p.eqNullSafe(f)
    default = F.expr(NULL_AS[field.kind])
    return F.coalesce(p, default) != F.coalesce(f, default)


def field_status(
    primary: DataFrame,
    fallback: DataFrame,
    key: str = KEY,
    null_safe: bool = False,
    version: Sequence[str] | None = None,
) -> DataFrame:
    """One row per file of either side: ``<field>_status`` is SAME or DIFF.

    By default NULL equals the empty value of its type, so that a missing text and
    an empty one are the same; ``null_safe`` tells them apart. The compared values
    stay in the output, prefixed ``p_`` and ``f_``, next to ``in_left``/``in_right``.
    """
    audit = ["source_file_name", "ingestion_timestamp", "processing_timestamp"]
    pairs = pair_sources(primary, fallback, key, COMPARED_COLUMNS + audit, version)
    return pairs.withColumns(
        {
            f"{n}_status": F.when(_differs(BY_NAME[n], null_safe), "DIFF").otherwise("SAME")
            for n in COMPARED_COLUMNS
        }
    )


def _is_diff(name: str) -> Column:
    return F.col(f"{name}_status") == "DIFF"


def _shown(field: Field, side: str, cut: Mapping[str, int]) -> Column:
    """The preview of one value, NULL shown as the word; ``cut`` has lengths by kind of preview."""
    c = F.col(f"{side}_{field.name}")
    if field.kind != "string":
        c = c.cast("string")
    if field.preview in cut:
        c = F.left(c, F.lit(cut[field.preview]))
    return F.coalesce(c, F.lit("NULL"))


def _preview(field: Field, left_label: str, right_label: str, cut: Mapping[str, int]) -> Column:
    opening, closing = {
        "plain": ("", ""),
        "long": ('"', '..."'),
        "clipped": ('"', '..."'),
    }.get(field.preview, ('"', '"'))
    text = F.concat(
        F.lit(f"{left_label}: {opening}"),
        _shown(field, "p", cut),
        F.lit(f"{closing} | {right_label}: {opening}"),
        _shown(field, "f", cut),
        F.lit(closing),
    )
    return F.when(_is_diff(field.name), text)


def field_diff_report(
    primary: DataFrame,
    fallback: DataFrame,
    key: str = KEY,
    labels: tuple[str, str] = ("OCR", "AI"),
    null_safe: bool = False,
    ordered: bool = True,
    cut: Mapping[str, int] | None = None,
    version: Sequence[str] | None = None,
) -> DataFrame:
    """Files with at least one difference: how many, which columns, and previews.

    Most differences first, then by key. ``coverage`` tells one-sided files apart.
    Previews are whole unless ``cut`` limits a kind, as in ``{"long": 100, "clipped": 200}``.
    """
    statuses = field_status(primary, fallback, key, null_safe, version)
    counted = statuses.withColumn(
        "total_differences",
        reduce(lambda a, b: a + b, [_is_diff(n).cast("int") for n in COMPARED_COLUMNS]),
    ).filter(F.col("total_differences") > 0)
    report = counted.select(
        F.coalesce("p_source_file_name", "f_source_file_name").alias("file_name"),
        F.col("key"),
        F.coalesce("p_ingestion_timestamp", "f_ingestion_timestamp").alias("ingestion_timestamp"),
        F.coalesce("p_processing_timestamp", "f_processing_timestamp").alias("processing_timestamp"),
        _coverage(labels).alias("coverage"),
        "total_differences",
        F.concat_ws(", ", *[F.when(_is_diff(n), F.lit(n)) for n in COMPARED_COLUMNS]).alias("different_columns"),
        *[
            _preview(BY_NAME[n], *labels, cut or {}).alias(f"{n}_diff")
            for n in COMPARED_COLUMNS
            if BY_NAME[n].preview != "none"
        ],
    )
    return report.orderBy(F.desc("total_differences"), "file_name", "key") if ordered else report


def field_diff_summary(statuses: DataFrame) -> DataFrame:
    """(field, status, n) over the output of ``field_status``.

    One sum per field in a single pass, then one row per field.
    """
    sums = [F.count_if(_is_diff(n)).alias(n) for n in COMPARED_COLUMNS]
    totals = statuses.agg(F.count("*").alias("_n"), *sums)
    each = [
        F.struct(F.lit(n).alias("field"), F.lit(status).alias("status"), count.alias("n"))
        for n in COMPARED_COLUMNS
        for status, count in (("DIFF", F.col(n)), ("SAME", F.col("_n") - F.col(n)))
    ]
    return totals.select(F.inline(F.array(*each))).filter("n > 0")


def _coverage(labels: tuple[str, str]) -> Column:
    left, right = labels
    return (
        F.when(F.col("in_left") & F.col("in_right"), "BOTH")
        .when(F.col("in_left"), f"{left}_ONLY")
        .otherwise(f"{right}_ONLY")
    )


def coverage(
    a: DataFrame, b: DataFrame, labels: tuple[str, str] = ("AI", "OCR"), key: str = KEY
) -> DataFrame:
    """(key, processing_status, n_rows) for every key of either side.

    ``n_rows`` is what a full outer join of the sides has for the key. The sides
    are counted per key before they are joined, so neither a frequent key nor the
    pairs of its rows are ever sent anywhere.
    """
    left = a.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n_left"))
    right = b.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n_right"))
    joined = left.join(right, "key", "full")
    both = F.col("n_left").isNotNull() & F.col("n_right").isNotNull()
    status = (
        F.when(both, "BOTH").when(F.col("n_left").isNotNull(), f"{labels[0]}_ONLY").otherwise(f"{labels[1]}_ONLY")
    )
    rows = F.coalesce("n_left", F.lit(1)) * F.coalesce("n_right", F.lit(1))
    return joined.select("key", status.alias("processing_status"), rows.alias("n_rows"))


def coverage_status(a: DataFrame, b: DataFrame, **options) -> DataFrame:
    """Files per coverage status."""
    statuses = coverage(a, b, **options).groupBy("processing_status")
    return statuses.agg(F.sum("n_rows").alias("file_count")).orderBy(F.desc("file_count"), "processing_status")


def missing_files_sample(a: DataFrame, b: DataFrame, k: int = 20, **options) -> DataFrame:
    """The first k rows, by status and key, that one side lacks."""
    missing = coverage(a, b, **options).filter(F.col("processing_status") != "BOTH")
    first = missing.orderBy("processing_status", "key").limit(k)
    # A key that occurs more than once fills as many places, up to all k.
    places = F.explode(F.array_repeat(F.col("key"), F.least("n_rows", F.lit(k)).cast("int")))
    rows = first.select("processing_status", places.alias("file_name"))
    return rows.orderBy("processing_status", "file_name").limit(k)


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(source_table, record_count), largest first."""
    counts = [
        df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("source_table"), "record_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("record_count"), "source_table")
