"""Merging two extractions of the same files, field by field.

The policy of each field is written in ``schemas.FIELDS``:

* primary: the primary value unless NULL (0 and '' are kept)
* fallback_first: the fallback value unless NULL
* blank_aware: the primary value unless blank, then the fallback value unless blank
* items: the whole primary array when it has elements, else the fallback's, else NULL
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrecords.functions.text import nz
from docrecords.operators.canonical import header_struct
from docrecords.operators.skew import latest, outer_join
from docrecords.schemas import BY_NAME, FIELDS, FLAT_COLUMNS, LINE_ITEMS

KEY = "source_file_path"


def pair_sources(
    primary: DataFrame,
    fallback: DataFrame,
    key: str = KEY,
    columns: list[str] | None = None,
    version: Sequence[str] | None = None,
) -> DataFrame:
    """Full outer join of two flat record sets on ``key``.

    The columns of the sides are prefixed ``p_`` and ``f_``; the key column, taken
    from whichever side has it, is called ``key``. With ``version`` (columns, the most
    important first) each side is reduced to its latest record per key before; without
    it the sides must hold one record per key, or several pair up with each other.
    """
    if columns is None:
        typed = all("line_items" in side.columns for side in (primary, fallback))
        columns = [*FLAT_COLUMNS, *(["line_items"] if typed else [])]
    if version is not None:
        primary, fallback = latest(primary, [key], version), latest(fallback, [key], version)
    p = primary.select(F.col(key).alias("key"), *[F.col(c).alias(f"p_{c}") for c in columns])
    f = fallback.select(F.col(key).alias("key"), *[F.col(c).alias(f"f_{c}") for c in columns])
    return outer_join(p, f, "key", "full", spread_nulls=version is not None)


def merge_sources(
    primary: DataFrame, fallback: DataFrame, key: str = KEY, version: Sequence[str] | None = None
) -> DataFrame:
    """Two flat record sets to merged nested records."""
    return merge_pairs(pair_sources(primary, fallback, key, version=version))


def merge_pairs(pairs: DataFrame) -> DataFrame:
    """The field policies applied to the output of ``pair_sources``."""
    return pairs.select(
        *[merged_value(n).alias(n) for n in _audit()],
        header_struct(merged_value).alias("invoice_header"),
        _merged_items("p_line_items" in pairs.columns).alias("line_items"),
        merged_value("flags").alias("flags"),
        merged_value("barcodes").alias("barcodes"),
        merged_value("error").alias("error"),
    )


def _audit() -> list[str]:
    outside = ("error", "flags", "line_items_json", "line_items_count", "barcodes")
    return [f.name for f in FIELDS if not f.path.startswith("invoice_header.") and f.name not in outside]


def merged_value(name: str) -> Column:
    """One field of a pair (columns ``p_`` and ``f_``) by its policy."""
    p, f = F.col(f"p_{name}"), F.col(f"f_{name}")
    policy = BY_NAME[name].merge
    if policy == "fallback_first":
        return F.coalesce(f, p)
    if policy == "blank_aware":
        return F.coalesce(nz(p), nz(f))
    if policy == "items":
        return F.when(F.size(p) > 0, p).when(F.size(f) > 0, f)
    return F.coalesce(p, f)


def _merged_items(typed: bool) -> Column:
    """The chosen line items; of flat records that hold JSON text only, the chosen text is parsed."""
    name = "line_items" if typed else "line_items_json"
    chosen = F.when(F.col("p_line_items_count") > 0, F.col(f"p_{name}")).when(
        F.col("f_line_items_count") > 0, F.col(f"f_{name}")
    )
    return chosen if typed else F.from_json(chosen, LINE_ITEMS)
