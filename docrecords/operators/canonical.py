"""Responses to typed nested records, and between nested and flat records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.functions import payload
from docrecords.functions.text import directory, file_name, normalize_date
from docrecords.schemas import (
    BARCODES,
    CANONICAL,
    FIELDS,
    INVOICE_HEADER,
    LINE_ITEMS,
)
from docrecords.sources.tables import conform


def gate(responses: DataFrame, keep: str = "invoice") -> DataFrame:
    """Successful extractions of the wanted document type."""
    return responses.filter(F.col("error").isNull() & (F.col("document_type") == keep))


def canonicalize(
    responses: DataFrame, keep: str = "invoice", as_of: datetime | Column | None = None
) -> DataFrame:
    """Responses to the canonical record; works on batches and streams."""
    response = F.col("response")
    found = payload.typed_struct(response, "$.invoiceHeader", INVOICE_HEADER)
    # A record without a header still has a header struct, of NULLs.
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in INVOICE_HEADER.fields])
    header = F.coalesce(found, empty)
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    path = F.col("source_file_path")
    return conform(
        gate(responses, keep).select(
            "input",
            "source_file_path",
            file_name(path).alias("source_file_name"),
            directory(path).alias("source_volume_path"),
            "modificationTime",
            "ingestion_timestamp",
            now.alias("processing_timestamp"),
            "summary",
            "document_type",
            header.alias("invoice_header"),
            payload.typed_array(response, "$.lineItems", LINE_ITEMS).alias("line_items"),
            payload.scalar(response, "$.flags", "string").alias("flags"),
            payload.typed_array(response, "$.barcodes", BARCODES).alias("barcodes"),
            "error",
        ),
        CANONICAL,
    )


def _count(items: str) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def _flat_columns(lenient: bool) -> list[Column]:
    out = []
    for f in FIELDS:
        if f.name == "line_items_json":
            c = F.to_json(f.path)
        elif f.name == "line_items_count":
            c = _count(f.path)
        elif f.kind == "date":
            c = normalize_date(f.path, lenient)
        else:
            c = F.col(f.path)
        out.append(c.alias(f.name))
    return out


def flatten(canonical: DataFrame, lenient_dates: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """The flat record: one column per field, line items as JSON text and count."""
    return canonical.select(*_flat_columns(lenient_dates), *extra)


def nullable_struct(parts: dict[str, Column]) -> Column:
    """A struct of the parts, or NULL when every part is NULL."""
    present = F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in parts.values()])
    return F.when(present, F.struct(*[c.alias(n) for n, c in parts.items()]))


def header_struct(value) -> Column:
    """The nested header, with ``value(flat name)`` giving each leaf.

    Dates become ISO text; the three inner structs are NULL when all parts are.
    """
    by_path = {f.path: f for f in FIELDS}
    out = []
    for field in INVOICE_HEADER.fields:
        path = f"invoice_header.{field.name}"
        if isinstance(field.dataType, T.StructType):
            parts = {p.name: value(by_path[f"{path}.{p.name}"].name) for p in field.dataType.fields}
            out.append(nullable_struct(parts).alias(field.name))
        else:
            flat = by_path[path]
            c = value(flat.name)
            out.append((F.date_format(c, "yyyy-MM-dd") if flat.kind == "date" else c).alias(field.name))
    return F.struct(*out)


def renest(flat: DataFrame) -> DataFrame:
    """Flat records of one source back to nested ones; without typed items their text is parsed."""
    items = F.col("line_items") if "line_items" in flat.columns else F.from_json("line_items_json", LINE_ITEMS)
    nested = flat.select(
        *_audit_columns(flat),
        header_struct(F.col).alias("invoice_header"),
        items.alias("line_items"),
        "flags",
        "barcodes",
        "error",
    )
    return nested


def _audit_columns(df: DataFrame) -> list[str]:
    wanted = (
        "input",
        "source_file_path",
        "source_file_name",
        "source_volume_path",
        "ingestion_timestamp",
        "processing_timestamp",
        "summary",
        "document_type",
    )
    return [c for c in wanted if c in df.columns]


def final_records(nested: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Flat records for readers, with the line items as a typed array."""
    columns = []
    for f, c in zip(FIELDS, _flat_columns(lenient_dates)):
        if f.name == "line_items_json":
            c = F.col("line_items").cast(LINE_ITEMS).alias("line_items")
        columns.append(c)
    return nested.select(*columns)


def as_json(records: DataFrame, out: str = "value") -> DataFrame:
    """One JSON text per record, for downstream consumers."""
    return records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))
