"""The only authority for table layouts and for the list of record fields.

Everything that is "one expression per field" elsewhere (flattening, merging,
difference statuses, previews, required-field rules) is generated from
``FIELDS``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: names and types of the record contract --------------------

ADDRESS_PARTS = ("address", "city", "state", "zip")

ADDRESS = T.StructType([T.StructField(p, T.StringType()) for p in ADDRESS_PARTS])

# "termsNetDuedays" is spelt this way in the contract.
PAYMENT_TERMS = T.StructType(
    [
        T.StructField("termsDiscountPercentage", T.DoubleType()),
        T.StructField("termsDiscountDueDays", T.IntegerType()),
        T.StructField("termsNetDuedays", T.IntegerType()),
    ]
)

HEADER_STRINGS = (
    "invoiceNumber",
    "vendorName",
    "orderNumber",
    "purchaseOrderNumber",
    "bolNumber",
    "vendorNumber",
    "branch",
    "warehouse",
)
HEADER_DATES = ("invoiceDate", "discountDate")
HEADER_AMOUNTS = ("discountAmount", "freightAmount", "subtotalAmount", "totalAmount")

INVOICE_HEADER = T.StructType(
    [T.StructField(n, T.StringType()) for n in HEADER_STRINGS + HEADER_DATES]
    + [T.StructField(n, T.DoubleType()) for n in HEADER_AMOUNTS]
    + [
        T.StructField("shippingAddress", ADDRESS),
        T.StructField("remittanceAddress", ADDRESS),
        T.StructField("paymentTerms", PAYMENT_TERMS),
    ]
)

LINE_ITEM = T.StructType(
    [
        T.StructField("lineNumber", T.IntegerType()),
        T.StructField("productCode", T.StringType()),
        T.StructField("uom", T.StringType()),
        T.StructField("quantityShipped", T.DoubleType()),
        T.StructField("weightShipped", T.DoubleType()),
        T.StructField("unitPrice", T.DoubleType()),
        T.StructField("lineTotal", T.DoubleType()),
    ]
)
LINE_ITEMS = T.ArrayType(LINE_ITEM)
BARCODES = T.ArrayType(T.StringType())

# --- tables -------------------------------------------------------------------

DOCUMENT_INTAKE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
            # Day of modification: the folder of a stored row.
        T.StructField("process_date", T.DateType()),
    ]
)

PARSED_DOCUMENT = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("raw_parsed", T.VariantType()),
        T.StructField("text", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("document_type", T.StringType()),
    ]
)

# A document that could not be parsed: identity and the reason.
REJECTED_DOCUMENT = T.StructType(
    PARSED_DOCUMENT.fields[:3] + [T.StructField("reason", T.StringType())]
)

SECOND_SOURCE_DOCUMENT = T.StructType(
    PARSED_DOCUMENT.fields[:3]
    + [
        T.StructField("summary", T.StringType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("text", T.StringType()),
        # Why the extractor gave no text; such rows are tried again.
        T.StructField("error", T.StringType()),
    ]
)

RESPONSE = T.StructType(
    [
        T.StructField("input", T.StringType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("summary", T.StringType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("response", T.VariantType()),
        T.StructField("error", T.StringType()),
    ]
)

CANONICAL = T.StructType(
    [
        T.StructField("input", T.StringType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("source_volume_path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("processing_timestamp", T.TimestampType()),
        T.StructField("summary", T.StringType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("invoice_header", INVOICE_HEADER),
        T.StructField("line_items", LINE_ITEMS),
        T.StructField("flags", T.StringType()),
        T.StructField("barcodes", BARCODES),
        T.StructField("error", T.StringType()),
    ]
)


# --- the field list -------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One column of the flat record and how each layer treats it.

    merge:   primary | fallback_first | blank_aware | items | items_count
    kind:    string | date | number | integer | array | timestamp
    preview: long | quoted | plain | address | clipped | none
    compare: whether the difference report covers the column
    """

    name: str
    path: str
    kind: str
    merge: str = "primary"
    preview: str = "quoted"
    compare: bool = True


def _address_fields(prefix: str, struct: str) -> list[Field]:
    return [
        Field(
            f"{prefix}_{part}",
            f"invoice_header.{struct}.{part}",
            "string",
            "blank_aware",
            "address" if part == "address" else "quoted",
        )
        for part in ADDRESS_PARTS
    ]


FIELDS: list[Field] = [
    Field("input", "input", "string", preview="long"),
    Field("source_file_path", "source_file_path", "string"),
    Field("source_file_name", "source_file_name", "string", compare=False),
    Field("source_volume_path", "source_volume_path", "string", preview="none"),
    Field("ingestion_timestamp", "ingestion_timestamp", "timestamp", compare=False),
    Field("processing_timestamp", "processing_timestamp", "timestamp", compare=False),
    Field("error", "error", "string"),
    Field("flags", "flags", "string"),
    Field("summary", "summary", "string", "fallback_first", "long"),
    Field("document_type", "document_type", "string", "fallback_first"),
    *[Field(n, f"invoice_header.{n}", "string", "blank_aware") for n in HEADER_STRINGS],
    *[Field(n, f"invoice_header.{n}", "date") for n in HEADER_DATES],
    *[Field(n, f"invoice_header.{n}", "number", preview="plain") for n in HEADER_AMOUNTS],
    *_address_fields("shipping", "shippingAddress"),
    *_address_fields("remittance", "remittanceAddress"),
    Field("termsDiscountPercentage", "invoice_header.paymentTerms.termsDiscountPercentage", "number", preview="plain"),
    Field("termsDiscountDueDays", "invoice_header.paymentTerms.termsDiscountDueDays", "integer", preview="plain"),
    Field("termsNetDuedays", "invoice_header.paymentTerms.termsNetDuedays", "integer", preview="plain"),
    Field("line_items_json", "line_items", "string", "items", "clipped"),
    Field("line_items_count", "line_items", "integer", "items_count", "plain"),
    Field("barcodes", "barcodes", "array", "items", "clipped"),
]

FLAT_COLUMNS: list[str] = [f.name for f in FIELDS]

# The order in which differing columns are listed in the report.
COMPARED_COLUMNS: list[str] = [
    "input",
    "source_file_path",
    "source_volume_path",
    "error",
    "summary",
    "document_type",
    "orderNumber",
    "bolNumber",
    "vendorNumber",
    "vendorName",
    "invoiceNumber",
    "invoiceDate",
    "purchaseOrderNumber",
    "branch",
    "warehouse",
    "discountAmount",
    "discountDate",
    "freightAmount",
    "totalAmount",
    "subtotalAmount",
    *[f"shipping_{p}" for p in ADDRESS_PARTS],
    *[f"remittance_{p}" for p in ADDRESS_PARTS],
    "termsDiscountPercentage",
    "termsDiscountDueDays",
    "termsNetDuedays",
    "flags",
    "barcodes",
    "line_items_json",
    "line_items_count",
]

BY_NAME: dict[str, Field] = {f.name: f for f in FIELDS}

# Document labels, in tie-break order, and the label for short texts.
DOCUMENT_LABELS = ("invoice", "receipt", "purchase_order", "contract", "other")
UNCLASSIFIED = "unknown"
NO_SUMMARY = "No summary available"

# Files sent to the element parser; all others are decoded as plain text.
PARSED_EXTENSIONS = (".pdf", ".jpg", ".jpeg", ".png")
# Kinds of parsed file whose bytes are markup.
MARKUP_EXTENSIONS = (".html", ".htm")

# Intake time reported where nothing was taken in.
INTAKE_BASELINE = "2025-09-01 00:00:00"
