"""Text to a structured response, with failures kept in the row they belong to."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrecords.operators.rows import pin
from docrecords.schemas import ADDRESS_PARTS, LINE_ITEM, PAYMENT_TERMS

# The labels of this package's own text invoices, one "Label: value" line per field.
HEADER_LABELS = {
    "invoiceNumber": "Invoice Number",
    "vendorName": "Vendor Name",
    "orderNumber": "Order Number",
    "purchaseOrderNumber": "Purchase Order Number",
    "bolNumber": "BOL Number",
    "vendorNumber": "Vendor Number",
    "branch": "Branch",
    "warehouse": "Warehouse",
    "invoiceDate": "Invoice Date",
    "discountDate": "Discount Date",
    "discountAmount": "Discount Amount",
    "freightAmount": "Freight Amount",
    "subtotalAmount": "Subtotal Amount",
    "totalAmount": "Total Amount",
}
ADDRESS_LABELS = {"shippingAddress": "Ship To", "remittanceAddress": "Remit To"}
TERMS_LABELS = {
    "termsDiscountPercentage": "Terms Discount Percentage",
    "termsDiscountDueDays": "Terms Discount Due Days",
    "termsNetDuedays": "Terms Net Due Days",
}
FLAGS_LABEL = "Flags"
BARCODE_LABEL = "Barcode"
NUMBERS = ("discountAmount", "freightAmount", "subtotalAmount", "totalAmount")

# A native extractor: (rows, text column) -> rows with response VARIANT and error STRING.
NativeExtractor = Callable[[DataFrame, str], DataFrame]
# A Python extractor: text -> plain dict in the payload's layout.
PythonExtractor = Callable[[str], dict]


def text_invoice(df: DataFrame, source: str) -> DataFrame:
    """Read text invoices by their line labels and ``|``-separated item lines.

    The text is split into lines, and these into labels and values, once per row in
    projections of their own; a field is the value at the first place of its label.
    """
    is_item = r"^\d+\|"
    split = df.withColumn("_lines", F.split(source, r"\r?\n"))
    split = split.withColumns(
        {
            "_items": F.filter("_lines", lambda x: x.rlike(is_item)),
            "_labelled": F.filter("_lines", lambda x: x.contains(": ") & ~x.rlike(is_item)),
        }
    )
    split = split.withColumns(
        {
            "_labels": F.transform("_labelled", lambda x: F.substring_index(x, ": ", 1)),
            "_values": F.transform("_labelled", lambda x: F.substr(x, F.locate(": ", x) + 2)),
        }
    )

    def value(label: str) -> Column:
        return F.get("_values", F.array_position("_labels", label).cast("int") - 1)

    barcode = f"{BARCODE_LABEL}: "
    barcodes = F.transform(
        F.filter("_labelled", lambda x: x.startswith(barcode)), lambda x: F.substr(x, F.lit(len(barcode) + 1))
    )
    header = [
        (value(label).try_cast("double") if name in NUMBERS else value(label)).alias(name)
        for name, label in HEADER_LABELS.items()
    ]
    header += [
        F.struct(*[value(f"{prefix} {part.title()}").alias(part) for part in ADDRESS_PARTS]).alias(struct)
        for struct, prefix in ADDRESS_LABELS.items()
    ]
    header.append(
        F.struct(
            *[value(TERMS_LABELS[f.name]).try_cast(f.dataType).alias(f.name) for f in PAYMENT_TERMS.fields]
        ).alias("paymentTerms")
    )
    read = split.withColumn(
        "_read",
        F.struct(
            F.struct(*header).alias("invoiceHeader"),
            F.transform("_items", _item).alias("lineItems"),
            value(FLAGS_LABEL).alias("flags"),
            barcodes.alias("barcodes"),
        ),
    )
    found = F.coalesce(F.col("_read.invoiceHeader.invoiceNumber") != "", F.lit(False))
    error = F.when(F.col(source).isNull(), "no text").when(~found, "no invoice number found")
    response = F.when(found, F.to_variant_object("_read"))
    done = read.select(*df.columns, response.alias("response"), error.alias("error"))
    return pin(done, "response", "error")


def _item(line: Column) -> Column:
    cells = F.split(line, r"\|")
    return F.struct(
        *[F.get(cells, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(LINE_ITEM.fields)]
    )


def json_payload(df: DataFrame, source: str) -> DataFrame:
    """Read texts that already are JSON payloads."""
    error = F.when(F.col(source).isNull(), "no text").when(F.col("response").isNull(), "malformed payload")
    parsed = pin(df.withColumn("response", F.try_parse_json(source)), "response")
    return parsed.withColumn("error", error)


def extract_records(df: DataFrame, extractor: NativeExtractor = text_invoice, source: str = "input") -> DataFrame:
    """Add ``response`` and ``error`` by a native extractor."""
    return extractor(df, source)


def extract_records_python(df: DataFrame, fn: PythonExtractor, source: str = "input") -> DataFrame:
    """Add ``response`` and ``error`` by a Python function over Arrow batches.

    The function sees one text at a time; an exception, or a result that is not
    JSON, becomes that row's error.
    """

    def one(text: str | None) -> tuple[str | None, str | None]:
        if text is None:
            return None, "no text"
        try:
            return json.dumps(fn(text), allow_nan=False), None
        except Exception as e:  # noqa: BLE001 - any failure belongs to its row
            return None, f"{type(e).__name__}: {e}"

    @F.pandas_udf("json string, error string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["json", "error"], dtype="object")

    done = pin(df.withColumn("_done", run(F.col(source))), "_done")
    response = F.try_parse_json("_done.json")
    lost = F.when(F.col("_done.json").isNotNull() & response.isNull(), "result beyond the limits of JSON values")
    done = done.withColumn("response", response).withColumn("error", F.coalesce(F.col("_done.error"), lost))
    return done.drop("_done")


def run_inference(docs: DataFrame, extractor: NativeExtractor | None = None, fn: PythonExtractor | None = None) -> DataFrame:
    """Documents (path, text, ...) to responses; works on batches and streams."""
    renamed = docs.select(
        F.col("text").alias("input"),
        F.col("path").alias("source_file_path"),
        "modificationTime",
        "ingestion_timestamp",
        "summary",
        "document_type",
    )
    if fn is not None:
        return extract_records_python(renamed, fn)
    return extract_records(renamed, extractor or text_invoice)
