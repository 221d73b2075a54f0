"""Operator inputs derived from the given tables.

* ``files``: an intake listing made of ``documents``
* ``headers`` / ``invoices``: one invoice per order
* ``payloads``, ``text_invoices``: invoices as JSON and as text
* ``primary`` / ``fallback``: two extractions that disagree in known places
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.operators.extract import (
    ADDRESS_LABELS,
    BARCODE_LABEL,
    FLAGS_LABEL,
    HEADER_LABELS,
    TERMS_LABELS,
)
from docrecords.operators.rows import pin
from docrecords.schemas import ADDRESS_PARTS, CANONICAL, INVOICE_HEADER, LINE_ITEM, PAYMENT_TERMS
from docrecords.session import configure
from docrecords.sources.tables import conform

INGESTED = "2025-09-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- files ------------------------------------------------------------------------


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, path, text, modificationTime, ingestion_timestamp, length."""
    suffix = (
        F.when(F.col("doc_id") % 6 == 0, ".pdf")
        .when(F.col("doc_id") % 6 == 1, ".PDF")
        .when(F.col("doc_id") % 6 == 2, ".jpg")
        .when(F.col("doc_id") % 6 == 3, ".png")
        .when(F.col("doc_id") % 6 == 4, ".txt")
        .otherwise("")
    )
    path = F.concat(
        F.lit("/intake/"), "source", F.lit("/"), "lang", F.lit("/doc_"), F.col("doc_id").cast("string"), suffix
    )
    hours = F.make_dt_interval(F.lit(0), F.col("doc_id").cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        path.alias("path"),
        "text",
        (F.lit("2025-08-25 00:00:00").cast("timestamp_ntz") + hours).alias("modificationTime"),
        F.lit(INGESTED).cast("timestamp_ntz").alias("ingestion_timestamp"),
        F.col("n_chars").alias("length"),
    )


def with_content(listing: DataFrame) -> DataFrame:
    """The listing with the text as bytes."""
    return listing.withColumn("content", F.encode("text", "UTF-8")).drop("text")


def ledger(listing: DataFrame) -> DataFrame:
    """Files processed earlier."""
    return listing.filter(F.col("doc_id") % 3 == 0).select("path", "modificationTime")


# --- invoices ---------------------------------------------------------------------


#: Their order numbers the lines of an order; lines that are equal in it are equal in all that is read of them.
LINE_COLUMNS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """l_orderkey, line_items in order, sk (the least supplier); the lines are shuffled once."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    found = lines.agg(F.sort_array(F.collect_list(F.struct(*LINE_COLUMNS))).alias("found"), F.min("l_suppkey").alias("sk"))
    return found.select("l_orderkey", F.transform("found", _line_item).alias("line_items"), "sk")


def _line_item(x: Column, i: Column) -> Column:
    uom = F.when(x["l_partkey"] % 3 == 0, "CASE").when(x["l_partkey"] % 3 == 1, "EACH").otherwise("BOX")
    return F.struct(
        (i + 1).alias("lineNumber"),
        F.concat(F.lit("P"), F.lpad(x["l_partkey"].cast("string"), 6, "0")).alias("productCode"),
        uom.alias("uom"),
        x["l_quantity"].alias("quantityShipped"),
        F.lit(0.0).alias("weightShipped"),
        (x["l_extendedprice"] / x["l_quantity"]).alias("unitPrice"),
        x["l_extendedprice"].alias("lineTotal"),
    )


def crowded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which every third belongs to one order, 0; amounts in cents."""
    k = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey").cast("bigint"))
    return table(spark, sf_dir, "lineitem").select(
        k.alias("k"),
        F.col("l_orderkey").cast("bigint").alias("first_order"),
        F.col("l_linenumber").cast("int").alias("lineNumber"),
        F.col("l_partkey").cast("bigint").alias("part"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("double").alias("quantityShipped"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unitPrice"),
        (F.col("l_extendedprice") + F.when(F.col("l_partkey") % 11 == 0, 1.0).otherwise(0.0)).alias("lineTotal"),
    )


def line_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, line_items in order."""
    return _lines_by_order(spark, sf_dir).select(F.col("l_orderkey").alias("k"), "line_items")


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per invoice with the scalar fields, all clean."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk"))
    return _header_columns(_billed_orders(spark, sf_dir, lines))


def _billed_orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Orders with customer, nation, what ``lines`` has of them, and supplier."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(supplier, F.col("sk") == F.col("s_suppkey"), "left")
    )


def _header_columns(df: DataFrame, *more: str) -> DataFrame:
    k, cust, placed = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    # Day formats of the three regular kinds of date text.
    date_text = (
        F.when(k % 4 == 0, F.date_format(placed, "yyyy-MM-dd"))
        .when(k % 4 == 1, F.date_format(placed, "MM/dd/yyyy"))
        .when(k % 4 == 2, F.date_format(placed, "M/d/yyyy"))
        .otherwise("pending")
    )
    state = (
        F.when(F.col("n_regionkey") == 0, "CO")
        .when(F.col("n_regionkey") == 1, "CA")
        .when(F.col("n_regionkey") == 2, "Tx")
        .otherwise("NY")
    )
    return df.select(
        k.alias("k"),
        F.concat(F.lit("/intake/inv/"), (cust % 10).cast("string"), F.lit("/inv_"), k.cast("string"), F.lit(".pdf")).alias(
            "source_file_path"
        ),
        F.concat(F.lit("IN-"), F.lpad(k.cast("string"), 8, "0")).alias("invoiceNumber"),
        F.concat(F.lit("SO-"), F.lpad(k.cast("string"), 6, "0")).alias("orderNumber"),
        F.lpad(cust.cast("string"), 9, "0").alias("purchaseOrderNumber"),
        F.col("s_name").alias("vendorName"),
        F.when(k % 5 != 0, F.col("s_suppkey").cast("string")).alias("vendorNumber"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("branch"),
        F.when(k % 13 == 0, "7").otherwise(F.lpad((cust % 100).cast("string"), 3, "0")).alias("warehouse"),
        date_text.alias("invoiceDate"),
        F.col("o_totalprice").alias("totalAmount"),
        F.when(k % 17 == 0, F.lit(-1.0)).otherwise(F.lit(0.0)).alias("freightAmount"),
        F.col("c_name").alias("shipping_address"),
        F.col("n_name").alias("shipping_city"),
        state.alias("shipping_state"),
        F.lpad(cust.cast("string"), 5, "0").alias("shipping_zip"),
        F.when(k % 3 == 0, F.lit(30)).alias("termsNetDuedays"),
        *more,
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with their lines; both sides are unique on the order.

    The arrays grow with the data, so they are never broadcast. The text columns are
    made after the join, so that only the base columns are shuffled.
    """
    lines = _lines_by_order(spark, sf_dir).hint("merge")
    return _header_columns(_billed_orders(spark, sf_dir, lines), "line_items")


def _header_struct(df: DataFrame) -> Column:
    """The nested header; fields the data frame lacks are NULL."""
    have = set(df.columns)

    def leaf(name: str, kind) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(kind)

    parts = []
    for f in INVOICE_HEADER.fields:
        if f.name in ("shippingAddress", "remittanceAddress"):
            prefix = f.name.removesuffix("Address")
            if f"{prefix}_address" in have:
                c = F.struct(*[leaf(f"{prefix}_{p}", "string").alias(p) for p in ADDRESS_PARTS])
            else:
                c = F.lit(None).cast(f.dataType)
        elif f.name == "paymentTerms":
            c = F.struct(*[leaf(t.name, t.dataType).alias(t.name) for t in PAYMENT_TERMS.fields])
        else:
            c = leaf(f.name, f.dataType)
        parts.append(c.alias(f.name))
    return F.struct(*parts)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text is a JSON payload: k, path, ..., text, document_type.

    Every 19th payload is cut in half, every 23rd document is a receipt.
    """
    df = invoices(spark, sf_dir)
    content = F.to_json(
        F.struct(
            _header_struct(df).alias("invoiceHeader"),
            F.col("line_items").alias("lineItems"),
            F.lit("OK").alias("flags"),
            F.array("invoiceNumber").alias("barcodes"),
        ),
        {"ignoreNullFields": "false"},
    )
    whole = df.select("k", "source_file_path", content.alias("payload"))
    half = F.left("payload", F.expr("cast(length(payload) div 2 as int)"))
    stamp = F.lit(INGESTED).cast("timestamp")
    return whole.select(
        "k",
        F.col("source_file_path").alias("path"),
        stamp.alias("modificationTime"),
        stamp.alias("ingestion_timestamp"),
        F.when(F.col("k") % 19 == 0, half).otherwise(F.col("payload")).alias("text"),
        F.lit(None).cast("string").alias("summary"),
        F.when(F.col("k") % 23 == 0, "receipt").otherwise("invoice").alias("document_type"),
    )


def text_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text is an invoice: one 'Label: value' line per field, one line per item."""
    df = invoices(spark, sf_dir)
    have = set(df.columns)
    labels = dict(HEADER_LABELS) | TERMS_LABELS
    for struct, prefix in ADDRESS_LABELS.items():
        for part in ADDRESS_PARTS:
            labels[f"{struct.removesuffix('Address')}_{part}"] = f"{prefix} {part.title()}"
    lines = [
        F.concat(F.lit(f"{label}: "), F.col(name).cast("string")) for name, label in labels.items() if name in have
    ]
    lines.append(F.lit(f"{FLAGS_LABEL}: OK"))
    lines.append(F.concat(F.lit(f"{BARCODE_LABEL}: "), "invoiceNumber"))
    items = F.array_join(
        F.transform(
            "line_items", lambda x: F.concat_ws("|", *[x[f].cast("string") for f in LINE_ITEM.fieldNames()])
        ),
        "\n",
    )
    text = F.concat_ws("\n", F.lit("Invoice"), *lines, items)
    return df.select("k", F.col("source_file_path").alias("path"), text.alias("text"))


# --- two extractions ----------------------------------------------------------------


def primary_flat(df: DataFrame) -> DataFrame:
    """Blanks, 'N/A', missing totals and missing files; changed lines and subtotals."""
    k = F.col("k")
    return df.filter(k % 7 != 0).withColumns(
        {
            "vendorName": F.when(k % 6 == 0, " ").when(k % 6 == 1, "N/A").otherwise(F.col("vendorName")),
            "totalAmount": F.when(k % 8 != 0, F.col("totalAmount")),
            "shipping_address": F.when(k % 10 == 0, "").otherwise(F.col("shipping_address")),
        }
    )


def fallback_flat(df: DataFrame) -> DataFrame:
    """Different gaps, some changed totals."""
    k = F.col("k")
    return df.filter(k % 11 != 0).withColumns(
        {
            "branch": F.when(k % 9 == 0, "na").otherwise(F.col("branch")),
            "totalAmount": F.when(k % 12 == 0, F.col("totalAmount") + 1.0).otherwise(F.col("totalAmount")),
            "freightAmount": F.lit(0.0),
            "shipping_state": F.upper("shipping_state"),
            "termsNetDuedays": F.lit(15),
        }
    )


def _primary_lines() -> Column:
    """None for every 9th order; shifted numbers for every 31st; a wrong total in some lines."""
    changed = F.transform(
        "line_items",
        lambda x: F.struct(
            (x["lineNumber"] + F.when(F.col("k") % 31 == 0, 1).otherwise(0)).cast("int").alias("lineNumber"),
            x["productCode"].alias("productCode"),
            x["uom"].alias("uom"),
            x["quantityShipped"].alias("quantityShipped"),
            x["weightShipped"].alias("weightShipped"),
            x["unitPrice"].alias("unitPrice"),
            F.when((F.col("k") + x["lineNumber"]) % 29 == 0, x["lineTotal"] + 1.0)
            .otherwise(x["lineTotal"])
            .alias("lineTotal"),
        ),
    )
    return F.when(F.col("k") % 9 != 0, changed)


def _subtotal() -> Column:
    """The exact sum of the lines, off by 5 for every 14th order from 3; NULL without lines."""
    cents = F.aggregate(
        "line_items",
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.round(x["lineTotal"] * 100).cast("long"),
    )
    return cents / F.lit(100.0) + F.when(F.col("k") % 14 == 3, 5.0).otherwise(0.0)


def _barcodes() -> Column:
    n = F.col("invoiceNumber")
    return F.when(F.col("k") % 37 == 0, F.array(n, n)).when(F.col("k") % 5 == 1, F.array().cast("array<string>")).otherwise(
        F.array(n)
    )


def _records(df: DataFrame) -> DataFrame:
    stamp = F.lit(INGESTED).cast("timestamp")
    nested = df.withColumns(
        {
            "invoice_header": _header_struct(df),
            "source_file_name": F.element_at(F.split("source_file_path", "/"), -1),
            "source_volume_path": F.regexp_extract("source_file_path", r"^(.*/)([^/]+)$", 1),
            "modificationTime": stamp,
            "ingestion_timestamp": stamp,
            "processing_timestamp": stamp,
            "document_type": F.lit("invoice"),
        }
    )
    return conform(nested, CANONICAL)


def extractions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both extractions of the same invoices.

    Each leaves out other orders. The key is pinned, so that these filters stay above the
    joins and both sides read the same shuffled tables.
    """
    billed = pin(invoices(spark, sf_dir), "k")
    return primary(spark, sf_dir, billed), fallback(spark, sf_dir, billed)


def primary(spark: SparkSession, sf_dir: str, billed: DataFrame | None = None) -> DataFrame:
    """Extraction 1 as canonical records."""
    df = primary_flat(invoices(spark, sf_dir) if billed is None else billed)
    return _records(
        df.withColumns(
            {
                "summary": F.when(F.col("k") % 4 == 1, "from the first source"),
                "flags": F.when(F.col("k") % 21 == 0, "").otherwise("OK"),
                "subtotalAmount": _subtotal(),
                "barcodes": _barcodes(),
                "line_items": _primary_lines(),
            }
        )
    )


def fallback(spark: SparkSession, sf_dir: str, billed: DataFrame | None = None) -> DataFrame:
    """Extraction 2 as canonical records."""
    df = fallback_flat(invoices(spark, sf_dir) if billed is None else billed)
    return _records(
        df.withColumns(
            {
                "summary": F.when(F.col("k") % 2 == 1, "from the second source"),
                "flags": F.lit("OK"),
                "barcodes": F.array("invoiceNumber"),
            }
        )
    )
