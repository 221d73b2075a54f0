"""Payload, merge and difference edge cases, and their algebra."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docrecords.operators import canonical, extract, merge, quality, validate
from docrecords.schemas import CANONICAL, COMPARED_COLUMNS, FIELDS
from docrecords.sources.tables import conform
from verify import bindings as b

AS_OF = datetime(2025, 9, 20)


def responses(spark, payloads):
    rows = [(p if isinstance(p, str) else json.dumps(p), f"/in/{i}.pdf") for i, p in enumerate(payloads)]
    docs = spark.createDataFrame(rows, "text string, path string").selectExpr(
        "text", "path", "current_timestamp() modificationTime", "current_timestamp() ingestion_timestamp",
        "'s' summary", "'invoice' document_type",
    )
    return extract.run_inference(docs, extract.json_payload)


def records(spark, payloads):
    df = canonical.canonicalize(responses(spark, payloads), as_of=AS_OF)
    return [r for r in df.orderBy("source_file_path").collect()]


def header(**fields):
    return {"invoiceHeader": fields}


def test_payload_nulls(spark):
    null, absent, full = records(
        spark,
        [
            header(shippingAddress=None, invoiceNumber="A"),
            header(invoiceNumber="B"),
            header(invoiceNumber="C", branch="003", shippingAddress={"city": "X"}, paymentTerms={"termsNetDuedays": 30}),
        ],
    )
    assert null.invoice_header.shippingAddress is None
    assert absent.invoice_header.shippingAddress is None
    assert full.invoice_header.branch == "003"
    assert full.invoice_header.shippingAddress.asDict() == {"address": None, "city": "X", "state": None, "zip": None}
    assert full.invoice_header.paymentTerms.termsNetDuedays == 30
    assert null.line_items is None and null.barcodes is None


def test_payload_bad_values(spark):
    (r,) = records(spark, [header(totalAmount="abc", freightAmount="1.5", orderNumber=7)])
    assert r.invoice_header.totalAmount is None
    assert r.invoice_header.freightAmount == 1.5
    assert r.invoice_header.orderNumber == "7"


def test_payload_without_header(spark):
    (r,) = records(spark, [{"flags": "OK"}])
    assert r.invoice_header is not None and r.invoice_header.invoiceNumber is None
    assert r.flags == "OK"


@pytest.mark.parametrize("items", [[], None, "absent"])
def test_no_lines(spark, items):
    payload = header(invoiceNumber="A")
    if items != "absent":
        payload["lineItems"] = items
    flat = canonical.flatten(canonical.canonicalize(responses(spark, [payload])))
    assert flat.first()["line_items_count"] == 0


def test_line_with_a_bad_number(spark):
    payload = header(invoiceNumber="A") | {"lineItems": [{"lineNumber": 1.5, "uom": "BOX"}]}
    (r,) = records(spark, [payload])
    assert [(x.lineNumber, x.uom) for x in r.line_items] == [(None, "BOX")]


def test_truncated_payload_is_an_error(spark):
    df = responses(spark, ['{"invoiceHeader": {"inv', header(invoiceNumber="B")])
    assert [r["error"] for r in df.orderBy("source_file_path").collect()] == ["malformed payload", None]


def test_python_extractor_isolates_failures(spark):
    docs = spark.createDataFrame([("1", "/a"), ("x", "/b"), (None, "/c")], "text string, path string").selectExpr(
        "text", "path", "current_timestamp() modificationTime", "current_timestamp() ingestion_timestamp",
        "'s' summary", "'invoice' document_type",
    )
    done = extract.run_inference(docs, fn=lambda t: {"n": int(t)})
    found = done.select("source_file_path", F.to_json("response"), "error").orderBy("source_file_path").collect()
    assert found[0][1] == '{"n":1}' and found[0][2] is None
    assert found[1][1] is None and found[1][2].startswith("ValueError")
    assert found[2][2] == "no text"


def test_text_invoice_without_number(spark):
    docs = spark.createDataFrame([("Branch: 003",), ("Invoice Number: A\n1|P|BOX|2|0|3.5|7",)], "input string")
    found = extract.extract_records(docs).select("error", F.to_json("response")).collect()
    assert found[0][0] == "no invoice number found" and found[0][1] is None
    assert json.loads(found[1][1])["lineItems"][0]["lineTotal"] == 7


def test_flatten_and_renest_are_inverse(spark, sf_dir, rows):
    flat = canonical.flatten(b.fallback(spark, sf_dir))
    again = canonical.flatten(canonical.renest(flat))
    assert rows(flat) == rows(again)


def flat(spark, **values):
    record = {"source_file_path": "/in/1.pdf", "source_file_name": "1.pdf", "line_items_count": 0, **values}
    schema = canonical.flatten(spark.createDataFrame([], CANONICAL)).schema
    return spark.createDataFrame([tuple(record.get(f.name) for f in schema.fields)], schema)


def test_merge_prefers_values_that_say_something(spark):
    p = flat(spark, vendorName=" N/A ", totalAmount=0.0, summary="p", barcodes=[], shipping_city="", flags="")
    f = flat(spark, vendorName="V", totalAmount=5.0, summary="f", barcodes=["b"], shipping_city=" ", flags="F",
             line_items_json='[{"lineNumber":1}]', line_items_count=1)
    r = merge.merge_sources(p, f).first()
    assert r.invoice_header.vendorName == "V"
    assert r.invoice_header.totalAmount == 0.0
    assert r.summary == "f"
    assert r.barcodes == ["b"]
    assert r.invoice_header.shippingAddress is None
    assert r.flags == ""
    assert r.line_items[0].lineNumber == 1


def test_merge_with_itself(spark, sf_dir, rows):
    f = canonical.flatten(b.fallback(spark, sf_dir)).withColumn("branch", F.lit("001"))
    final = canonical.final_records(merge.merge_sources(f, f))
    columns = [x.name for x in FIELDS if x.name not in ("line_items_json",)]
    assert rows(final, *columns) == rows(f, *columns)


def test_merge_keeps_rows_without_a_path(spark):
    p = flat(spark, source_file_path=None, branch="1")
    f = flat(spark, source_file_path=None, branch="2")
    assert merge.merge_sources(p, f).count() == 2


def statuses(p, f, **options):
    row = quality.field_status(p, f, **options).first()
    return {n for n in COMPARED_COLUMNS if row[f"{n}_status"] == "DIFF"}


def test_null_equals_the_empty_value(spark):
    p = flat(spark, vendorName=None, totalAmount=None, invoiceDate=None, barcodes=None, termsNetDuedays=None)
    f = flat(spark, vendorName="", totalAmount=0.0, invoiceDate=date(1900, 1, 1), barcodes=[], termsNetDuedays=0)
    assert statuses(p, f) == {"barcodes"}
    strict = statuses(p, f, null_safe=True)
    assert strict == {"barcodes", "vendorName", "totalAmount", "invoiceDate", "termsNetDuedays"}


def test_report(spark, sf_dir):
    p = flat(spark, input="x" * 150, totalAmount=1.0, source_volume_path="/in/", shipping_address="s" * 120)
    whole = quality.field_diff_report(p, flat(spark, shipping_address="t")).first()
    assert whole.input_diff == 'OCR: "' + "x" * 150 + '..." | AI: "NULL..."'
    cut = {"long": 100, "address": 100, "clipped": 200}
    r = quality.field_diff_report(p, flat(spark, shipping_address="t"), cut=cut).first()
    assert r.different_columns == "input, source_volume_path, totalAmount, shipping_address"
    assert r.total_differences == 4
    assert r.input_diff == 'OCR: "' + "x" * 100 + '..." | AI: "NULL..."'
    assert r.totalAmount_diff == "OCR: 1.0 | AI: NULL"
    assert r.shipping_address_diff == 'OCR: "' + "s" * 100 + '" | AI: "t"'
    assert "source_volume_path_diff" not in r.asDict()
    same = canonical.flatten(b.primary(spark, sf_dir))
    assert quality.field_diff_report(same, same).count() == 0


def test_rules(spark):
    (good,) = [
        header(
            orderNumber="O", vendorName="V", invoiceNumber="I", invoiceDate="2025-01-31", purchaseOrderNumber="P",
            branch="001", warehouse="002", discountAmount=0, freightAmount=0, totalAmount=6, subtotalAmount=6,
            shippingAddress={"address": "a", "city": "c", "state": "CO", "zip": "80019-3608"},
            remittanceAddress={"address": "a", "city": "c", "state": "CA", "zip": "91185"},
            paymentTerms={"termsNetDuedays": 30},
        )
    ]
    good |= {
        "lineItems": [
            {"lineNumber": n, "productCode": "p", "uom": "BOX", "quantityShipped": 2, "weightShipped": 0,
             "unitPrice": 1.5, "lineTotal": 3} for n in (1, 2)
        ],
        "flags": "OK",
        "barcodes": ["I"],
    }
    bad = json.loads(json.dumps(good))
    bad["invoiceHeader"] |= {"vendorName": " ", "branch": "7", "invoiceDate": "2025-02-30", "totalAmount": -1,
                             "subtotalAmount": 7, "paymentTerms": None}
    bad["lineItems"][1] |= {"lineNumber": 3, "uom": "", "lineTotal": 4}
    bad["barcodes"] = ["I", "I"]
    df = canonical.canonicalize(responses(spark, [good, bad]))
    found = {(r.source_file_path, r.rule, r.field) for r in validate.validate(df).collect()}
    assert found == {
        ("/in/1.pdf", rule, field)
        for rule, field in [
            ("required", "paymentTerms"),
            ("not_blank", "vendorName"),
            ("not_blank", "lineItems[3].uom"),
            ("pattern", "branch"),
            ("iso_date", "invoiceDate"),
            ("not_negative", "totalAmount"),
            ("line_sequence", "lineItems.lineNumber"),
            ("line_total", "lineItems[3].lineTotal"),
            ("unique", "barcodes"),
        ]
    }
    loose = validate.Rules(tolerance=0.5)
    changed = validate.validate(df, ["subtotal"], validate.Rules(tolerance=0.0)).count()
    assert changed == 0 and validate.validate(df, ["line_total"], loose).count() == 1


def test_conform_pairs_struct_fields_by_name(spark):
    df = spark.sql("select named_struct('city', 'C', 'address', 'A', 'zip', 'Z', 'state', 'S') as a")
    want = CANONICAL["invoice_header"].dataType["shippingAddress"].dataType
    from pyspark.sql import types as T

    r = conform(df, T.StructType([T.StructField("a", want)])).first()
    assert r.a.asDict() == {"address": "A", "city": "C", "state": "S", "zip": "Z"}
