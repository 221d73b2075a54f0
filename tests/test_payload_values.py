"""Kinds of payload values, and what building the invoices must not repeat."""

import re

from docrecords.operators import canonical, validate
from docrecords.plans.records import ITEMS
from docrecords.operators import merge
from verify import bindings as b

PAYLOADS = {
    "good": '{"invoiceHeader": {"invoiceNumber": "a", "totalAmount": 1.5, "paymentTerms": {"termsNetDuedays": 3}}, "lineItems": [{"lineNumber": 1, "productCode": "p", "uom": "u", "quantityShipped": 1, "weightShipped": 1.0, "unitPrice": 2, "lineTotal": 2}]}',
    "header": '{"invoiceHeader": {"totalAmount": "much", "branch": null, "paymentTerms": {"termsNetDuedays": 1.5, "termsDiscountDueDays": null}, "shippingAddress": "street"}}',
    "lines": '{"lineItems": [null, 7, {"lineNumber": 1.5, "unitPrice": [1]}, {"lineNumber": null, "lineTotal": "1e1"}, {"lineNumber": "one"}]}',
    "none": '{"invoiceHeader": 5, "lineItems": {"lineNumber": "x"}}',
}


def test_kinds_of_values(spark):
    rows = spark.createDataFrame(list(PAYLOADS.items()), "source_file_path string, text string").selectExpr("source_file_path", "try_parse_json(text) as response")
    found = {(r[0], r["field"], r["value"]) for r in validate.validate_payload_values(rows).collect()}
    assert found == {
        ("header", "totalAmount", '"much"'), ("header", "paymentTerms.termsNetDuedays", "1.5"), ("header", "shippingAddress", '"street"'),
        ("lines", "lineItems[1]", "7"), ("lines", "lineItems[2].lineNumber", "1.5"), ("lines", "lineItems[2].unitPrice", "[1]"),
        ("lines", "lineItems[4].lineNumber", '"one"'),
    }


def test_values_are_read_a_few_times(spark, plan):
    rows = spark.createDataFrame([("a", "{}")], "source_file_path string, text string").selectExpr("source_file_path", "try_parse_json(text) as response")
    assert plan(validate.validate_payload_values(rows)).count("variant_get") < 30


def test_lines_are_shuffled_once_and_by_the_columns_that_are_read(spark, sf_dir, plan):
    text = plan(b.invoices(spark, sf_dir))
    assert "Window" not in text and "l_shipdate" not in text
    assert len(re.findall(r"l_suppkey", text)) and text.count("lineitem.parquet") == 1


def test_both_extractions_read_the_same_shuffled_lines(spark, sf_dir, plan):
    p, f = [canonical.flatten(side, extra=ITEMS) for side in b.extractions(spark, sf_dir)]
    pairs = merge.pair_sources(p, f, columns=["line_items"])
    pairs.collect()
    assert "l_orderkey#" in plan(pairs) and not re.search(r"l_orderkey#\d+L? % (7|11)", plan(pairs))
