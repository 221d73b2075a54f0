"""Edge values of the column expressions."""

from datetime import date

from pyspark.sql import functions as F

from docrecords.functions import markup
from docrecords.functions.text import (
    decode_text,
    directory,
    extension,
    file_name,
    lead_sentences,
    normalize_date,
    nz,
    register_nz,
)


def values(spark, items, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_dates(spark):
    cases = [
        ("2025-08-28", date(2025, 8, 28), date(2025, 8, 28)),
        ("08/28/2025", date(2025, 8, 28), date(2025, 8, 28)),
        ("8/2/2025", None, date(2025, 8, 2)),
        ("08/28/25", None, date(2025, 8, 28)),
        ("Date:08/28/2025", None, date(2025, 8, 28)),
        ("2025-02-30", None, None),
        ("Aug 28", None, None),
        ("", None, None),
        (None, None, None),
    ]
    found = values(spark, [c[0] for c in cases], normalize_date("v"), normalize_date("v", lenient=True))
    assert found == [c[1:] for c in cases]


def test_nz(spark):
    cases = [None, "", "  ", "N/A", " na ", "NA", " x ", "null", "0"]
    wanted = [None] * 6 + [" x ", "null", "0"]
    assert [v for (v,) in values(spark, cases, nz("v"))] == wanted
    register_nz(spark)
    assert [v for (v,) in values(spark, cases, F.expr("nz(v)"))] == wanted


def test_paths(spark):
    found = values(spark, ["/a/b.pdf", "b.pdf", "/a/", None], file_name("v"), directory("v"), extension("v"))
    assert found == [("b.pdf", "/a/", "pdf"), ("b.pdf", "", "pdf"), ("", "", ""), (None, None, None)]


def test_bad_bytes_do_not_fail(spark):
    df = spark.createDataFrame([(bytearray(b"\xffA"),)], "content binary")
    assert df.select(decode_text("content")).first()[0] == "�A"


def test_lead_sentences(spark):
    text = "One is 1.5 long. Two!  Three?\nFour. Five."
    assert values(spark, [text], lead_sentences("v", 3, 2000)) == [("One is 1.5 long. Two! Three?",)]
    assert values(spark, ["no end"], lead_sentences("v", 3, 2000)) == [("no end",)]


def test_html(spark):
    html = (
        "<title>T &amp; U</title><script>var t='<p>x</p>';</script><style>p{}</style><!-- <p>gone</p> -->"
        "<p>One<br>Two <b>bold</b></p>tail"
        "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2|3</td></tr></table><P CLASS=x>&#65;&#x42;&lt;c&gt;"
    )
    df = spark.createDataFrame([(html,)], "html string")
    found = df.select(F.inline(markup.elements(F.col("html")))).collect()
    table = "| a | b |\n| --- | --- |\n| 1 | 2\\|3 |"
    assert [tuple(r) for r in found] == [
        ("title", "T & U"),
        ("p", "One"),
        ("br", "Two bold"),
        ("text", "tail"),
        ("table", table),
        ("p", "AB<c>"),
    ]
    text = df.select(markup.markdown(F.col("html"))).first()[0]
    assert text == f" T & U One Two bold tail\n{table}\n AB<c>"
