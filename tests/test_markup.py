"""Pages that nothing closes: same elements as before, and time that grows with the page."""

import time

import pytest
from pyspark.sql import functions as F

from docrecords.functions import markup


def elements(spark, *pages):
    rows = spark.createDataFrame([(p,) for p in pages], "html string").select(markup.elements(F.col("html")).alias("e"))
    return [None if r["e"] is None else [(e["tag"], e["content"]) for e in r["e"]] for r in rows.collect()]


def test_unclosed_parts(spark):
    found = elements(
        spark,
        "<p>a<!-- gone --> b <!-- open c<p>d",
        "<script>x</script>y<script>z<p>w <STYLE>v",
        "<table><tr><td>1</td></tr></table>t<table><tr><td>2",
        "1 < 2 <b>bold</b> 3 < 4",
        "<!-- a <script> --> b </script> c",
        None,
        "",
    )
    assert found[0] == [("p", "a b <!-- open c"), ("p", "d")]
    assert found[1] == [("text", "yz"), ("p", "w v")]
    assert found[2][0] == ("table", "| 1 |\n| --- |") and [e[1] for e in found[2][1:]] == ["t", "2"]
    assert found[3] == [("text", "1 bold 3 < 4")]
    assert found[4] == [("text", "b c")] and found[5:] == [None, []]


@pytest.mark.parametrize("part", ["<!-- a ", "<script> a ", "<style>", "<table> a ", "< a ", "<!--<script><table", "<td>a<tr>"])
def test_time_grows_with_the_page(spark, part):
    def seconds(n):
        df = spark.createDataFrame([(part * n,)], "html string").select(markup.elements(F.col("html")).alias("e"))
        start = time.time()
        df.write.format("noop").mode("overwrite").save()
        return time.time() - start

    seconds(100)
    assert seconds(100_000) < 20
