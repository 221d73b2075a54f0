import math
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from docrecords.llm import quality_rules as qr

TEXTS = [
    None, "", " \t\n", "one", "a b c", "a b c a b c", "x " * 100, "Line one\nLine one\n\n\nLine one \n", "A!! B## é*é " * 30,
    " ".join(f"w{i}" for i in range(3000)) + " tail w1 w2 w3", ("p q r s t\n" * 4000), "a\x0bb\x0cc\xa0d e",
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:]))
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    repeated, seen = 0, set()
    for x in lines:
        repeated += x in seen
        seen.add(x)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_statistics_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], "n")], "doc_id long, text string, n_words string")
    got = qr.text_statistics(df).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert tuple(r[n] for n in names) == brute(TEXTS[4 if r.doc_id is None else r.doc_id]), r


@pytest.mark.parametrize("n,k,a", [(10, 0, 0.05), (400, 3, 0.02), (5000, 0, 0.0025), (5000, 7, 0.0025), (200000, 450, 0.0025), (10, 10, 0.5), (0, 0, 0.5)])
def test_binomial_tail(spark, n, k, a):
    got = spark.sql(f"SELECT {qr.TAIL.format(a=a)} AS p FROM (SELECT {n}L AS n, {k}L AS k)").first().p
    if n == 0 or k >= a * n:
        assert got == 1
    else:
        log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(a) + (n - i) * math.log(1 - a)
        assert got == pytest.approx(sum(math.exp(log(i)) for i in range(k + 1)), rel=1e-6)


def test_cutoffs_are_the_strictest_that_are_certified(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    marked = " ".join(f"w{i}" for i in range(58)) + " a### b###"
    rows = [(i, clean if i % 50 else marked, "en") for i in range(1000)] + [(i, "*** " * 2 + clean, "xx") for i in range(1000, 1010)]
    docs = spark.createDataFrame([*rows, (None, clean, None), (5000, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1010)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in qr.quality_rules(docs, labels, alpha=0.02, delta=0.1).collect()}
    share = 1000 * got[0].n_symbols / got[0].word_chars
    stats = qr.text_statistics(docs, keep=("doc_id", "lang"))
    cut = {r.stratum: r for r in qr.cutoffs(stats, labels, "lang", 0.02, 0.1).collect()}
    # 2 % of the good documents exceed every cutoff below their share, as many as alpha allows on average.
    assert cut["en"].cut_symbols == min(c for c in qr.GRIDS["symbols"][2] if c >= share)
    assert cut["xx"].cut_symbols is None and got[1000].kept
    assert all(got[i].kept for i in range(1000)) and got[None].kept and not got[5000].kept


def test_rules_share_one_path(spark):
    """Two rules that each reject 1.5 % are not certified at 2 % together, though each alone would be."""
    row = lambda i, a, b: (i, "en", 100, 1000, a, 0, 100, b, 0, False)
    schema = "doc_id int, lang string, n_words int, word_chars int, n_symbols int, n_shouting int, n_lines int, n_dup_lines int, n_repeat_words int, base_failed boolean"
    labels = spark.createDataFrame([(i, 1) for i in range(20000)], "doc_id int, quality int")
    both = spark.createDataFrame([row(i, 35 if i % 200 < 3 else 0, 9 if i % 200 > 196 else 0) for i in range(20000)], schema)
    one = spark.createDataFrame([row(i, 35 if i % 200 < 3 else 0, 0) for i in range(20000)], schema)
    cut = {n: qr.cutoffs(df, labels, "lang", 0.02, 0.05).first() for n, df in (("both", both), ("one", one))}
    assert cut["one"].level == len(qr.PATH) - 1
    level = cut["both"].level
    fails = lambda p: 35 > p["symbols"], lambda p: 90 > p["dup_lines"]
    assert level < len(qr.PATH) - 1 and not all(f(qr.PATH[level]) for f in fails) and all(f(qr.PATH[level + 1]) for f in fails)


def test_guarantee_holds_on_the_whole_population(spark):
    """Shares are exponential, so the true rejection of each cutoff is known: none above alpha, and cutoffs are of use."""
    rng, alpha, strata = np.random.default_rng(8), 0.02, 60
    scales = rng.uniform(3, 60, strata)
    shares = pd.DataFrame({"lang": np.repeat([f"s{i}" for i in range(strata)], 1500), "share": np.concatenate([rng.exponential(s, 1500) for s in scales])})
    stats = spark.createDataFrame(shares).selectExpr(
        "monotonically_increasing_id() AS doc_id", "lang", "cast(share * 1000 AS long) AS n_symbols", "1000000L AS word_chars",
        "0L AS n_shouting", "0L AS n_dup_lines", "1L AS n_lines", "0L AS n_repeat_words", "100L AS n_words", "false AS base_failed",
    )
    labels = stats.selectExpr("doc_id", "1 AS quality")
    cuts = {int(r.stratum[1:]): r.cut_symbols for r in qr.cutoffs(stats, labels, "lang", alpha, 0.05).collect()}
    assert all(c is None or math.exp(-c / scales[i]) <= alpha for i, c in cuts.items())
    assert sum(c is not None for c in cuts.values()) > strata * 0.9


def test_query_equals_sql_where_cutoffs_are_certified(spark, tmp_path):
    """500 good texts a language are enough; shouted and symbol texts without label are then rejected."""
    text = lambda i: " ".join(f"word{i}x{k}" for k in range(60))
    rows = [(i, text(i) + (" $$$ ### " * 9 if i % 25 == 0 else ""), ("en", "de", None)[i % 3], "a", 1) for i in range(2100)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 25 > 0), 0) for i in range(0, 2000)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(tuple(r) for r in qr.op5_quality_rules(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == sorted(con.sql(qr.SQL).fetchall())
    assert all(r[-1] == (r[0] % 25 > 0) for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert qr.quality_rules(docs, labels).collect() == []
    one = spark.createDataFrame([(1, " ".join(map(str, range(60))), "en")], docs.schema)
    assert qr.quality_rules(one, labels).first().kept
