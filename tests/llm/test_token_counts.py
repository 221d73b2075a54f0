import public_tokenizers
from tokenizers import Tokenizer

from docrecords.llm import token_counts as tc

TEXTS = [
    "Plain words, and more; it's HERE'S 12345!!", "", "  \t\n ", "<|startoftext|>x<|endoftext|> y <|startoft", "a\x1cb\x85c d e",
    "ﬁ Ǆ İstanbul ΟΔΥΣΣΕΥΣ é 日本語テキスト \U0001f600\U0001f600", "x" * 5000, "word " * 3000, "éèç" * 700 + " 'll've",
]


def library():
    return Tokenizer.from_file(public_tokenizers.path(tc.VOCABULARY))


def test_counts_equal_the_library(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, None, None), (0, TEXTS[0], "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = tc.token_counts(df).collect()
    whole = library()
    want = sorted(((i, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = library()
    got = {r.doc_id: r.n_tokens for r in tc.token_counts(docs.select("doc_id", "text")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == len(whole.encode(r.text, add_special_tokens=False).ids)


def test_prefixes():
    counter, whole = tc.WordCounter(public_tokenizers.path(tc.VOCABULARY)), library()
    count = lambda s: len(whole.encode(s, add_special_tokens=False).ids)
    for text in TEXTS[:6]:
        data = text.encode()
        table = counter.prefix_table(data)
        for k in range(len(text) + 1):
            assert counter.prefix_count(data, *table, len(text[:k].encode())) == count(text[:k]), (text, k)
        for budget in range(count(text) + 1):
            fit = data[: counter.longest_prefix(data, *table, budget)].decode()
            fits = [k for k in range(len(text) + 1) if count(text[:k]) <= budget]
            assert count(fit) <= budget and fit.rstrip(" \t\n") == text[: fits[-1]].rstrip(" \t\n")


def test_empty_table(spark):
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
