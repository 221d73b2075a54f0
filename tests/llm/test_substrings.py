import random
from collections import Counter

import pytest
import xxhash

from docrecords.llm import substrings as sub

SCHEMA = "doc_id long, text string, start string"


def brute(rows, min_run=sub.MIN_RUN):
    """Spans from a plain walk over documents in order."""
    first, found = {}, []
    texts = sorted({(d, t or "") for d, t, *_ in rows if d is not None})
    for doc, text in texts:
        data, begin, run = text.encode(), 0, None
        for n, end in enumerate([*sub.cuts(data).tolist(), None]):
            seen = None
            if end is not None:
                digest = xxhash.xxh3_64_intdigest(data[begin:end])
                seen = first.get(digest)
                first.setdefault(digest, (doc, n))
            if seen and run:
                run[2] = end
            elif seen:
                run = [doc, begin, end, seen[0]]
            elif run:
                found += [tuple(run)] if run[2] - run[1] >= min_run else []
                run = None
            begin = end
    return Counter(found)


def plain_cuts(data):
    """The hash rolled byte by byte."""
    h, ends = 0, []
    for i, b in enumerate(data[:-1], 1):
        h = (h * 2 + int(sub._GEAR[b])) % (1 << 32)
        if h >> (32 - sub._BITS) < sub._LOW and data[i] & 0xC0 != 0x80:
            ends.append(i)
    return [*ends, len(data)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnoprstué") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_cuts_equal_a_rolling_hash():
    data = prose(1, 3000).encode()
    assert max(b - a for a, b in zip([0, *plain_cuts(data)], plain_cuts(data))) <= sub.LONGEST
    assert sub.cuts(data).tolist() == plain_cuts(data)
    assert 18 < len(data) / len(plain_cuts(data)) < 30


@pytest.mark.parametrize("text", ["", "a", "é" * 3000, "x" * 100_000, "\U0001f600" * 999])
def test_cuts_stay_between_characters(text):
    data, begin = text.encode(), 0
    for end in sub.cuts(data).tolist():
        assert 0 < end - begin <= sub.LONGEST + 3
        data[begin:end].decode()
        begin = end
    assert begin == len(data)


def test_an_insertion_changes_little():
    data = prose(2, 4000).encode()
    other = data[:9000] + b"inserted words " + data[9000:]
    chunk = lambda d: Counter(d[a:b] for a, b in zip([0, *sub.cuts(d)], sub.cuts(d)))
    assert sum((chunk(other) - chunk(data)).values()) <= 3


def test_cuts_in_blocks(monkeypatch):
    data = prose(3, 4000).encode()
    whole = sub.cuts(data).tolist()
    monkeypatch.setattr(sub, "AT_ONCE", 1000)
    assert sub.cuts(data).tolist() == whole


def test_spans_and_removal(spark):
    passage, other = prose(10, 60), prose(11, 80)
    rows = [(i, prose(100 + i, 40) + " " + (passage if i % 2 else other) + " " + prose(200 + i, 40), "x") for i in range(30)]
    rows += [(50, rows[4][1], "x"), (51, prose(9, 30) + " " + prose(12, 8) + prose(13, 9), "x"), (52, prose(14, 30) + " " + prose(12, 8), "x")]
    rows += [(60, None, "x"), (61, "", "x"), (62, other + " " + other, "x"), (63, "y" * 5000, "x"), (64, prose(15, 50), "x"), (64, prose(15, 50), "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.place, r.start, r.end, r.kept_place) for r in sub.repeated_spans(docs).collect())
    assert got == brute(rows)
    spans = {}
    for doc, a, b, _ in got:
        spans.setdefault(doc, []).append((a, b))
    assert set(spans) >= {*range(2, 30), 50, 62, 63} and not set(spans) & {0, 1, 51, 52, 64}
    cleaned = sub.remove_repeats(docs).collect()
    assert len(cleaned) == len(rows)
    for r in cleaned:
        data = {d: t for d, t, _ in rows}[r.doc_id]
        if r.doc_id in spans:
            data = data.encode()
            for a, b in sorted(spans[r.doc_id], reverse=True):
                data = data[:a] + data[b:]
            data = data.decode()
        assert r.text == data


def test_documents_without_an_id(spark):
    text = prose(20, 100)
    docs = spark.createDataFrame([(None, text, "x"), (None, text + " more", "x"), (3, text, "x")], SCHEMA)
    got = sub.repeated_spans(docs).collect()
    assert len(got) == 2 and len({r.kept_place for r in got}) == 1 and all(r.kept_place < 0 for r in got)


def test_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = Counter((r.doc_id, r.start, r.end, r.kept_doc_id) for r in sub.op2_substrings(spark, sf_dir).collect())
    assert got == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert sub.repeated_spans(docs).collect() == [] and sub.remove_repeats(docs).collect() == []
