"""The conversation trie against a plain walk over all prefixes."""

import hashlib
import random
from collections import defaultdict

import pytest

from docrecords.llm import prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def walk(convs: dict[int, list[tuple[str, str]]]) -> set:
    """All nodes by the definition; ``convs`` maps ids to turns."""
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, held in members.items():
        words = len(path[-1][1].split()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(held) - 1) * words
    return {
        (
            min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(children[path]), leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(held) if len(convs[c]) == len(path)).encode()).hexdigest(),
        )
        for path, held in members.items()
    }


def found(df) -> set:
    rows = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def table_of(spark, convs):
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def conversations(n: int, longest: int, seed: int) -> dict:
    draw = random.Random(seed)
    texts = ["a", "b c", "d", "", "e f  g"]
    return {draw.randint(-5, 5) * 10**6 + i: [(draw.choice("ua"), draw.choice(texts[:2] if j else texts)) for j in range(draw.randint(1, longest))] for i in range(n)}


@pytest.mark.parametrize("shards", [1, 3, 9])
def test_against_walk(spark, shards):
    convs = conversations(200, 7, shards)
    copy = [("u", "the same first turn"), ("a", "x"), ("u", "y z")]
    convs |= {500 + i: copy for i in range(120)} | {900 + i: [*copy, ("a", str(i % 9))] for i in range(60)}
    assert found(trie.prefix_trie(trie.sequences(table_of(spark, convs)), shards)) == walk(convs)


@pytest.mark.parametrize("shards", [1, 4])
def test_longer_than_keys_and_bands(spark, shards):
    convs, draw = {}, random.Random(5)
    start = [("u", "w")] * 150
    for i in range(60):
        cut = draw.choice([3, trie.KEY_TURNS - 1, trie.KEY_TURNS, trie.KEY_TURNS + 1, trie.BAND, trie.BAND + 1, 140])
        convs[i] = [*start[:cut], *[("a", str(draw.randint(0, 2))) for _ in range(draw.randint(0, 3))]]
    assert found(trie.prefix_trie(trie.sequences(table_of(spark, convs)), shards)) == walk(convs)


def test_nulls_ties_repeats_and_other_columns(spark):
    schema = SCHEMA + ", id string, key string, depth int, words int, turns int"
    rows = [(1, None, None, None), (1, 0, "", ""), (2, 0, "", ""), (2, 0, None, ""), (None, 0, "u", "lost"), (3, 1, "u", "a" * 300_000), (3, 0, "u", "b")]
    rows = [(*r, "i", "k", 1, 2, 3) for r in rows]
    convs = {1: [("", ""), ("", "")], 2: [("", ""), ("", "")], 3: [("u", "b"), ("u", "a" * 300_000)]}
    assert found(trie.prefix_trie(trie.sequences(spark.createDataFrame(rows, schema)))) == walk(convs)


def test_empty(spark):
    assert found(trie.prefix_trie(trie.sequences(spark.createDataFrame([], SCHEMA)))) == set()
    alone = spark.createDataFrame([(4, [])], "conv_id bigint, turns array<struct<id: binary, words: bigint>>")
    assert found(trie.prefix_trie(alone)) == {(4, 0, None, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())}
