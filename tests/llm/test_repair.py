"""Conversation repair: parser against all lists of edits, hard inputs, split conversations."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from docrecords.llm import repair

SOUND = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(letters: str) -> tuple[int, str]:
    """All edits of each row, at most two insertions in each gap."""
    options = []
    for c in letters:
        more, role = int(c.isupper()), c.lower()
        keep = [] if c == "x" else [(more, "K", role), (2 + more, "R", "u"), (2 + more, "R", "a")]
        options.append([(3, "D", ""), *keep])
    gaps = [(2 * n, "I" * n, "".join(w)) for n in range(3) for w in itertools.product("ua", repeat=n)]
    best = None
    for rows in itertools.product(*options):
        for between in itertools.product(gaps, repeat=len(letters) + 1):
            parts = [between[0], *itertools.chain(*zip(rows, between[1:]))]
            if SOUND.match("".join(p[2] for p in parts)):
                now = (sum(p[0] for p in parts), "".join(p[1] for p in parts))
                best = now if best is None else min(best, now)
    return best


@pytest.mark.parametrize("n", [1, 2, 3])
def test_parser_equals_all_edits(n):
    every = ["".join(x) for x in itertools.product("xsuaoSUA", repeat=n)]
    for letters in every if n < 3 else random.Random(1).sample(every, 40):
        assert repair.accepted(repair.Parser().parse(letters)) == cheapest(letters), letters


def test_long_spans_equal_one_block(monkeypatch):
    draw = random.Random(2)
    for _ in range(30):
        letters = "".join(draw.choices("xsuaoUA", k=draw.randint(9, 40)))
        short = repair.accepted(repair.Parser().parse(letters))
        with monkeypatch.context() as m:
            m.setattr(repair, "BLOCK", 64)
            assert repair.accepted(repair.Parser().parse(letters)) == short


def said(rows: list) -> dict:
    """Per conversation the figures and the digest, by the plain definition."""
    found = {}
    for conv in {r[0] for r in rows}:
        mine = [(r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        letters, seen = "", set()
        counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in mine:
            body, letter = text.rstrip(repair.BLANKS), role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not body:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = repair.accepted(repair.Parser().parse(letters))
        out, i, state = [], 0, 0
        for edit in audit:
            due = "assistant" if state == 2 else "user"
            if edit != "I":
                _, role, text = mine[i]
                i += 1
            if edit != "D":
                role, text = {"K": (role, text), "R": (due, text), "I": (due, "")}[edit]
                state = repair.NEXT[state, role[:1]]
                out.append(f"{role}:{text}")
        turns = [t for t, _, _ in mine if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return found


def figures(spark, rows, schema=SCHEMA, extra=()):
    done = repair.digests(repair.repair(spark.createDataFrame(rows, schema), *extra))
    return {r["conv_id"]: tuple(r[c] for c in (*repair.REPORT, "audit", "repaired_sha256")) for r in done.collect()}


def test_hard_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 4, "user", "cut"),
        (2, None, None, None), (2, None, "user", "a."), (2, 3, "user", "a."), (2, 9, "", "x!"),
        (3, 0, "system", "s."), (3, 1, "assistant", "ä" * 100_000 + "."), (3, 2, "tool", " \n\t"),
        (None, 5, "assistant", "?"), (None, 5, "user", "?"), (4, None, "user", ""),
        (5, 0, "user", "same."), (5, 0, "assistant", "same."), (5, -3, "system", "end. \n"),
    ]
    assert figures(spark, rows) == said(rows)


def test_rows_of_one_conversation_in_many_tasks(spark):
    draw = random.Random(3)
    texts = ["Well.", "So", "No!", "", "Why?", "A.", "B.", "C", "D."]
    rows = [(7, draw.randint(0, 250), draw.choice(["user", "assistant", "system", "x"]), draw.choice(texts) + str(draw.randint(0, 40)) * (i % 2)) for i in range(700)]
    rows += [(8, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(50)]
    assert figures(spark, rows) == said(rows)


def test_empty_and_absent(spark):
    assert figures(spark, []) == {}
    known = spark.createDataFrame([(1,), (None,), (1,)], "conv_id bigint")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert figures(spark, [], extra=(known,)) == {1: nothing, None: nothing}


def test_other_types_and_columns(spark):
    schema = "conv_id string, turn int, role string, text string, cid int, place int, edit string, key string, tag int, cost int"
    rows = [("d0", 0, "user", "a.", 1, 1, "D", "k", 2, 9), ("d0", 1, "assistant", "b.", 1, 1, "D", "k", 2, 9)]
    assert figures(spark, rows, schema) == said([r[:4] for r in rows])


def test_repaired_conversations_are_sound(spark, sf_dir):
    rows = repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    turns = repair.repaired(repair.repair(rows)).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "role"))).alias("r"))
    found = ["".join(x["role"][0] for x in r["r"]) for r in turns.collect()]
    assert found and all(SOUND.match(f) for f in found)
