"""Conversation structure repair by weighted CYK parsing.

A sound conversation has the role initials ``(s?(ua)+)?``. Rows may be kept (free), given
another role, deleted, and messages may be inserted, each at a price; the cheapest list of
edits wins, and of equally cheap ones the list whose letters (K, R, D, I) are least as text.

The repair grammar is in Chomsky normal form. Its nonterminals ``[p,q]`` say that a span's
result leads from state p of the role automaton to state q; its rules are
``[p,r] -> [p,q] [q,r]``, and its terminals are the edits of one row. A cell holds the least
(cost, audit) of each nonterminal over a span of rows. Insertion closure puts the cheapest
insertions on both sides of every one-row cell, so they may stand anywhere. Blocks of
``BLOCK`` rows are parsed bottom-up by span length over all splits. The grammar's language is
regular, so every split of a span gives the same minima; longer spans are therefore combined
pairwise, block by block, which takes time linear in the number of rows. Two lists of edits
of equal cost over one span are never prefixes of each other (they differ by insertions
alone, which cost), so joining spans keeps the order of lists, and minima of parts suffice.

Work is laid out so that a conversation with very many rows is split: rows without text are
sorted by range over (conversation, turn), each task reduces its part of a conversation to
one cell, and the parts of a conversation are combined afterwards. Only then do the texts
move, once, and stream past the edits in order; a task holds one batch of them.

Rows are ordered by turn (NULL first), ties by an MD5 of role and text. NULL roles and texts
count as one space; a NULL conv_id is a conversation of its own; turns are read as bigint.
Repeated rows are duplicates of each other. An empty table gives no conversations. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import shuffle_width, stored, table

RE_ROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
BLOCK, CELLS_KEPT, ROWS_OUT = 8, 50_000, 2_000

#: State after each role initial: 0 at the start, 1 after s, 2 after u, 3 after a.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Insertions on the cheapest way between two states.
INSERTIONS = {(0, 0): 0, (0, 2): 1, (0, 3): 2, (1, 1): 0, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 3): 0, (3, 2): 1}
SYMBOLS = sorted({*INSERTIONS, *((p, q) for (p, _), q in NEXT.items())})
AT = {pair: i for i, pair in enumerate(SYMBOLS)}
#: Binary rules as indexes of (left side, first symbol, second symbol).
RULES = [(AT[p, r], AT[p, q], AT[q, r]) for p, q in SYMBOLS for q2, r in SYMBOLS if q == q2 and (p, r) in AT]

#: Per symbol the least (cost, audit), or None where no edits lead from p to q.
Cell = list
NOTHING: Cell = [(INSERT * INSERTIONS[s], "I" * INSERTIONS[s]) if s in INSERTIONS else None for s in SYMBOLS]


def joined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """The binary rules applied to two neighbouring spans, merged into a cell by minimum."""
    out = [None] * len(SYMBOLS) if into is None else into
    for a, b, c in RULES:
        x, y = left[b], right[c]
        if x is not None and y is not None:
            now, cost = out[a], x[0] + y[0]
            if now is None or cost < now[0]:
                out[a] = (cost, x[1] + y[1])
            elif cost == now[0] and (audit := x[1] + y[1]) < now[1]:
                out[a] = (cost, audit)
    return out


def terminal(letter: str) -> Cell:
    """The cell of one row. x must go; other letters are role initials, in upper case if cut off."""
    cell: Cell = [None] * len(SYMBOLS)
    for p in range(4):
        cell[AT[p, p]] = (DELETE, "D")
    if letter != "x":
        more, role = (CUT_OFF if letter.isupper() else 0), letter.lower()
        for (p, initial), q in NEXT.items():
            if initial == role:
                cell[AT[p, q]] = (more, "K")
            elif initial != "s":
                cell[AT[p, q]] = (RE_ROLE + more, "R")
    return joined(joined(NOTHING, cell), NOTHING)


class Parser:
    """Cells of spans of row letters; equal short spans of all conversations share one cell."""

    def __init__(self) -> None:
        self.cells: dict[str, Cell] = {}

    def block(self, letters: str) -> Cell:
        """CYK over at most ``BLOCK`` rows, by span length, over all splits."""
        if len(self.cells) > CELLS_KEPT:
            self.cells.clear()
        cells = self.cells
        for length in range(1, len(letters) + 1):
            for start in range(len(letters) - length + 1):
                span = letters[start : start + length]
                if span not in cells:
                    cell = terminal(span) if length == 1 else [None] * len(SYMBOLS)
                    for cut in range(1, length):
                        joined(cells[span[:cut]], cells[span[cut:]], cell)
                    cells[span] = cell
        return cells[letters]

    def parse(self, letters: str) -> Cell:
        """The cell of a span of any length: blocks, then pairs of spans of equal length."""
        open_spans: list[tuple[int, Cell]] = []
        for start in range(0, len(letters), BLOCK):
            size, cell = 1, self.block(letters[start : start + BLOCK])
            while open_spans and open_spans[-1][0] == size:
                size, cell = size * 2, joined(open_spans.pop()[1], cell)
            open_spans.append((size, cell))
        cell = NOTHING
        for _, span in reversed(open_spans):
            cell = span if cell is NOTHING else joined(span, cell)
        return cell


def accepted(cell: Cell) -> tuple[int, str]:
    """The cheapest sound result: nothing at all, or one that ends after an assistant."""
    return min(x for x in (cell[AT[0, 0]], cell[AT[0, 3]]) if x is not None)


# --- rows without text ------------------------------------------------------------------


def _narrow(rows: DataFrame) -> DataFrame:
    """Distinct rows of (cid, turn, key) with their number and what the text is like."""
    body = F.rtrim("text", F.lit(BLANKS))
    ends = F.right(body, F.lit(1)).isin(".", "!", "?")
    found = rows.select("cid", "turn", _key(), F.left("role", F.lit(1)).alias("initial"), (body == "").alias("blank"), (~ends).alias("cut"))
    return found.groupBy("cid", "turn", "key").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("initial", "blank", "cut")])


def _key() -> Column:
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("key")


PART = (
    "cid string, turn bigint, key string, first string, last string, low bigint, high bigint, turns bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost array<bigint>, audit array<string>"
)
LEGAL = {"su", "ua", "au"}


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one row for each conversation, or the part of it that lies in this task."""
    parser, out, now = Parser(), _Rows(PART_SCHEMA), None
    letters: list[str] = []

    def close() -> None:
        cell = parser.parse("".join(letters))
        now["cost"], now["audit"] = [None if x is None else x[0] for x in cell], [None if x is None else x[1] for x in cell]
        out.add(now)
        letters.clear()

    for batch in batches:
        for row in batch.to_pylist():
            initial, n = row["initial"], row["n"]
            if now is None or now["cid"] != row["cid"]:
                if now is not None:
                    close()
                yield from out.full()
                now = {"cid": row["cid"], "turn": row["turn"], "key": row["key"], "first": initial, "last": None, "low": None, "high": None}
                now |= dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
            if row["turn"] is not None:
                now["turns"] += row["turn"] != now["high"]
                now["low"] = row["turn"] if now["low"] is None else now["low"]
                now["high"] = row["turn"]
            now["illegal"] += n - 1 + (now["last"] is not None and now["last"] + initial not in LEGAL)
            now["last"] = initial
            if row["blank"]:
                now["blank"] += n
                letters.append("x" * n)
                continue
            good = 1 if row["fresh"] else 0
            now["duplicate"] += n - good
            now["truncated"] += good and row["cut"]
            role = initial if initial in ("s", "u", "a") else "o"
            letters.append((role.upper() if row["cut"] else role) * good + "x" * (n - good))
    if now is not None:
        close()
    yield from out.rest()


class _Rows:
    """Rows gathered into record batches."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: dict, size: int = 0) -> None:
        self.rows.append(row)
        self.bytes += size

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= ROWS_OUT or self.bytes > 1 << 23:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
            self.rows, self.bytes = [], 0


_LONGS, _TEXTS = pa.list_(pa.int64()), pa.list_(pa.string())
PART_SCHEMA = pa.schema(
    [("cid", pa.string()), ("turn", pa.int64()), ("key", pa.string()), ("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")]
    + [("cost", _LONGS), ("audit", _TEXTS)]
)

# --- edits ------------------------------------------------------------------------------

REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EDITS = "cid string, place bigint, edit string, role string, text string, audit string, " + ", ".join(f"{c} bigint" for c in REPORT)
EDITS_SCHEMA = pa.schema(
    [("cid", pa.string()), ("place", pa.int64()), *((c, pa.string()) for c in ("edit", "role", "text", "audit"))] + [(c, pa.int64()) for c in REPORT]
)


def _report(parts: list[dict]) -> dict:
    """The figures of a conversation from those of its parts, in order."""
    head = dict.fromkeys(REPORT, 0) | {"audit": ""}
    if not parts:
        return head
    cell, turns, high, last = None, 0, None, None
    for part in parts:
        mine = [None if c is None else (c, a) for c, a in zip(part["cost"], part["audit"], strict=True)]
        cell = mine if cell is None else joined(cell, mine)
        turns += part["turns"] - (part["low"] is not None and part["low"] == high)
        high = part["high"] if part["high"] is not None else high
        head["illegal"] += part["illegal"] + (last is not None and last + part["first"] not in LEGAL)
        last = part["last"]
        for name in ("blank", "duplicate", "truncated"):
            head[name] += part[name]
    low = next((p["low"] for p in parts if p["low"] is not None), None)
    head["gaps"] = 0 if low is None else high - low + 1 - turns
    head["cost"], head["audit"] = accepted(cell)
    return head


def _edits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation a row with its figures, then its rows and insertions in order."""
    out = _Rows(EDITS_SCHEMA)
    parts: list[dict] = []
    cid, audit, at, state, place, open_ = None, None, 0, 0, 0, False

    def emit(edit: str, role: str, text: str) -> None:
        nonlocal place, state
        place += 1
        out.add({"cid": cid, "place": place, "edit": edit, "role": role, "text": text}, len(text))
        if edit != "D":
            state = NEXT[state, role[:1]]

    def due() -> str:
        return "assistant" if state == 2 else "user"

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            emit("I", due(), "")
            at += 1

    def decide() -> None:
        nonlocal audit
        head = _report(parts)
        audit = head["audit"]
        out.add({"cid": cid, "place": 0, **head}, len(audit))
        inserted()

    for batch in batches:
        for row in batch.to_pylist():
            if row["tag"] == 0:
                if open_ and audit is None:
                    decide()
                yield from out.full()
                cid, audit, at, state, place, open_ = row["cid"], None, 0, 0, 0, True
                parts.clear()
            elif row["tag"] == 1:
                parts.append(row)
            else:
                if audit is None:
                    decide()
                edit = audit[at]
                at += 1
                emit(edit, due() if edit == "R" else row["role"], row["text"])
                inserted()
                yield from out.full()
    if open_ and audit is None:
        decide()
    yield from out.rest()


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The edits of each conversation: ``conv_id, place, edit, role, text`` and the figures.

    ``rows`` has conv_id, turn, role and text. Per conversation one row with place 0 has the
    figures (gaps, blank, duplicate, truncated, illegal, cost, audit); the rows after it, from
    place 1, have an edit K, R, D or I each with the resulting role and text. Rows of one
    conversation follow each other in order in one partition. ``conversations`` names in its
    conv_id further conversations, which may have no rows.
    """
    kind = rows.schema["conv_id"].dataType
    known = rows.select("conv_id") if conversations is None else rows.select("conv_id").unionByName(conversations.select("conv_id"))
    rows = rows.select(
        F.col("conv_id").cast("string").alias("cid"),
        F.expr("try_cast(turn AS bigint)").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    width = shuffle_width(rows.sparkSession)
    narrow = stored(_narrow(rows), "repair-rows")
    # A row is fresh if no earlier turn has its role and text. Aggregated first, so a text
    # said very often is one row here, and adaptive execution can split its rows in the join.
    first = narrow.groupBy("cid", "key").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.col("cid").alias("_cid"), F.col("key").alias("_key"), "first")
    seen = narrow.join(first, F.col("cid").eqNullSafe(F.col("_cid")) & (F.col("key") == F.col("_key")))
    seen = seen.select(*narrow.columns, F.struct("turn").eqNullSafe(F.col("first")).alias("fresh"))
    order = ("cid", "turn", "key")
    parts = seen.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(_parts, PART)
    heads = known.select(F.col("conv_id").cast("string").alias("cid")).distinct().withColumn("tag", F.lit(0))
    parts = parts.withColumn("tag", F.lit(1))
    texts = rows.withColumns({"key": _key(), "tag": F.lit(2)})
    together = heads.unionByName(parts, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    together = together.repartition(width, "cid").sortWithinPartitions("cid", "tag", "turn", "key")
    return together.mapInArrow(_edits, EDITS).withColumn("conv_id", F.col("cid").cast(kind)).drop("cid")


def repaired(edits: DataFrame) -> DataFrame:
    """The sound conversations: ``conv_id, place, role, text``, without deleted rows."""
    return edits.filter("edit IN ('K', 'R', 'I')").select("conv_id", "place", "role", "text")


# --- query ------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults: a hash of (conv_id, turn) drops, blanks, cuts, repeats or reroles rows."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("_fault", F.crc32(F.concat_ws(":", *part).cast("binary")) % 20).filter("_fault <> 0")
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(fault == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


DIGEST_SCHEMA = pa.schema([("conv_id", pa.string()), *((c, pa.int64()) for c in REPORT), ("audit", pa.string()), ("repaired_sha256", pa.string())])
DIGEST = "conv_id string, " + ", ".join(f"{c} bigint" for c in REPORT) + ", audit string, repaired_sha256 string"


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, head, state, empty = _Rows(DIGEST_SCHEMA), None, None, True
    for batch in batches:
        for row in batch.to_pylist():
            if row["place"] == 0:
                if head is not None:
                    out.add({**head, "repaired_sha256": state.hexdigest()}, len(head["audit"]))
                    yield from out.full()
                head, state, empty = {c: row[c] for c in ("conv_id", "audit", *REPORT)}, hashlib.sha256(), True
            elif row["edit"] != "D":
                state.update(f"{'' if empty else chr(10)}{row['role']}:{row['text']}".encode())
                empty = False
    if head is not None:
        out.add({**head, "repaired_sha256": state.hexdigest()})
    yield from out.rest()


def digests(edits: DataFrame) -> DataFrame:
    """The figures of each conversation and the SHA-256 of its repaired ``role:text`` lines.

    ``edits`` must come from ``repair`` directly, in its order. A digest is a chain over the
    whole conversation, so one task computes it, streaming.
    """
    kind = edits.schema["conv_id"].dataType
    edits = edits.withColumn("conv_id", F.col("conv_id").cast("string"))
    return edits.mapInArrow(_digests, DIGEST).withColumn("conv_id", F.col("conv_id").cast(kind))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the contract's rule and repaired."""
    conversations = table(spark, sf_dir, "conversations")
    return digests(repair(damage(conversations), conversations))


#: CRC-32 of the short ASCII text ``{x}``, bit by bit.
CRC32_SQL = (
    "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT),"
    " lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)), 4294967295)"
)

SQL = f"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hit AS (SELECT *, {CRC32_SQL.format(x="name")} % 20 AS fault FROM src),
dam AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE fault <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM dam),
cls AS (SELECT *, left(role, 1) AS initial, body = '' AS blank, body <> '' AND seen > 1 AS duplicate,
  body <> '' AND seen = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM num),
fig AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
  count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, max(i) AS n FROM cls GROUP BY conv_id),
adj AS (SELECT conv_id, count_if(before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM cls) GROUP BY conv_id),
step(p, initial, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(p, q, letters, said) AS (VALUES (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 2, '', ''),
  (2, 3, 'I', chr(10) || 'assistant:'), (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:')),
edge AS (
  SELECT conv_id, i, p, p AS q, 3 AS cost, 'D' AS letter, '' AS said FROM cls, (SELECT unnest([0, 1, 2, 3]) AS p)
  UNION ALL SELECT conv_id, i, p, q, truncated::INT, 'K', chr(10) || role || ':' || text FROM cls JOIN step USING (initial) WHERE NOT blank AND NOT duplicate
  UNION ALL SELECT conv_id, i, p, q, 2 + truncated::INT, 'R', chr(10) || CASE step.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
    FROM cls JOIN step ON step.initial <> 's' WHERE NOT blank AND NOT duplicate),
way AS (
  SELECT fig.conv_id, 0::BIGINT AS i, q, {{'cost': 2 * length(letters), 'audit': letters, 'said': said}} AS best FROM fig, ins WHERE p = 0
  UNION ALL
  SELECT way.conv_id, way.i + 1, ins.q, min({{'cost': best.cost + edge.cost + 2 * length(ins.letters),
    'audit': best.audit || edge.letter || ins.letters, 'said': best.said || edge.said || ins.said}})
  FROM way JOIN edge ON way.conv_id IS NOT DISTINCT FROM edge.conv_id AND edge.i = way.i + 1 AND edge.p = way.q JOIN ins ON ins.p = edge.q
  GROUP BY way.conv_id, way.i, ins.q),
done AS (SELECT way.conv_id, min(best) AS best FROM way JOIN fig ON way.conv_id IS NOT DISTINCT FROM fig.conv_id AND way.i = n
  WHERE q IN (0, 3) GROUP BY way.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN fig ON c.conv_id IS NOT DISTINCT FROM fig.conv_id LEFT JOIN adj ON c.conv_id IS NOT DISTINCT FROM adj.conv_id
LEFT JOIN done ON c.conv_id IS NOT DISTINCT FROM done.conv_id
"""
