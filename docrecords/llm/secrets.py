"""Secret scan with a trigram inverted index, made of built-in functions only.

From each rule's pattern a Boolean query over lower-case trigrams is derived: clauses
that must all hold, each a choice of trigram sets of which one must be in the text. The
index holds, for the trigrams of all queries, the documents that contain them. Postings
are intersected per document; only candidates are verified with the pattern itself.
Rules without a clause, such as runs of hexadecimal digits, scan every text.

Candidates are found by doc_id: rows that share one are verified together, rows without
one always. A NULL text is empty. Repeated rows give repeated results. Spans count code
points, the end is exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import stored, table

Clause = frozenset[frozenset[str]]


def either_case(words: str) -> str:
    """The pattern with each letter in either case."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


@dataclass(frozen=True)
class Rule:
    """Matches count if group ``group`` (0: all) has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds in the order in which equal starts are listed.
BASE = (
    Rule("assign", f"(?:{either_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]{16,}"),
)
EXTRA = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + EXTRA
#: A class or repeat with more strings than this ends the literal run it stands in.
MOST_STRINGS = 64


def _exact(items) -> set[str] | None:
    """The lower-case strings that a part of a pattern stands for, if they are few."""
    found = {""}
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            options = {chr(arg).lower()}
        elif name == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
            spans = [(a, a) if str(o) == "LITERAL" else a for o, a in arg]
            options = {chr(c).lower() for lo, hi in spans for c in range(lo, min(hi, lo + MOST_STRINGS) + 1)}
        elif name == "SUBPATTERN":
            options = _exact(arg[3])
        elif name == "BRANCH":
            parts = [_exact(b) for b in arg[1]]
            options = None if None in parts else set().union(*parts)
        elif name == "MAX_REPEAT" and arg[1] <= 3:
            once = _exact(arg[2])
            options = None if once is None else {"".join(p) for n in range(arg[0], int(arg[1]) + 1) for p in product(once, repeat=n)}
        else:
            options = None
        if options is None or len(options) > 8 or len(found) * len(options) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in options}
    return found


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that hold for the lower-cased form of every text the pattern matches."""
    clauses: list[Clause] = []

    def close(strings: set[str]) -> None:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if sets and all(sets):
            clauses.append(frozenset(s for s in sets if not any(o < s for o in sets)))

    def walk(items, run: set[str]) -> set[str]:
        for item in items:
            name, arg = str(item[0]), item[1]
            options = _exact([item])
            if options is not None and len(run) * len(options) <= MOST_STRINGS:
                run = {a + b for a in run for b in options}
                continue
            close(run)
            run = {""}
            if options is not None:
                run = options
            elif name == "SUBPATTERN":
                close(walk(arg[3], run))
            elif name == "MAX_REPEAT" and arg[0] >= 1:
                close(walk(arg[2], run))
        return run

    close(walk(list(re._parser.parse(pattern)), {""}))
    return clauses


def postings(docs: DataFrame, text: str, trigrams: list[str]) -> DataFrame:
    """The inverted index of these trigrams: ``trigram``, ``doc_id``."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    found = [F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams]
    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.inline(F.array(F.struct(low.alias("_low")))))
    return rows.select("doc_id", F.explode(F.array_compact(F.array(*found))).alias("trigram"))


def candidates(docs: DataFrame, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``_id`` and ``_rules``, the kinds of all rules whose query the document satisfies."""
    spark = docs.sparkSession
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    parts = [
        (t, kind, c, a, len(choice), len(clauses))
        for kind, clauses in queries.items()
        for c, clause in enumerate(clauses)
        for a, choice in enumerate(sorted(map(sorted, clause)))
        for t in choice
    ]
    index = postings(docs, text, sorted({p[0] for p in parts}))
    asked = spark.createDataFrame(parts, "trigram string, kind string, clause int, choice int, need int, clauses int")
    # One row per trigram of a rule: the size is that of the rules, not of the data.
    hits = index.join(F.broadcast(asked), "trigram")
    met = hits.groupBy("doc_id", "kind", "clauses", "clause", "choice", "need").agg(F.count_distinct("trigram").alias("n"))
    met = met.filter("n = need").groupBy("doc_id", "kind", "clauses").agg(F.count_distinct("clause").alias("n"))
    return met.filter("n = clauses").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("kind").alias("_rules"))


def spans(rule: Rule, order: int, text: str) -> str:
    """SQL for the array of a rule's matches in ``text``.

    Starts are sums over what lies between matches and the matches before. The sums are
    built in blocks of about the root of their number, since an array grows by copying.
    """
    pattern = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    places = "cast(array() AS array<struct<start:int,end:int>>)"
    return f"""
element_at(transform(array(struct(regexp_extract_all({text}, '{pattern}', 0) AS m, regexp_extract_all({text}, '{pattern}', {rule.group}) AS g)),
  f -> if(size(f.m) = 0, cast(array() AS array<struct<start:int,rank:int,kind:string,end:int>>),
    transform(filter(element_at(transform(
      array(zip_with(f.m, slice(split({text}, '{pattern}', -1), 1, size(f.m)), (m, gap) -> struct(length(gap) AS gap, length(m) AS long))),
      p -> element_at(transform(
        array(transform(sequence(0, cast((size(p) - 1) div ceil(sqrt(size(p))) AS int)),
                        b -> aggregate(slice(p, cast(b * ceil(sqrt(size(p))) AS int) + 1, cast(ceil(sqrt(size(p))) AS int)),
                                       struct(0 AS at, {places} AS all),
                                       (z, x) -> struct(z.at + x.gap + x.long AS at,
                                                        array_append(z.all, struct(z.at + x.gap AS start, z.at + x.gap + x.long AS end)) AS all)))),
        blocks -> flatten(zip_with(blocks, aggregate(blocks, struct(0 AS at, cast(array() AS array<int>) AS all),
                                                     (z, x) -> struct(z.at + x.at AS at, array_append(z.all, z.at) AS all), z -> z.all),
                                   (x, o) -> transform(x.all, y -> struct(y.start + o AS start, y.end + o AS end))))), 1)), 1),
      (x, i) -> length(f.g[i]) >= {rule.least}),
      x -> struct(x.start AS start, {order} AS rank, '{rule.kind}' AS kind, x.end AS end)))), 1)
"""


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the text and ``found``: the matches of all rules by start, then rule."""
    # Stored, and joined by sort-merge: exchanges on both sides let Spark split an id with many rows.
    chosen = stored(candidates(docs, text, rules), "secret-candidates").hint("merge")
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body")
    rows = docs.select("doc_id", body).join(chosen, F.col("doc_id") == F.col("_id"), "left")
    arrays = []
    for order, rule in enumerate(rules):
        found = spans(rule, order, "_body")
        if trigram_query(rule.pattern):
            none = "cast(array() AS array<struct<start:int,rank:int,kind:string,end:int>>)"
            found = f"if(doc_id IS NULL OR coalesce(array_contains(_rules, '{rule.kind}'), false), {found}, {none})"
        arrays.append(F.expr(found))
    return rows.select("doc_id", F.col("_body").alias(text), F.inline(F.array(F.struct(F.sort_array(F.concat(*arrays)).alias("found")))))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )


def _sql() -> str:
    parts = []
    for order, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
SELECT rid, {order} AS rank, '{r.kind}' AS kind, m, g, coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
       + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS start
FROM (SELECT rid, ms, gaps, unnest(ms) AS m, unnest(gs) AS g, generate_subscripts(ms, 1) AS i
      FROM (SELECT rid, regexp_extract_all(text, '{p}', 0) AS ms, regexp_extract_all(text, '{p}', {r.group}) AS gs,
                   regexp_split_to_array(text, '{p}') AS gaps FROM d)) WHERE length(g) >= {r.least}""")
    union = " UNION ALL ".join(parts)
    counts = ", ".join(f"(count(*) FILTER (kind = '{r.kind}'))::BIGINT AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT rid, rank, kind, start, kind || ':' || start::BIGINT || ':' || (start + length(m))::BIGINT AS span FROM ({union}))
SELECT any_value(doc_id) AS doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN m USING (rid) GROUP BY rid
"""


SQL = _sql()
