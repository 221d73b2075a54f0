"""Quality rules whose cutoffs come with a guarantee, made of built-in functions only.

A text fails the base rule if it has few words or repeats itself. Four more rules compare
a share with a cutoff. All four move together along one path of levels from loose to
strict (``PATH``), fixed before any data are seen. A level of a stratum is certified if
labelled good documents show that its rules together reject too many with small
probability: with k of n good documents rejected by any rule, the exact binomial tail
P(X <= k | n, alpha) must be at most delta / strata. Along the path k and so the tail
grow, so testing from loose to strict and stopping at the first failure (fixed-sequence
testing) spends alpha and delta whole at each level; strata are corrected by Bonferroni.
So with probability 1 - delta no stratum loses more than the share alpha of its good
documents to the four rules. Each stratum has the strictest level certified. The loosest
needs at least ln(strata / delta) / alpha good labelled documents, none of them rejected:
with the default alpha of 1 % and delta of 5 %, 439 where there are four strata. Strata with fewer have no
cutoff, and their rules reject nothing.

A NULL text has no words and fails. NULL strata are one stratum, '' is another. Labels
count where all rows of a doc_id say the same; documents without one are not counted.
Repeated rows count each. Windows of three words are compared by a 64-bit hash.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import stored, table
from docrecords.operators.rows import pin

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Rule: part, whole, and cutoffs of the share in thousandths from strict to loose.
GRIDS = {
    "symbols": ("n_symbols", "word_chars", (5, 10, 15, 20, 30, 40, 60, 80, 100, 150, 200, 300, 500)),
    "shouting": ("n_shouting", "word_chars", (20, 30, 40, 60, 80, 100, 150, 200, 300, 400, 500, 700)),
    "dup_lines": ("n_dup_lines", "n_lines", (10, 30, 50, 80, 100, 150, 200, 250, 300, 400, 500, 700)),
    "repeats": ("n_repeat_words", "n_words", (10, 20, 30, 50, 80, 100, 150, 200, 250, 300, 400)),
}
#: Cutoffs of all rules at each level, from loose to strict; shorter grids stay at their strictest.
PATH = [{rule: grid[max(0, len(grid) - 1 - i)] for rule, (_, _, grid) in GRIDS.items()} for i in range(max(len(g) for _, _, g in GRIDS.values()))]
ALPHA, DELTA = 0.01, 0.05
SALTS = 64

# Words of windows that occur again: windows are sorted by hash, those with an equal
# neighbour put back in order, and each covers three words less its overlap with the next.
REPEATED = """
if(size(_words) < 3, 0, element_at(transform(
  array(sort_array(transform(sequence(0, size(_words) - 3),
                             i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS h, i AS p)))),
  s -> element_at(transform(
    array(sort_array(transform(filter(s, (x, j) -> coalesce(x.h = get(s, j - 1).h, false)
                                                   OR coalesce(x.h = get(s, j + 1).h, false)), x -> x.p))),
    f -> aggregate(transform(f, (p, j) -> least(3, coalesce(get(f, j + 1) - p, 3))), 0, (a, b) -> a + b)), 1)), 1))
"""
# P(X <= k) for n draws with probability a: the largest term by its logarithm, times the
# sum of the terms in proportion to it.
TAIL = """
if(n = 0 OR k >= {a} * n, 1D,
   exp(aggregate(if(k = 0, cast(array() AS array<bigint>), sequence(1L, k)),
                 k * ln({a}D) + (n - k) * ln(1 - {a}D), (s, i) -> s + ln((n - k + i) / i)))
   * aggregate(if(k = 0, cast(array() AS array<bigint>), sequence(1L, k)), struct(1D AS t, 1D AS s),
               (z, i) -> struct(z.t * ((k - i + 1) / (n - k + i)) * ((1 - {a}D) / {a}D) AS t,
                                z.s + z.t * ((k - i + 1) / (n - k + i)) * ((1 - {a}D) / {a}D) AS s), z -> z.s))
"""


def text_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the counts of each text: words, characters, symbols, lines, repeats."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(*keep, words.alias("_words"), lines.alias("_lines"))
    rows = pin(rows, "_words", "_lines").withColumn("_joined", F.array_join("_words", ""))
    rows = pin(rows, "_joined")
    without = lambda chars: F.length("_joined") - F.length(F.regexp_replace("_joined", chars, ""))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length("_joined"),
        "n_symbols": without(r"[#*$%&|<>]"),
        "n_shouting": without(r"[A-Z!]"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.expr(REPEATED),
    }
    rows = rows.select(*keep, *[c.cast("long").alias(n) for n, c in counts.items()])
    many = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | many)


def exceeds(rule: str, cutoff: Column | int) -> Column:
    part, whole, _ = GRIDS[rule]
    return 1000 * F.col(part) > F.col(whole) * cutoff


def rejected(cuts: dict[str, Column | int]) -> Column:
    """Whether any rule with a cutoff rejects the row."""
    return functools.reduce(Column.__or__, [F.coalesce(exceeds(rule, cut), F.lit(False)) for rule, cut in cuts.items()])


def cutoffs(stats: DataFrame, labels: DataFrame, stratum: str, alpha: float, delta: float) -> DataFrame:
    """One row per stratum with good documents: ``stratum``, ``level`` and each rule's cutoff, or NULL."""
    good = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("worst"))
    good = good.filter("worst = 1").select("doc_id")
    known = stats.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    counts = [F.count_if(rejected(level)).alias(f"k{i}") for i, level in enumerate(PATH)]
    counted = known.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"), *counts)
    each = [F.struct(F.lit(i).alias("level"), F.col(f"k{i}").alias("k")) for i in range(len(PATH))]
    rows = counted.select("stratum", "n", F.inline(F.array(*each)))
    rows = rows.join(counted.agg(F.count("*").alias("strata")), F.lit(True)).withColumn("p", F.expr(TAIL.format(a=alpha)))
    # The tail grows along the path, so the levels that pass are those before the first failure.
    best = rows.groupBy("stratum").agg(F.max(F.when(F.col("p") <= delta / F.col("strata"), F.col("level"))).alias("level"))
    at = [F.get(F.array(*[F.lit(level[rule]) for level in PATH]), F.col("level")).alias(f"cut_{rule}") for rule in GRIDS]
    return best.select("stratum", "level", *at)


def quality_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document."""
    stats = stored(text_statistics(docs, text, ("doc_id", stratum)), "quality-statistics")
    cuts = stored(cutoffs(stats, labels, stratum, alpha, delta), "quality-cutoffs")
    spread = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = stats.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = rows.join(spread.withColumnRenamed("salt", "_salt"), F.col(stratum).eqNullSafe(F.col("stratum")) & (F.col("salt") == F.col("_salt")), "left")
    fails = rejected({rule: F.col(f"cut_{rule}") for rule in GRIDS})
    return joined.withColumn("kept", ~F.col("base_failed") & ~fails).select(*stats.columns, "kept")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the rules, with cutoffs per language."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    levels = ", ".join(f"({i}, {', '.join(str(level[r]) for r in GRIDS)})" for i, level in enumerate(PATH))
    fails = " OR ".join(f"1000 * {part} > cut_{r} * {whole}" for r, (part, whole, _) in GRIDS.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS n
        FROM (SELECT rid, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY rid ORDER BY i))
        WHERE w3 IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT i + s) AS n FROM win, (SELECT unnest([0, 1, 2]) AS s) WHERE n > 1 GROUP BY rid),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
c AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
             sum(length(word) - length(regexp_replace(word, '[#*$%&|<>]', '', 'g'))) AS n_symbols,
             sum(length(word) - length(regexp_replace(word, '[A-Z!]', '', 'g'))) AS n_shouting FROM w GROUP BY rid),
s AS (SELECT d.rid, doc_id, lang, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             coalesce(n_symbols, 0)::BIGINT AS n_symbols, coalesce(n_shouting, 0)::BIGINT AS n_shouting, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             coalesce(n_words, 0) < {MIN_WORDS} OR 100 * coalesce(rep.n, 0) > {MAX_REPEATED_PERCENT} * coalesce(n_words, 0) AS base_failed
      FROM d LEFT JOIN c USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)),
t AS (SELECT * FROM (VALUES {levels}) AS v(level, {", ".join(f"cut_{r}" for r in GRIDS)})),
k AS (SELECT lang, level, count(*) AS n, count(*) FILTER ({fails}) AS k
      FROM s, t WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1)
      GROUP BY ALL),
p AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
             - CASE WHEN n = i THEN 0 ELSE lgamma(n - i + 1) END + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA})))) AS p FROM k),
cut AS (SELECT lang, max(level) AS level FROM p
        WHERE p <= {DELTA} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM k)) GROUP BY ALL),
bad AS (SELECT rid FROM s JOIN cut ON s.lang IS NOT DISTINCT FROM cut.lang JOIN t ON t.level = cut.level WHERE {fails})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept
FROM s
"""


SQL = _sql()
