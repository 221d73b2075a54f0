"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target share of the volume, over its share
now. Each document gets a uniform number from a hash of seed and id, and the count for
which the Poisson distribution function of its source's rate passes that number. Documents
are repeated by their count and all copies shuffled by a second hash. Every row is decided
by itself, so the result is the same on any cluster and after any retry.

Volume is the number of characters. Without given weights a source's target is its volume
to the power of ``temperature``. A NULL source is a source of its own, one that ``weights``
does not name has the rate 0, one without text the rate 1. Rows with equal ids are repeated
alike; rows without an id are told apart by their text. A column named like the copy number
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import shuffle_width, stored, table, whole_row
from docrecords.operators.rows import pin

#: The table of rates is broadcast up to this many sources, each with its name and one number.
BROADCAST_SOURCES = 10_000
SALTS = 64
BITS = 52

# For how many numbers k the distribution function is at most u, added up from 0 until it is 1
# in double precision; logarithms keep the terms of large rates from vanishing. The steps
# are as many as the copies, but for a bound.
COUNT = """
if(rate <= 0, 0, aggregate(sequence(1, cast(ceil(rate + 12 * sqrt(rate) + 30) AS int)),
   struct(-rate AS log, exp(-rate) AS sum, if(exp(-rate) <= u, 1, 0) AS n),
   (z, k) -> struct(z.log + ln(rate) - ln(k) AS log, z.sum + exp(z.log + ln(rate) - ln(k)) AS sum,
                    z.n + if(z.sum + exp(z.log + ln(rate) - ln(k)) <= u, 1, 0) AS n), z -> z.n))
"""


def volume(text: str) -> Column:
    return F.coalesce(F.char_length(F.col(text).cast("string")), F.lit(0)).cast("long")


def rates(docs: DataFrame, source: str, text: str, weights: dict[str, float] | None, temperature: float, total: int | None) -> DataFrame:
    """One row per source: ``_source`` and ``rate``."""
    amounts = docs.groupBy(F.col(source).cast("string").alias("_source")).agg(F.sum(volume(text)).alias("amount"))
    if weights is None:
        target = F.pow(F.col("amount").cast("double"), F.lit(float(temperature)))
    else:
        target = F.lit(0.0)
        for name, weight in weights.items():
            target = F.when(F.col("_source") == name, F.lit(float(weight))).otherwise(target)
    rows = amounts.withColumn("target", target)
    sums = rows.agg(F.sum("target").alias("targets"), F.sum("amount").alias("amounts"))
    wanted = F.col("amounts") if total is None else F.lit(total)
    rate = F.when(F.col("amount") > 0, F.col("target") / F.col("targets") * wanted / F.col("amount")).otherwise(1.0)
    return rows.join(sums, F.lit(True)).select("_source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.7,
    total: int | None = None,
    seed: str = "mix",
    source: str = "source",
    text: str = "text",
    id_col: str = "doc_id",
    copy: str = "copy",
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """The documents repeated to the target weights, shuffled, with ``copy`` from 1."""
    known = stored(rates(docs, source, text, weights, temperature, total), "mix-rates")
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), key).cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    uniform = (digits + 0.5) / float(1 << BITS)
    rows = docs.select(whole_row(docs, copy).alias("doc"), F.col(source).cast("string").alias("own"), key.alias("key"), uniform.alias("u"))
    same = F.col("own").eqNullSafe(F.col("_source"))
    if known.count() <= broadcast_sources:
        rows = rows.join(F.broadcast(known), same)
    else:
        salted = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        rows = rows.join(salted, same & (F.col("salt") == F.col("other")))
    rows = pin(rows.withColumn("n", F.expr(COUNT)), "n").filter("n > 0")
    # A place in the shuffle for each copy; equal ones are spread by the row's number of copies only.
    rows = rows.select("doc", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("number"))
    rows = rows.withColumn("place", F.xxhash64(F.lit(seed), F.col("key"), F.col("number")))
    rows = rows.repartition(shuffle_width(docs.sparkSession), "place").sortWithinPartitions("place")
    return rows.select("doc.*", F.col("number").alias(copy))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed so that each source's volume is tempered."""
    return mix(table(spark, sf_dir, "documents"))


SQL = f"""
WITH a AS (SELECT source, sum(length(coalesce(text, ''))) AS amount FROM documents GROUP BY source),
t AS (SELECT source, amount, pow(amount::DOUBLE, 0.7) AS target FROM a),
r AS (SELECT source, CASE WHEN amount > 0 THEN target / (SELECT sum(target) FROM t) * (SELECT sum(amount) FROM t) / amount ELSE 1.0 END AS rate FROM t),
d AS (SELECT documents.*, rate, (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, '')))), 1, {BITS // 4}))::BIGINT + 0.5)
             / {float(1 << BITS)!r} AS u FROM documents JOIN r ON documents.source IS NOT DISTINCT FROM r.source),
k AS (SELECT *, len(list_filter(range(0, (rate + 12 * sqrt(rate) + 30)::INT), lambda k: u >=
             list_sum(list_transform(range(0, k + 1), lambda i: exp(i * ln(rate) - rate - lgamma(i + 1)))))) AS n FROM d)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INT AS copy FROM k
"""
