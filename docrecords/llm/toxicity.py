"""Toxicity by class-conditional Kneser-Ney models.

A word is a sequence of letters between a start and an end mark. Two models, of toxic and of
ordinary texts, give each letter x after its context u (up to ``ORDER`` - 1 letters of the
word, start mark included) the interpolated Kneser-Ney probability::

    P(x | u, c) = max(n(c, ux) - D, 0) / n(c, u) + D V(c, u) / n(c, u) * B(x | u')
    B(x | v)    = (k(vx) - D) / k(v) + D V(v) / k(v) * B(x | v')

n(c, ux): (text, word) pairs of class c in which ux occurs, n(c, u) their sum over letters and
V(c, u) the number of different letters; u' is u without its first letter. B is the backoff
distribution that both classes share: k(vx) is the number of letters seen before vx in the
whole corpus, labelled or not, and the recursion ends in single letters. What a class has not
seen after a context thus differs from the other class by the backoff weight alone, and rare
expressions are judged by the parts that they share with others. Copies are one context: of
texts of one class whose ``SKETCHES`` least hashes of word runs agree only the first counts.

A text's evidence is the difference of its log-likelihoods under both models, normalised by
length: over the whole text, and over the windows of ``WINDOWS`` words where it is greatest,
so that a few words in a long text are found. The difference of a word counts as far as it
lies between ``FLOOR`` and ``CEILING``: smaller ones are noise of counts, and no single word
should decide about a text. A logistic function of these means, fitted on labelled texts that
the models have not seen, gives the score.

Counts cover all texts, and nothing that grows with the corpus reaches the driver or is
broadcast. A task gives each block of texts a dictionary of its words and stores the texts as
lists of dictionary places, in buckets by block, so that they are not shuffled; what moves are
the grams of each block's words with their counts and ratios, and labels. The logistic
function has few weights and is fitted on at most ``MAX_CALIBRATION_ROWS`` texts, those with
the least hashes.

Words are runs of letters, lower-cased. A NULL text is empty; a text without words has evidence
0. Labels count where all rows of a doc_id agree. Without labels of both kinds every score is
the share of toxic labels, or 0.5 without any. Repeated rows count each in the result; columns
of other names are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import stored, stored_in_buckets, table

MAX_CALIBRATION_ROWS = 20_000
ORDER, DISCOUNT = 4, 0.75
WINDOWS = (16, 64, 256)
FLOOR, CEILING = 2.0, 4.0
#: Texts and letters of a block; one text alone may have more.
BLOCK_TEXTS, BLOCK_LETTERS = 20_000, 16 << 20
RUN, SKETCHES = 4, 2
LETTERS = re.compile(r"[^\W\d_]+")

# --- texts as lists of dictionary places ------------------------------------------------

#: A block's texts (``at`` from 0, the places of their words) and, at -1, its words.
BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("doc_id", pa.string()), ("sketch", pa.int64()), ("data", pa.binary())])
BLOCKS = "block bigint, at bigint, doc_id string, sketch bigint, data binary"


def sketch(words: list[str]) -> int:
    """A number that near copies share: their least hashes of runs of words, in several orders."""
    runs = {" ".join(words[i : i + RUN]) for i in range(max(1, len(words) - RUN + 1))}
    hashes = np.fromiter((xxhash.xxh64_intdigest(r) for r in runs), np.uint64, len(runs))
    least = [(hashes * np.uint64(2 * k + 1) ^ (hashes >> np.uint64(29 + k))).min() for k in range(SKETCHES)]
    return xxhash.xxh64_intdigest(np.array(least).tobytes()) - (1 << 63)


def _packed(places: np.ndarray) -> bytes:
    """The bytes of all places, highest bytes first, compressed: most of them are zeros."""
    return zlib.compress(places.astype(">u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(">u4").ravel().astype(np.int64)


def _words(data: bytes) -> list[str]:
    text = zlib.decompress(data).decode()
    return text.split("\n") if text else []


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to blocks; a block's words are numbered from the most frequent on."""
    number = TaskContext.get().partitionId() << 32
    rows, known, size = [], {}, 0

    def block() -> pa.RecordBatch:
        counts = np.bincount(np.concatenate([r[2] for r in rows]), minlength=len(known))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(known), np.uint32)
        rank[order] = np.arange(len(known))
        words = list(known)
        n = len(rows)
        data = [*(_packed(rank[r[2]]) for r in rows), zlib.compress("\n".join([words[i] for i in order.tolist()]).encode(), 1)]
        columns = ([number] * (n + 1), [*range(n), -1], [*(r[0] for r in rows), None], [*(r[1] for r in rows), None], data)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCK_SCHEMA, strict=True)], schema=BLOCK_SCHEMA)

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = LETTERS.findall(text.lower())
            rows.append((doc_id, sketch(words), np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))))
            size += len(text)
            if len(rows) >= BLOCK_TEXTS or size >= BLOCK_LETTERS:
                yield block()
                number, rows, known, size = number + 1, [], {}, 0
    if rows:
        yield block()


# --- counts of grams ---------------------------------------------------------------------

START, END = "^", "$"


def grams(word: str) -> list[str]:
    """Each letter of a word, and its end, with its context."""
    marked = f"{START}{word}{END}"
    return [marked[max(0, i - ORDER) : i] for i in range(2, len(marked) + 1)]


def _wanted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different grams of each block's words."""
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
            found = {g for w in _words(data) for g in grams(w)}
            if found:
                yield pa.RecordBatch.from_pydict({"of": [block] * len(found), "gram": list(found)})


def _counts(key: tuple, block: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
    """Per gram: pairs of a word and a toxic or ordinary text of ``classes`` (place, toxic)."""
    counts: dict[str, list[int]] = {}
    if len(block) and len(classes):
        texts = block.set_index("at")["data"]
        words = _words(texts[-1])
        found = np.zeros((2, len(words)), np.int64)
        for at, toxic in zip(classes["place"], classes["toxic"], strict=True):
            found[toxic, np.unique(_unpacked(texts[at]))] += 1
        held = np.flatnonzero(found.any(0))
        for i, n_ordinary, n_toxic in zip(held.tolist(), *found[:, held].tolist(), strict=True):
            for gram in grams(words[i]):
                sums = counts.setdefault(gram, [0, 0])
                sums[0] += n_ordinary
                sums[1] += n_toxic
    sums = np.array(list(counts.values()), np.int64).reshape(-1, 2)
    return pd.DataFrame({"gram": pd.Series(list(counts), dtype=object), "ordinary": sums[:, 0], "toxic": sums[:, 1]})


def _context(gram: str) -> Column:
    return F.expr(f"left({gram}, char_length({gram}) - 1)")


def _shorter(gram: str) -> Column:
    return F.expr(f"right({gram}, char_length({gram}) - 1)")


def shared_backoff(counts: DataFrame) -> DataFrame:
    """``gram`` and ``shared``, the probability of its last letter after its context less one letter."""
    seen = counts.select("gram", F.explode(F.expr("transform(sequence(2, char_length(gram)), k -> right(gram, k))")).alias("long"))
    extended = seen.select("long").distinct().select(_shorter("long").alias("part"))
    parts = extended.groupBy("part").agg(F.count("*").alias("k")).withColumn("context", _context("part"))
    after = parts.groupBy("context").agg(F.sum("k").alias("total"), F.count("*").alias("kinds"))
    parts = parts.join(after, "context").select(
        F.col("part"),
        ((F.col("k") - DISCOUNT) / F.col("total")).alias("own"),
        (DISCOUNT * F.col("kinds") / F.col("total")).alias("rest"),
    )
    pairs = seen.select("gram", _shorter("long").alias("part"))
    steps = F.sort_array(F.collect_list(F.struct(F.char_length("part").alias("k"), "own", "rest")))
    told = pairs.join(parts, "part").groupBy("gram").agg(steps.alias("steps"))
    # Letters that were never seen get the least probability, so no text has an infinite ratio.
    return told.select("gram", F.aggregate("steps", F.lit(1e-6), lambda below, s: s["own"] + s["rest"] * below).alias("shared"))


def gram_ratios(blocks: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """``gram`` and ``ratio``, the difference of its log-probabilities, of all grams.

    ``wanted`` has the grams of all blocks, ``classes`` the texts that count: the block as
    ``of``, the place in it, and ``toxic``.
    """
    counts = blocks.groupBy("block").cogroup(classes.groupBy("of")).applyInPandas(_counts, "gram string, ordinary bigint, toxic bigint")
    names = ("ordinary", "toxic")
    counts = counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in names])
    counts = wanted.select("gram").distinct().join(counts, "gram", "left").fillna(0, names)
    counts = stored(counts.withColumn("context", _context("gram")), "toxicity-grams")
    after = [a for c in names for a in (F.sum(c).alias(f"n_{c}"), F.count_if(F.col(c) > 0).alias(f"v_{c}"))]
    after = counts.groupBy("context").agg(*after)
    backoff = stored(shared_backoff(counts.select("gram")), "toxicity-backoff")
    rows = counts.join(after, "context").join(backoff, "gram")
    logs = []
    for c in ("toxic", "ordinary"):
        n = F.col(f"n_{c}")
        own = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / n + DISCOUNT * F.col(f"v_{c}") / n * F.col("shared")
        logs.append(F.log(F.when(n > 0, own).otherwise(F.col("shared"))))
    return rows.select("gram", (logs[0] - logs[1]).alias("ratio"))


# --- evidence ---------------------------------------------------------------------------

def evidence(ratios: np.ndarray) -> list[float]:
    """Mean ratio of the whole text, and the greatest mean of each window's length."""
    if not len(ratios):
        return [0.0] * (1 + len(WINDOWS))
    sums = np.concatenate([[0.0], np.cumsum(np.clip(ratios, FLOOR, CEILING) - FLOOR)])
    best = [float((sums[w:] - sums[:-w]).max() / w) if len(ratios) >= w else float(sums[-1] / w) for w in WINDOWS]
    return [float(sums[-1] / len(ratios)), *best]


def _evidence(key: tuple, block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
    known = dict(zip(told["gram"], told["ratio"], strict=True))
    texts = block[block["at"] >= 0]
    words = _words(block["data"][block["at"] < 0].iloc[0])
    ratio = np.fromiter((sum(map(known.__getitem__, grams(w))) for w in words), np.float64, len(words))
    ids = [None if pd.isna(i) else i for i in texts["doc_id"]]
    found = [evidence(ratio[_unpacked(d)]) for d in texts["data"]]
    return pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "evidence": pd.Series(found, dtype=object)})


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and intercept of a ridge logistic regression, classes weighted alike, by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def _hash(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def _calibrates(doc_id: str = "doc_id") -> Column:
    """Whether a labelled document, one of four, is for the logistic function and not for the models."""
    return F.floor(_hash(doc_id) / 4) % 4 == 0


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(_hash(doc_id) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) are those to learn from.
    """
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = stored_in_buckets(rows.mapInArrow(_blocks, BLOCKS), "toxicity-blocks", "block")
    agreed = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("doc_id"))
    agreed = agreed.agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("_most"))
    agreed = agreed.filter("toxic = _most").select("doc_id", "toxic", _calibrates().alias("_tests"))
    # Of copies the first text counts; partial sums make one row of each per task.
    known = blocks.filter("at >= 0").select("doc_id", "sketch", F.struct("block", "at").alias("where")).join(agreed.filter("NOT _tests"), "doc_id")
    classes = known.groupBy("toxic", "sketch").agg(F.min("where").alias("f")).select(F.col("f.block").alias("of"), F.col("f.at").alias("place"), "toxic")
    wanted = stored(blocks.filter("at < 0").select("block", "data").mapInArrow(_wanted, "of bigint, gram string"), "toxicity-wanted")
    ratios = stored(gram_ratios(blocks, wanted, classes), "toxicity-ratios")
    told = wanted.join(ratios, "gram").select("of", "gram", "ratio")
    found = blocks.groupBy("block").cogroup(told.groupBy("of")).applyInPandas(_evidence, "doc_id string, evidence array<double>")
    found = stored(found, "toxicity-evidence")
    # At most MAX_CALIBRATION_ROWS rows of a few numbers reach the driver.
    drawn = found.join(agreed, "doc_id").orderBy(F.desc("_tests"), F.xxhash64(F.lit(13), "doc_id"), "doc_id", "evidence").limit(MAX_CALIBRATION_ROWS).collect()
    tested = [r for r in drawn if r["_tests"]]
    score = F.lit(sum(r["toxic"] for r in drawn) / len(drawn) if drawn else 0.5)
    if 0 < sum(r["toxic"] for r in tested) < len(tested):
        weights = _logistic(np.array([r["evidence"] for r in tested]), np.array([r["toxic"] for r in tested], np.float64))
        total = F.lit(float(weights[-1]))
        for i, w in enumerate(weights[:-1]):
            total = total + F.col("evidence")[i] * float(w)
        score = 1 / (1 + F.exp(-total))
    return found.select(F.col("doc_id").cast(kind).alias("doc_id"), score.cast("double").alias("score"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by models of the rows that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
