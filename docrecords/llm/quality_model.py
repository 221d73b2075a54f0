"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in a Pandas UDF. The trees are trained on the
driver from at most ``MAX_TRAINING_ROWS`` labelled rows, chosen by a hash of the id, so
the driver holds at most that many rows of a few dozen numbers however large the corpus.
Features are cut into at most 64 bins by quantiles; each tree grows level by level from
gradient histograms. A trained model is a few flat arrays, and scoring walks all rows of
a batch down all trees at once with numpy.

A NULL text is empty; empty texts get a score like any other. Labels count where all rows
of an id say the same. Without labels of both kinds the score is the share of label 1, or
0.5 without labels. Repeated rows count each; other columns are passed on unless a new
column has their name.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import table

MAX_TRAINING_ROWS = 20_000
BINS, TREES, DEPTH, RATE, L2 = 64, 60, 4, 0.15, 1.0
#: Bytes of a text that the compression statistic looks at together.
PACKED_BLOCK = 1 << 16

_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b" ", b"\n\t\r\x0b\x0c", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b".,;:'\"()-", b"!?", b"#*$%&<>|@^~_=+/\\[]{}`"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9
FEATURES = (
    [f"share_of_class_{k}" for k in range(10)]
    + ["log_words", "mean_word", "sd_word", "distinct_words", "distinct_pairs", "one_letter_words", "packed_share", "distinct_lines"]
    + ["words_per_line", "capitalised_words", "marked_words", "mean_sentence", "top_word_share", "upper_letters"]
)
_MARKED = re.compile(r"[#*$%&<>|!]")


def statistics(text: str) -> list[float]:
    """The features of one text, all finite."""
    data = text.encode()
    size = max(1, len(data))
    classes = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=10)
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x]
    packed = sum(len(zlib.compress(data[i : i + PACKED_BLOCK], 1)) for i in range(0, len(data), PACKED_BLOCK))
    capital = sum(w[0].isupper() for w in words)
    upper = sum(w.isupper() for w in counts)
    pairs = len(set(zip(words, words[1:])))
    return [
        *(classes / size),
        np.log1p(len(words)), lengths.mean(), lengths.std(), len(counts) / n, pairs / n, float((lengths == 1).sum()) / n, packed / size,
        len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), capital / n, len(_MARKED.findall(text)) / n,
        n / max(1, text.count(".") + text.count("!")), max(counts.values(), default=0) / n, upper / max(1, len(counts)),
    ]


@dataclass
class Forest:
    """Trees as arrays of one row per tree: nodes 0..2^DEPTH-2 split, the rest are leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the log loss; label kinds weigh the same in sum."""
    splits, leaves = 2**DEPTH - 1, 2**DEPTH
    empty = Forest(np.zeros((0, splits), np.int64), np.zeros((0, splits)), np.zeros((0, leaves)), 0.0)
    if len(y) == 0:
        return empty
    if y.min() == y.max():
        empty.base = 30.0 if y[0] else -30.0
        return empty
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    total, forest = np.zeros(len(y)), ([], [], [])
    offsets = np.arange(x.shape[1]) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(splits, np.int64), np.full(splits, np.inf)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (x.shape[1] * BINS) + offsets + binned).ravel()
            shape = (width, x.shape[1], BINS)
            g, h = (np.bincount(cell, np.repeat(v, x.shape[1]), width * x.shape[1] * BINS).reshape(shape).cumsum(2) for v in (grad, hess))
            gl, hl, g0, h0 = g[:, :, :-1], h[:, :, :-1], g[:, :1, -1:], h[:, :1, -1:]
            gain = gl**2 / (hl + L2) + (g0 - gl) ** 2 / (h0 - hl + L2) - g0**2 / (h0 + L2)
            gain[(hl < 1) | (h0 - hl < 1)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k, b in enumerate(best):
                f, cut = divmod(int(b), BINS - 1)
                if gain[k, f, cut] > 1e-6 and cut < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - splits
        leaf = -RATE * np.bincount(at, grad, leaves) / (np.bincount(at, hess, leaves) + L2)
        total += leaf[at]
        for part, value in zip(forest, (feature, threshold, leaf), strict=True):
            part.append(value)
    return Forest(*(np.array(part) for part in forest), 0.0)


def features(text: str = "text") -> Column:
    """The statistics of each text."""

    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        return texts.map(statistics)

    return compute(F.coalesce(F.col(text).cast("string"), F.lit("")))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", most: int = MAX_TRAINING_ROWS) -> Forest:
    """Trees trained on documents with labels; of more than ``most``, those with the least hashes."""
    agreed = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    agreed = agreed.agg(F.min("quality").alias("y"), F.max("quality").alias("_max")).filter("y = _max").select(F.col("doc_id").alias("_id"), "y")
    drawn = agreed.orderBy(F.xxhash64(F.lit(6), "_id"), "_id").limit(most)
    # At most ``most`` ids of 8 bytes with a label; repeated ids give repeated rows, hence the second limit.
    rows = docs.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    rows = rows.select("y", features("_text").alias("_x")).limit(2 * most).collect()
    x = np.array([r["_x"] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    order = np.lexsort((*x.T, [r["y"] for r in rows])) if rows else np.zeros(0, np.int64)
    return train(x[order], np.array([r["y"] for r in rows], np.int64)[order])


def score(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The rows with ``score``, the probability that the text is of good quality."""

    @F.pandas_udf("double")
    def compute(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return pd.Series(forest.score(x))

    return docs.withColumn("score", compute(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by trees trained on the rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    forest = fit(docs.select("doc_id", "text"), labels.filter(~held_out()))
    scored = score(docs.select("doc_id", held_out().alias("held_out"), "text"), forest)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
