"""Benchmark decontamination by latent semantic retrieval and longest common subsequences.

1. Every text becomes its words, as 32-bit hashes (lower case, ASCII punctuation dropped).
2. Passages are runs of words. Their TF-IDF matrix over ``BINS`` hashed words gets a
   randomised singular value decomposition in one pass over all passages: with the matrix A
   and random columns W each task sums its part of Z = A'(A W), which is BINS x RANK numbers
   whatever the corpus; the Nystroem form of A'A made from Z and W'Z has the right singular
   vectors and values. Only these sums reach the driver.
3. Overlapping windows of every document and of every benchmark item are mapped to the
   latent space, scaled by the singular values; pairs above a cosine, and no others, are
   candidates. The cut follows from the least share of words that step 4 accepts, the
   windows' worst offset and the spread that the rank leaves (``LEAST_COSINE``).
   Of the candidates those go whose common words, counted as a bag, are fewer than step 4
   asks for; no leak is below that bound, so texts without such a pair are not mapped. An
   item is counted if a text has one of its rarest words, so few that every leak must hold
   one of them, or the rarest word of its answer.
4. A candidate is a leak if the longest common subsequence of the item and the document
   around the window has enough of the item's words, or fewer but the item's answer, its
   last sentence, verbatim. Items of fewer than ``SHORT`` words must occur verbatim.

Items are taken in blocks of about ``ITEMS_AT_ONCE``, each against all documents. NULL and
empty texts and items match nothing. Repeated rows are decided alike. Further columns are kept.
Ids are of any type; items without an id are left out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.llm.common import shuffle_width, stored, table

BINS, RANK, SPARE = 4096, 160, 8
#: Words of half a window, and from one window of a document to the next. A window is a passage.
HALF, STEP = 24, 12
LEAK_SHARE, LEAK_SHARE_WITH_ANSWER, SHORT = 0.7, 0.5, 8
#: A window that holds a whole item of L words has about the cosine sqrt(L / window) to it.
#: Candidates reach this share of that: the least share of words that is a leak, of which the
#: nearest window lacks half a step at worst, less 1.75 times the spread of cosines at this rank.
LEAST_COSINE = LEAK_SHARE_WITH_ANSWER * (1 - STEP / 2 / (2 * HALF)) - 1.75 / math.sqrt(RANK)
ITEMS_AT_ONCE = 4000
#: Bins whose part of Z is summed as a dense product, the most frequent ones.
DENSE = 512
#: Windows whose words are counted at once against the items' words.
WINDOWS_AT_ONCE = 64
#: Rows of Z that are added up together; words of a text that are mapped at once.
CHUNK, WORDS_AT_ONCE = 64, 1 << 18

_FOLD = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
MATCH = T.StructType(
    [T.StructField("item", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("lcs_words", "item_words", "first_word")]
    + [T.StructField("cosine", T.DoubleType()), T.StructField("answer_found", T.BooleanType())]
)


def words_of(text: str) -> np.ndarray:
    """The words of a text as hashes."""
    words = text.lower().encode().translate(_FOLD).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def hashed_words(docs: DataFrame, text: str) -> DataFrame:
    """``words``: the hashes of each text as bytes."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(v.as_py()).tobytes() for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(words, pa.binary())], names=[*batch.schema.names[:-1], "words"])

    rows = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body"))
    return rows.mapInArrow(compute, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, words binary")


def passages(batches: Iterator[pa.RecordBatch], most: int = 4096) -> Iterator[np.ndarray]:
    """The passages of all texts, one after the other, as rows of bins; BINS pads."""
    held, count = [], 0
    for batch in batches:
        for value in batch.column(batch.num_columns - 1):
            words = np.frombuffer(value.as_buffer() or b"", np.uint32) % BINS
            for i in range(0, len(words), most * 2 * HALF):
                part = words[i : i + most * 2 * HALF]
                rows = np.full((-(-len(part) // (2 * HALF)), 2 * HALF), BINS, np.uint16)
                rows.ravel()[: len(part)] = part
                held.append(rows)
                count += len(rows)
                if count >= most:
                    yield np.concatenate(held)
                    held, count = [], 0
    if held:
        yield np.concatenate(held)


def inverse_frequencies(hashed: DataFrame) -> np.ndarray:
    """IDF of each bin over all passages, and 0 for the padding."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(BINS + 1, np.int64), 0
        for rows in passages(batches):
            ordered = np.sort(rows, 1)
            first = np.ones(rows.shape, bool)
            first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            found += np.bincount(ordered[first], minlength=BINS + 1)
            n += len(rows)
        found[BINS] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS + 1)), pa.array(found)], names=["bin", "n"])

    rows = hashed.select("words").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(BINS + 1)
    for r in rows:
        found[r["bin"]] = r["n"]
    idf = np.log((found[BINS] + 1) / (found + 1)) + 0.01
    idf[BINS] = 0
    return idf.astype(np.float32)


def row_sums(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each row of bins the sum of their vectors."""
    total = vectors.take(rows[:, 0], axis=0)
    for j in range(1, rows.shape[1]):
        total += vectors.take(rows[:, j], axis=0)
    return total


def decompose(hashed: DataFrame, idf: np.ndarray) -> np.ndarray:
    """The map from bins to the scaled latent space, (BINS + 1) x rank."""
    width = RANK + SPARE
    random = np.random.default_rng(9).standard_normal((BINS, width)).astype(np.float32)
    weighted = np.zeros((BINS + 1, width), np.float32)
    weighted[:BINS] = random * idf[:BINS, None]
    dense = np.argsort(idf[:BINS], kind="stable")[:DENSE]
    place = np.full(BINS + 1, DENSE)
    place[dense] = np.arange(DENSE)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros((BINS + 1, width), np.float32)
        for rows in passages(batches):
            y = row_sums(weighted, rows)
            flat = rows.ravel()
            owner, at = np.repeat(np.arange(len(rows)), rows.shape[1]), place[flat]
            counts = np.bincount(owner * (DENSE + 1) + at, minlength=len(rows) * (DENSE + 1)).reshape(len(rows), -1)
            z[dense] += counts[:, :DENSE].T.astype(np.float32) @ y
            rare = (at == DENSE) & (flat != BINS)
            flat, owner = flat[rare], owner[rare]
            order = np.argsort(flat, kind="stable")
            bins, starts = np.unique(flat[order], return_index=True)
            if len(bins):
                z[bins] += np.add.reduceat(y.take(owner[order], axis=0), starts, 0)
        chunks = [z[i : i + CHUNK].tobytes() for i in range(0, BINS, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(chunks))), pa.array(chunks, pa.binary())], names=["chunk", "z"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, z in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(z.as_buffer(), np.float32).astype(np.float64)
        if sums:
            data = [v.tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(data, pa.binary())], names=["chunk", "z"])

    parts = hashed.select("words").mapInArrow(part, "chunk long, z binary").repartition(shuffle_width(hashed.sparkSession), "chunk")
    z = np.zeros((BINS, width))
    for r in parts.mapInArrow(add, "chunk long, z binary").collect():
        z[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["z"]).reshape(CHUNK, width)
    z *= idf[:BINS, None]
    core = random.astype(np.float64).T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-6  # sums are of single precision
    nystroem = z @ (vectors[:, good] / np.sqrt(values[good]))
    left, singular, _ = np.linalg.svd(nystroem, full_matrices=False)
    real = singular > singular.max(initial=0) * 1e-3
    left, singular = left[:, real][:, :RANK], singular[real][:RANK]
    out = np.zeros((BINS + 1, max(1, len(singular))), np.float32)
    out[:BINS, : len(singular)] = idf[:BINS, None] * left / singular
    return out


def windows(words: np.ndarray, latent: np.ndarray, step: int = HALF) -> np.ndarray:
    """Unit vectors of the overlapping windows of a text, one per step up to its end."""
    pieces = []
    for i in range(0, len(words), WORDS_AT_ONCE // HALF * HALF):
        part = words[i : i + WORDS_AT_ONCE // HALF * HALF] % BINS
        rows = np.full((-(-len(part) // step), step), BINS, np.uint16)
        rows.ravel()[: len(part)] = part
        pieces.append(row_sums(latent, rows))
    if not pieces:
        return np.zeros((0, latent.shape[1]), np.float32)
    piece, most = np.concatenate(pieces), 2 * HALF // step
    count = max(1, len(piece) - most + 1)
    total = piece[:count].copy()
    for k in range(1, min(most, len(piece))):
        total += piece[k : k + count]
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)


def common_words(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the item's places of each word."""
    row = full = (1 << length) - 1
    for w in words:
        if mask := masks.get(w):
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


@dataclass
class Item:
    number: str
    words: np.ndarray
    answer: np.ndarray
    masks: dict[int, int]

    @staticmethod
    def of(number: str, text: str) -> Item | None:
        words = words_of(text)
        if not len(words):
            return None
        answer = words_of(re.split(r"(?<=[.!?])\s+", text.strip())[-1])
        masks: dict[int, int] = {}
        for i, w in enumerate(words.tolist()):
            masks[w] = masks.get(w, 0) | 1 << i
        return Item(number, words, answer if 4 <= len(answer) < len(words) else words[:0], masks)

    @property
    def least(self) -> int:
        """Common words of every leak without the answer."""
        return len(self.words) if len(self.words) < SHORT else math.ceil(LEAK_SHARE * len(self.words))

    @property
    def least_with_answer(self) -> int:
        return math.ceil(LEAK_SHARE_WITH_ANSWER * len(self.words)) if len(self.answer) and len(self.words) >= SHORT else self.least

    def match(self, words: np.ndarray, window: int) -> tuple[int, bool, bool]:
        """Common words around the window, whether the answer is there, whether it is a leak."""
        n = len(self.words)
        near = words[max(0, window * HALF - n) : (window + 2) * HALF + n]
        data = near.tobytes()
        verbatim = lambda part: len(part) > 0 and any(m.start() % 4 == 0 for m in re.finditer(b"(?=" + re.escape(part.tobytes()) + b")", data))
        common = common_words(self.masks, n, near.tolist())
        answer = verbatim(self.answer)
        if n < SHORT:
            return common, answer, common == n and verbatim(self.words)
        return common, answer, common >= LEAK_SHARE * n or (answer and common >= LEAK_SHARE_WITH_ANSWER * n)


class Bags:
    """Finds the windows that share enough words with an item to be a leak, in any order."""

    def __init__(self, items: list[Item]):
        self.items = items
        bags = [np.unique(i.words, return_counts=True) for i in items]
        self.vocabulary, places, shared = np.unique(np.concatenate([b[0] for b in bags]), return_inverse=True, return_counts=True)
        self.counts = np.concatenate([b[1] for b in bags])
        self.begin = np.concatenate([[0], np.cumsum([len(b[0]) for b in bags])])
        self.places = places
        keys, owners = [], []
        for k, item in enumerate(items):
            own, counts = self.bag(k)
            order = np.argsort(shared[own], kind="stable")
            # A leak lacks at most n - least words, so it has one of any n - least + 1.
            enough = int(np.searchsorted(np.cumsum(counts[order]), len(item.words) - item.least + 1)) + 1
            chosen = set(own[order[:enough]].tolist())
            if item.least_with_answer < item.least:
                answer = np.searchsorted(self.vocabulary, item.answer)
                chosen.add(int(answer[shared[answer].argmin()]))
            keys += chosen
            owners += [k] * len(chosen)
        order = np.argsort(keys, kind="stable")
        self.owners = np.array(owners)[order]
        self.starts = np.searchsorted(np.array(keys)[order], np.arange(len(self.vocabulary) + 1))
        self.longest = max(len(i.words) for i in items)
        self.least = np.array([min(i.least, i.least_with_answer) for i in items])
        self.here = np.zeros(len(self.vocabulary), bool)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.vocabulary & 0xFFFF] = True
        self.local = np.full(len(self.vocabulary), -1)

    def bag(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words of an item, as places in the vocabulary, and how often each occurs."""
        return self.places[self.begin[k] : self.begin[k + 1]], self.counts[self.begin[k] : self.begin[k + 1]]

    def find(self, words: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int]]:
        """Windows from ``first`` to before ``last``, each with an item it may hold."""
        margin, step = self.longest, max(WINDOWS_AT_ONCE, self.longest // HALF)
        for at in range(first, last, step):
            until = min(at + step, last)
            begin = max(0, at * HALF - margin)
            near = words[begin : (until + 1) * HALF + margin]
            known = np.flatnonzero(self.maybe[near & 0xFFFF])
            place = np.minimum(np.searchsorted(self.vocabulary, near[known]), len(self.vocabulary) - 1)
            real = self.vocabulary[place] == near[known]
            if real.any():
                yield from self.near(near, begin + known[real], place[real], at, until)

    def near(self, near: np.ndarray, where: np.ndarray, place: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int]]:
        self.here[place] = True
        present = np.flatnonzero(self.here) if len(self.here) < 64 * len(place) else np.unique(place)
        self.here[place] = False
        starts, size = self.starts[present], self.starts[present + 1] - self.starts[present]
        asked = np.unique(self.owners[np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())])
        if not len(asked):
            return
        self.here[present] = True
        starts, size = self.begin[asked], self.begin[asked + 1] - self.begin[asked]
        ends = np.cumsum(size)
        at = np.repeat(starts - ends + size, size) + np.arange(ends[-1])
        common = np.add.reduceat(self.counts[at] * self.here[self.places[at]], ends - size)
        self.here[present] = False
        data = near.tobytes()
        for k, most in zip(asked[common >= self.least[asked]].tolist(), common[common >= self.least[asked]].tolist(), strict=True):
            item = self.items[k]
            n, least = len(item.words), item.least
            if item.least_with_answer < least and item.answer.tobytes() in data:
                least = item.least_with_answer
            if most < least:
                continue
            own, counts = self.bag(k)
            self.local[own] = np.arange(len(own))
            column = self.local[place]
            self.local[own] = -1
            hit = column >= 0
            column, at = column[hit], where[hit]
            # Window w is matched with the words from w * HALF - n to before (w + 2) * HALF + n.
            low = np.clip(-(-(at - n + 1) // HALF) - 2, first, last) - first
            high = np.clip((at + n) // HALF + 1, first, last) - first
            rows, width = last - first + 1, len(own)
            change = np.bincount(low * width + column, minlength=rows * width) - np.bincount(high * width + column, minlength=rows * width)
            held = np.minimum(change.reshape(rows, width).cumsum(0), counts).sum(1)[:-1]
            for w in np.flatnonzero(held >= least).tolist():
                yield first + w, k


@dataclass
class Retriever:
    """Finds a block of items in texts."""

    latent: np.ndarray
    items: list[Item]

    def __post_init__(self) -> None:
        vectors = [windows(i.words, self.latent) for i in self.items]
        self.owner = np.repeat(np.arange(len(self.items)), [len(v) for v in vectors])
        self.first = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int64)
        held = [min(2 * HALF, len(i.words) - w * HALF) for i, v in zip(self.items, vectors, strict=True) for w in range(len(v))]
        self.least = LEAST_COSINE * np.sqrt(np.array(held) / (2 * HALF))
        self.bags = Bags(self.items) if self.items else None
        self.queries = np.concatenate([np.zeros((0, self.latent.shape[1]), np.float32), *vectors]).T.copy()

    def candidates(self, vectors: np.ndarray, first: int, last: int, asked: np.ndarray) -> dict[tuple[int, int], float]:
        """Half-step windows from ``first`` to before ``last`` with the asked items near them, and the cosines."""
        per = HALF // STEP
        begin = max(0, (first - 1) * per + 1)
        query = np.flatnonzero(np.isin(self.owner, asked))
        cosines = vectors[begin : last * per] @ self.queries[:, query]
        found: dict[tuple[int, int], float] = {}
        for j, q in np.argwhere(cosines >= self.least[query]).tolist():
            item, cosine = int(self.owner[query[q]]), float(cosines[j, q])
            # A window between two of the coarser grid stands for both.
            for w in {(begin + j) // per, -(-(begin + j) // per)}:
                found[w, item] = max(cosine, found.get((w, item), -1.0))
        return found

    def find(self, words: np.ndarray) -> list[dict]:
        """The items that the text holds, each with its best window."""
        if not self.items:
            return []
        best: dict[int, dict] = {}
        count, vectors = max(1, -(-len(words) // HALF) - 1) if len(words) else 0, None
        for at in range(0, count, 4096):
            until = min(at + 4096, count)
            enough = set(self.bags.find(words, at, until))
            if not enough:
                continue  # nothing that step 4 could accept
            vectors = windows(words, self.latent, STEP) if vectors is None else vectors
            pairs = self.candidates(vectors, at, until, np.unique([k for _, k in enough]))
            for w, k in sorted(enough & pairs.keys()):
                cosine = pairs[w, k]
                item = self.items[k]
                common, answer, leak = item.match(words, w)
                if leak and common > best.get(item.number, {"lcs_words": -1})["lcs_words"]:
                    best[item.number] = {
                        "item": item.number, "lcs_words": common, "item_words": len(item.words),
                        "first_word": w * HALF, "cosine": min(1.0, cosine), "answer_found": answer,
                    }
        return list(best.values())


def item_blocks(benchmark: DataFrame, at_once: int) -> Iterator[list[Item]]:
    """The benchmark's items in blocks of about ``at_once``; each row once for each id and text."""
    rows = benchmark.select(F.col("item_id").cast("string"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    blocks = max(1, math.ceil(rows.count() / at_once))
    for b in range(blocks):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield [i for r in sorted(block) if (i := Item.of(r["item_id"], r["text"]))]


def latent_space(hashed: DataFrame) -> np.ndarray:
    return decompose(hashed, inverse_frequencies(hashed))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """One row per document and item it holds."""
    hashed = stored(hashed_words(docs, text), "decontamination-words")
    latent = latent_space(hashed)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = None
    for items in item_blocks(benchmark, at_once):

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            retriever = Retriever(latent, items)
            for batch in batches:
                rows = []
                for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                    rows += [{"doc_id": doc_id.as_py(), **m} for m in retriever.find(np.frombuffer(value.as_buffer() or b"", np.uint32))]
                kinds = [("doc_id", batch.schema.field(0).type), *[(f.name, k) for f, k in zip(MATCH, [pa.string(), *[pa.int64()] * 3, pa.float64(), pa.bool_()], strict=True)]]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MATCH)
        hits = hashed.mapInArrow(search, f"doc_id {id_type}, {fields}")
        found = hits if found is None else found.unionByName(hits)
    item_id = F.col("item").cast(benchmark.schema["item_id"].dataType)
    return found.select("doc_id", item_id.alias("item_id"), *[f.name for f in MATCH if f.name != "item"])


def is_clean(latent: np.ndarray, items: list[Item]):
    """A function of text columns: whether a text holds none of the items."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        retriever = Retriever(latent, items)
        for texts in batches:
            yield texts.map(lambda t: not retriever.find(words_of(t))).astype(bool)

    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    latent = latent_space(stored(hashed_words(docs, text), "decontamination-words"))
    for items in item_blocks(benchmark, at_once):
        docs = docs.filter(is_clean(latent, items)(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaks of the benchmark in the documents."""
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
