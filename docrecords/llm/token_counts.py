"""Exact token counts of whole texts, and of every prefix of a text.

The tokenizer drops white space and never lets a token span it, so the count of a
prefix is a sum over the words in it. ``prefix_table`` runs that recurrence,
``count[i] = count[i - 1] + tokens(word i)``, and keeps each word's end with the count
up to it; a prefix that ends within a word adds the count of that word's part. Budget
and truncation questions are then searches in the table. Each distinct word is encoded
once per task (a bounded cache) by the tokenizer's own library, so counts are its own.

A NULL text is empty and has 0 tokens. Repeated rows count each; other columns pass.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import fresh, table

VOCABULARY = "word_bpe_49k.json"
#: Words in the cache of a task; it starts anew when full.
CACHED_WORDS = 400_000
#: White space on which words are split: what every reading of the pattern's \s agrees on.
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0d]+")


#: Tokens that the tokenizer takes from the text before anything else.
SPECIAL = re.compile(r"<\|(?:start|end)oftext\|>")
PREFIXES_AT_ONCE = 64


class WordCounter:
    """Token counts by word, for tokenizers that drop white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self.known: dict[bytes, int] = {}

    def encode_counts(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.encoder.encode_batch(words, add_special_tokens=False)]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word."""
        known = self.known
        if fresh := [w for w in set(words) if w not in known]:
            if len(known) + len(fresh) > CACHED_WORDS:
                known.clear()
                fresh = list(set(words))
            known.update(zip(fresh, self.encode_counts([w.decode() for w in fresh]), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def prefix_table(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Byte ends of the words, and the tokens up to each end; both begin with 0."""
        spans = [m.span() for m in WORD_BYTES.finditer(text)]
        counts = self.counts([text[a:b] for a, b in spans])
        return np.array([0, *(b for _, b in spans)]), np.concatenate([[0], counts.cumsum()])

    def prefix_count(self, text: bytes, ends: np.ndarray, totals: np.ndarray, at: int) -> int:
        """Tokens of the first ``at`` bytes, which must end a character."""
        i = int(np.searchsorted(ends, at, "right")) - 1
        part = text[int(ends[i]) : at].strip()
        return int(totals[i]) + (int(self.counts([part])[0]) if part else 0)

    def longest_prefix(self, text: bytes, ends: np.ndarray, totals: np.ndarray, budget: int) -> int:
        """Bytes of the longest prefix of at most ``budget`` tokens, white space after it left off."""
        i = int(np.searchsorted(totals, budget, "right")) - 1
        if i + 1 == len(ends):
            return int(ends[-1])
        rest = text[int(ends[i]) : int(ends[i + 1])]
        word, room = rest.lstrip().decode(), budget - int(totals[i])
        begin = len(rest) - len(rest.lstrip())
        fit = self.longest_part(word, room)
        return int(ends[i]) + (begin + len(word[:fit].encode()) if fit else 0)

    def longest_part(self, word: str, room: int) -> int:
        """Characters of the longest proper prefix of a word that has at most ``room`` tokens.

        Counts add up over the word's segments, so the prefix ends in the first segment that
        no longer fits as a whole; within it a longer prefix may have fewer tokens, so its
        prefixes are counted from the long end.
        """
        ends = segment_ends(word)
        totals = self.counts([word[a:b].encode() for a, b in zip([0, *ends], ends, strict=False)]).cumsum()
        i = int(np.searchsorted(totals, room, "right"))
        begin, left = (ends[i - 1], room - int(totals[i - 1])) if i else (0, room)
        part = word[begin : ends[min(i, len(ends) - 1)]]
        for k in range(len(part) - 1, 0, -PREFIXES_AT_ONCE):
            tried = range(k, max(0, k - PREFIXES_AT_ONCE), -1)
            for size, n in zip(tried, self.encode_counts([part[:t] for t in tried]), strict=True):
                if n <= left:
                    return begin + size
        return begin


def segment_ends(word: str) -> list[int]:
    """Ends of the segments of a word whose tokens do not depend on each other.

    The tokenizer takes each digit alone and ends a run of letters at punctuation; what
    composes with the letter before it, and a special token, is not parted.
    """
    inside = {k for m in SPECIAL.finditer(word) for k in range(m.start() + 1, m.end())}
    kinds = [unicodedata.category(c)[0] for c in word]
    digit = [c in "0123456789" for c in word]
    parted = [k for k in range(1, len(word)) if digit[k - 1] or digit[k] or (kinds[k - 1] == "L" and kinds[k] in "PS")]
    return [*(k for k in parted if k not in inside), len(word)]


def _pieces(words: list[bytes], size: int = 50_000) -> Iterator[list[bytes]]:
    for i in range(0, len(words), size):
        yield words[i : i + size]


def token_counts(docs: DataFrame, text: str = "text", budget: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """The rows with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_bytes``.

    ``fit_bytes`` is the length of the longest prefix of at most ``budget`` tokens.
    Columns of the same names are replaced; the text column is left out.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    added = "n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"
    names = ("n_bytes", "n_tokens", "over_limit", "fit_bytes")
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias(fresh(docs, "_body"))
    rows = docs.select(body, *[F.col(f"`{c}`") for c in docs.columns if c != text and c not in names])
    kept = rows.schema.fields[1:]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(path)
        for batch in batches:
            sizes, tokens, fits = [], [], []
            for value in batch.column(0):
                data = value.as_py()
                words = data.split()
                n = sum(int(counter.counts(part).sum()) for part in _pieces(words))
                fit = len(data.rstrip()) if n <= budget else counter.longest_prefix(data, *counter.prefix_table(data), budget)
                sizes.append(len(data))
                tokens.append(n)
                fits.append(fit)
            over = [n > budget for n in tokens]
            new = [pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_()), pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], names=[*batch.schema.names[1:], *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), added])
    return rows.mapInArrow(count, schema)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
