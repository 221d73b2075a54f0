"""Substring deduplication by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text; where its upper 21 bits fall below a bound
a chunk ends. A cut depends on the 32 bytes before it alone, so texts
that share a passage share the cuts in it whatever stands before, and insertions move
nothing beyond the chunk they fall in. Chunks are told apart by a 64-bit digest. Of equal
chunks the first, by document id and place, stays. Runs of adjacent chunks that occurred
before are removed if they have at least ``MIN_RUN`` bytes, so a short repeated line or a
chance match of digests removes nothing.

A NULL text has no chunk. A document is an id and a text: rows with the same id and text are
decided alike, those with one id and other texts apart, in the order of a hash of the text. Documents
without an id come first, in the order of a hash of their text. Ids that are no integers go by the order
of their hashes. Offsets count bytes. Further columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.llm.common import stored, table, whole_row

MIN_RUN = 100
#: Places of documents without an id are at most this.
NO_ID = -(1 << 62)
#: Longest chunk, for text in which the hash finds no cut, and bytes hashed at once.
LONGEST, AT_ONCE = 512, 1 << 22
#: Of 2^21 values of the hash's upper bits so many cut: a chunk has 24 bytes on average.
_BITS, _LOW = 21, (1 << 21) // 24
_GEAR = np.random.default_rng(1).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes) -> np.ndarray:
    """The ends of all chunks; none lies within a character."""
    found, size = [], len(data)
    raw = np.frombuffer(data, np.uint8)
    for begin in range(0, size, AT_ONCE):
        lead = min(begin, 32)
        part = raw[begin - lead : begin + AT_ONCE]
        h = _GEAR[part]
        for s in (1, 2, 4, 8, 16):
            more = h.copy()
            more[s:] += h[:-s] << np.uint32(s)
            h = more
        at = np.flatnonzero((h >> np.uint32(32 - _BITS)) < _LOW) + 1 + begin - lead
        found.append(at[at > begin])
    ends = np.concatenate([*found, [size]]) if size else np.zeros(0, np.int64)
    ends = ends[ends < size]
    ends = ends[(raw[ends] & 0xC0) != 0x80]
    ends = np.unique(np.append(ends, size)) if size else ends
    gaps = np.diff(ends, prepend=0)
    if len(gaps) and gaps.max() > LONGEST:
        filled: list[int] = []
        for end, gap in zip(ends.tolist(), gaps.tolist(), strict=True):
            for k in range(end - gap + LONGEST, end, LONGEST):
                while raw[k] & 0xC0 == 0x80:
                    k -= 1
                filled.append(k)
            filled.append(end)
        ends = np.unique(filled)
    return ends


def place(docs: DataFrame, text: str) -> Column:
    """A number that orders documents: the id (a hash, if ids are no integers), or below all ids a hash of the text."""
    whole = isinstance(docs.schema["doc_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    known = F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    return F.coalesce(known, F.lit(NO_ID) - F.shiftrightunsigned(F.xxhash64(text), 2))


def version(text: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``place``, ``version``, ``digests`` and ``ends`` of each document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ends = [], []
            for value in batch.column(2):
                data = value.as_py()
                at = cuts(data)
                begin, found = 0, []
                for end in at.tolist():
                    found.append(xxhash.xxh3_64_intdigest(data[begin:end]))
                    begin = end
                digests.append(np.array(found, np.uint64).astype(np.int64))
                ends.append(at.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(digests, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], names=["place", "version", "digests", "ends"])

    rows = docs.select(place(docs, text).alias("place"), version(text).alias("version"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    return rows.mapInArrow(compute, "place long, version long, digests array<bigint>, ends array<bigint>")


def repeated_spans(docs: DataFrame, text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``place``, ``version``, ``start``, ``end``, ``kept_place``: the bytes to remove, and where they stay first."""
    stored_chunks = stored(chunks(docs, text), "substring-chunks")
    each = stored_chunks.select("place", "version", F.posexplode("digests").alias("n", "digest"))
    first = F.min(F.struct("place", "version", "n"))
    known = each.groupBy("digest").agg(first.alias("first"), F.max(F.struct("place", "version", "n")).alias("last"))
    known = stored(known.filter("first <> last").select("digest", F.col("first.place").alias("kept_place"), F.col("first.version").alias("kept_version"), F.col("first.n").alias("kept_n")), "substring-known")
    later = each.join(known, "digest").filter("place > kept_place OR version > kept_version OR n > kept_n")
    # Chunks of one document, at most as many as it has: a run goes on where numbers follow on.
    marked = later.groupBy("place", "version").agg(F.array_sort(F.collect_set(F.struct("n", "kept_place"))).alias("marked"))
    once = stored_chunks.select("place", "version", "ends").join(stored(marked, "substring-marked"), ["place", "version"]).dropDuplicates(["place", "version"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for where, text, ends, marked in zip(*(batch.column(i) for i in range(4)), strict=True):
                ends, marked = np.array(ends.as_py()), marked.as_py()
                n = np.array([m["n"] for m in marked])
                breaks = np.flatnonzero(np.diff(n, prepend=n[0] - 2) != 1)
                for a, b in zip(breaks, [*breaks[1:], len(n)], strict=True):
                    start, end = int(ends[n[a] - 1]) if n[a] else 0, int(ends[n[b - 1]])
                    if end - start >= min_run:
                        rows.append((where.as_py(), text.as_py(), start, end, marked[a]["kept_place"]))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "version", "start", "end", "kept_place"])

    return once.select("place", "version", "ends", "marked").mapInArrow(runs, "place long, version long, start long, end long, kept_place long")


def remove_repeats(docs: DataFrame, text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """The documents without the bytes of repeated spans; all other columns as they are."""
    spans = stored(repeated_spans(docs, text, min_run), "substring-spans")
    spans = spans.groupBy("place", "version").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    rows = docs.select(whole_row(docs).alias("doc"), place(docs, text).alias("place"), version(text).alias("version"), F.col(text).cast("binary").alias("b"))
    rows = rows.join(spans, ["place", "version"], "left")
    keep = "transform(sequence(0, size(spans)), i -> struct(if(i = 0, 0L, spans[i - 1].end) AS a, if(i = size(spans), octet_length(b), spans[i].start) AS z))"
    left = F.expr(f"cast(aggregate({keep}, cast('' AS binary), (t, x) -> concat(t, substring(b, cast(x.a + 1 AS int), cast(x.z - x.a AS int)))) AS string)")
    new = F.when(F.col("spans").isNull(), F.col(f"doc.`{text}`")).otherwise(left).alias(text)
    return rows.select(*[new if c == text else F.col(f"doc.`{c}`") for c in docs.columns])


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages of all documents, each with the document where it stays."""
    spans = repeated_spans(table(spark, sf_dir, "documents"))
    own = lambda c: F.when(F.col(c) > NO_ID, F.col(c))
    return spans.select(own("place").alias("doc_id"), own("kept_place").alias("kept_doc_id"), "start", "end")
