"""Token ids packed into rows of fixed length, written as binary files.

Each text is encoded, ended by an end-of-text id and cut into parts of at most ``length``
ids, in order and without loss. Parts are packed best-fit decreasing: the longest first,
each into the fullest row that still has room, found in a segment tree over room sizes.
A task packs its own rows in blocks, so memory is bounded and nothing is shuffled; the
parts of badly filled rows of a block go on to the next one.

A task writes, through temporary names and a manifest (``shards``), files of packed ids
(a little-endian matrix of ``length`` columns, padded with the end id) and Arrow files with,
for each row, the cumulative segment lengths, the places where positions begin anew, and
the documents with the number of the part.

A NULL or empty text is the end id alone. Repeated rows are packed each; special strings
in texts are ordinary text. Columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import io
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docrecords.llm.common import table
from docrecords.llm.shards import MANIFEST, ShardWriter, manifest_batch, open_fs, publish
from docrecords.session import run_dir

VOCABULARY = "byte_bpe_50k.tiktoken"
LENGTH = 2048
#: Ids that a task holds while it packs a block.
BLOCK_IDS = 8 << 20
#: Rows filled less than this share are packed again with the next block.
WELL_FILLED = 0.97


class RoomTree:
    """Open rows by room: the smallest room of at least a given size, in O(log length)."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.full = bytearray(2 * self.size)
        self.rows: dict[int, list[int]] = defaultdict(list)

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node and not self.full[node]:
            self.full[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the smallest room >= least."""
        full, node = self.full, least + self.size
        if not full[node]:
            while node > 1 and (node & 1 or not full[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not full[2 * node])
        room = node - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            full[node] = 0
            while node > 1 and not full[node ^ 1]:
                node >>= 1
                full[node] = 0
        return room, row


def best_fit_decreasing(lengths: np.ndarray, length: int) -> list[list[int]]:
    """Rows as lists of item numbers; no row's sum exceeds ``length``."""
    tree, rows = RoomTree(length), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        if found := tree.take(need):
            room, row = found
            rows[row].append(item)
        else:
            room, row = length, len(rows)
            rows.append([item])
        if room > need:
            tree.add(room - need, row)
    return rows


def encoder(path: str):
    """The tokenizer of a rank file; special strings are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _segments(id_type: pa.DataType) -> pa.Schema:
    lists = [("cu_seqlens", pa.int32()), ("position_resets", pa.int32()), ("doc_ids", id_type), ("doc_parts", pa.int32())]
    return pa.schema([("row", pa.int64()), ("n_tokens", pa.int32()), *[(n, pa.list_(t)) for n, t in lists]])


class _Sink(io.RawIOBase):
    """A shard as the file object that Arrow's stream writer wants; the shard closes itself."""

    def __init__(self, shard: ShardWriter):
        self.shard = shard

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.shard.write(bytes(data), 0)
        return len(data)


class Packer:
    """The block of one task and its files."""

    def __init__(self, root: str, length: int, end: int, id_type: pa.DataType, file_bytes: int, block_ids: int):
        self.ids_out, self.segments_out = ShardWriter(root, file_bytes), ShardWriter(root, file_bytes)
        self.length, self.end, self.schema = length, end, _segments(id_type)
        self.kind = "<u2" if end < 1 << 16 else "<u4"
        self.partition, self.sequence = TaskContext.get().partitionId(), 0
        self.parts: list[tuple] = []
        self.held, self.block_ids = 0, block_ids

    def add(self, doc_id, ids: np.ndarray) -> Iterator[dict]:
        """Put a document into the block; yields manifest rows of files that this closed."""
        for part in range(0, len(ids), self.length):
            self.parts.append((doc_id, part // self.length, ids[part : part + self.length]))
            self.held += min(self.length, len(ids) - part)
            if self.held >= self.block_ids:
                yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[dict]:
        parts = self.parts
        rows = best_fit_decreasing(np.array([len(p[2]) for p in parts], np.int64), self.length)
        filled = [sum(len(parts[i][2]) for i in r) for r in rows]
        again = [] if last else [i for r, n in zip(rows, filled, strict=True) if n < WELL_FILLED * self.length for i in r]
        self.parts = [parts[i] for i in sorted(again)]
        self.held = sum(len(p[2]) for p in self.parts)
        if self.held >= self.block_ids // 2:  # hardly anything fits: better a loose row than a block that stays full
            again, self.parts, self.held = [], [], 0
        skip = set(again)
        rows = [r for r in rows if r[0] not in skip]
        matrix = np.full((len(rows), self.length), self.end, self.kind)
        table: dict[str, list] = {n: [] for n in self.schema.names}
        if rows and self.ids_out.sink is None:
            name = f"packed-{self.partition:06d}-{self.sequence:04d}"
            self.ids_out.open(f"{name}.ids.bin")
            self.segments_out.open(f"{name}.segments.arrow")
            self.stream = pa.ipc.new_stream(_Sink(self.segments_out), self.schema)
        for number, row in enumerate(rows, self.ids_out.records if rows else 0):
            ends = np.cumsum([0] + [len(parts[i][2]) for i in row])
            matrix[number - self.ids_out.records, : ends[-1]] = np.concatenate([parts[i][2] for i in row])
            values = (number, ends[-1], ends, ends[:-1], [parts[i][0] for i in row], [parts[i][1] for i in row])
            for name, value in zip(self.schema.names, values, strict=True):
                table[name].append(value)
        if rows:
            self.ids_out.write(matrix.tobytes(), len(rows))
            self.segments_out.records += len(rows)
            self.stream.write_batch(pa.RecordBatch.from_pydict(table, self.schema))
        if self.ids_out.sink is not None and (last or self.ids_out.full):
            self.stream.close()
            self.sequence += 1
            yield from (self.ids_out.close(), self.segments_out.close())


def write_packed(
    docs: DataFrame,
    root: str,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    vocabulary: str | None = None,
    file_bytes: int = 1 << 30,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write the packed documents below ``root``; returns the manifest."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        end = encoding.n_vocab
        packer = Packer(root, length, end, id_type, file_bytes, block_ids)
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoding.encode_to_numpy(value.as_py(), disallowed_special=())
                closed = list(packer.add(doc_id.as_py(), np.append(ids, end).astype(packer.kind)))
                if closed:
                    yield manifest_batch(closed)
        yield manifest_batch(list(packer.flush(last=True)))

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return publish(rows.mapInArrow(pack, MANIFEST), root)


def read_packed(manifest: DataFrame, root: str, id_type: str = "bigint", length: int = LENGTH, width: int = 2) -> DataFrame:
    """One row per packed row: ``file``, ``row``, its segments, and ``input_ids`` as bytes."""
    schema = (
        "file string, row long, n_tokens int, cu_seqlens array<int>, position_resets array<int>,"
        f" doc_ids array<{id_type}>, doc_parts array<int>, input_ids binary"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_fs(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                stem = name.removesuffix(".ids.bin")
                with files.open_input_stream(f"{base}/{name}") as ids, files.open_input_stream(f"{base}/{stem}.segments.arrow") as side:
                    for segments in pa.ipc.open_stream(side):
                        for i in range(0, len(segments), 512):
                            part = segments.slice(i, 512)
                            data = ids.read(len(part) * length * width)
                            rows = [data[k * length * width : (k + 1) * length * width] for k in range(len(part))]
                            columns = [pa.array([stem] * len(part)), *part.columns, pa.array(rows, pa.binary())]
                            yield pa.RecordBatch.from_arrays(columns, names=["file", *part.schema.names, "input_ids"])

    matrices = manifest.filter(F.col("file").endswith(".ids.bin")).select("file")
    return matrices.repartition(max(1, min(matrices.count(), 100_000))).mapInArrow(read, schema)


def pack(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents packed with the default settings, written and read back."""
    root = run_dir(spark, "packed")
    return read_packed(write_packed(docs, root), root, docs.schema["doc_id"].dataType.simpleString())


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token ids."""
    return pack(spark, table(spark, sf_dir, "documents"))
