"""Binary files written by tasks, visible only once they are complete.

A task writes under a temporary name of its own attempt and returns one manifest row
per file. The manifest holds the rows of successful attempts only; a second job moves
exactly these files to their final names, and may be repeated. Readers follow the
manifest, so files of lost attempts are never seen; they go with the temporary folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

MANIFEST = "file string, temporary string, bytes long, records long, sha1 string"
FIELDS = ["file", "temporary", "bytes", "records", "sha1"]


def open_fs(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(root)


class ShardWriter:
    """Rolling files of one task; ``roll`` closes one and gives its manifest row."""

    def __init__(self, root: str, file_bytes: int):
        self.files, self.base = open_fs(root)
        self.attempt = TaskContext.get().taskAttemptId()
        self.file_bytes = file_bytes
        self.sink = None

    def open(self, name: str) -> None:
        self.files.create_dir(f"{self.base}/_temporary", recursive=True)
        self.name, self.temporary = name, f"_temporary/{name}.{self.attempt}"
        self.sink = self.files.open_output_stream(f"{self.base}/{self.temporary}", compression=None)
        self.bytes, self.records, self.digest = 0, 0, hashlib.sha1()

    def write(self, data: bytes, records: int = 1) -> None:
        self.sink.write(data)
        self.digest.update(data)
        self.bytes += len(data)
        self.records += records

    @property
    def full(self) -> bool:
        return self.bytes >= self.file_bytes

    def close(self) -> dict:
        self.sink.close()
        self.sink = None
        return dict(zip(FIELDS, (self.name, self.temporary, self.bytes, self.records, self.digest.hexdigest()), strict=True))


def manifest_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[f] for r in rows], k) for f, k in zip(FIELDS, kinds, strict=True)], names=FIELDS
    )


def publish(written: DataFrame, root: str) -> DataFrame:
    """Run the writing tasks, give their files final names, return the manifest."""
    spark = written.sparkSession
    pending, final = f"{root}/_pending", f"{root}/_manifest"
    written.write.parquet(pending)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_fs(root)
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{base}/{row['file']}"
                if files.get_file_info(target).type == fs.FileType.NotFound:
                    files.move(f"{base}/{row['temporary']}", target)
            yield batch

    spark.read.schema(MANIFEST).parquet(pending).mapInArrow(rename, MANIFEST).write.parquet(final)
    files, base = open_fs(root)
    if files.get_file_info(f"{base}/_temporary").type == fs.FileType.Directory:
        files.delete_dir(f"{base}/_temporary")
    return spark.read.schema(MANIFEST).parquet(final)
