"""Folders that tasks list and read, and listings that are kept.

Spark's own file sources list a folder on the driver, which then holds every path, and its
file stream forgets files by age. Here tasks list sub-folders and open files, level by level,
through Arrow's file systems, and a listing is a folder of numbered batches::

    <listing>/batch=000000001/part-....parquet   path, modificationTime, length
    <listing>/batch=000000001/_SUCCESS

Each update appends the file versions that no batch has, however old they are. A batch counts
once Spark has marked it; what a killed update leaves is overwritten by the next one. The data
source ``listed_files`` reads a listing as a stream whose offsets are batch numbers and whose
partitions are the batches' part files, so the driver sees neither paths nor contents.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from docrecords.session import kept

FILE = "path string, modificationTime timestamp, length bigint"
CONTENT = f"{FILE}, content binary"
VERSION = ["path", "modificationTime"]
#: Paths in a part file of a batch, so files that one task of a stream opens one after the other.
FILES_PER_PART = 1_000
ROWS_OUT, BYTES_OUT = 10_000, 32 << 20
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")

_TIME = pa.timestamp("us", "UTC")
_FILE = [("path", pa.string()), ("modificationTime", _TIME), ("length", pa.int64())]
LISTED_SCHEMA = pa.schema([*_FILE, ("is_folder", pa.bool_())])
CONTENT_SCHEMA = pa.schema([*_FILE, ("content", pa.binary())])


def scheme_of(path: str) -> str:
    return path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"


def readable(path: str) -> bool:
    """Whether tasks can reach this place by themselves."""
    return scheme_of(path) in SCHEMES


def store_of(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path in it, and what precedes that in full paths."""
    scheme = scheme_of(path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file:"
    store, inner = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    return store, inner, path.removesuffix("/")[: len(path.removesuffix("/")) - len(inner.removesuffix("/"))]


def _hidden(name: str) -> bool:
    """The files that Spark's sources pass over, too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files and sub-folders of folders. Empty files count, which Spark's sources drop."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            store, inner, before = store_of(folder)
            found = [i for i in store.get_file_info(fs.FileSelector(inner)) if not _hidden(i.base_name)]
            for k in range(0, len(found), ROWS_OUT):
                part = found[k : k + ROWS_OUT]
                columns = [
                    pa.array([before + i.path for i in part]),
                    # Spark's sources know milliseconds.
                    pa.array([None if i.mtime_ns is None else i.mtime_ns // 1_000_000 * 1_000 for i in part], pa.int64()).cast(_TIME),
                    pa.array([i.size for i in part], pa.int64()),
                    pa.array([i.type == fs.FileType.Directory for i in part]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=LISTED_SCHEMA)


def walk(spark: SparkSession, folder: str) -> DataFrame:
    """All files below ``folder``; each level of folders is one job, each folder one row of it."""
    store, inner, before = store_of(folder)
    folders, files = spark.createDataFrame([(before + inner.rstrip("/"),)], "path string"), None
    while not folders.isEmpty():
        listed = kept(folders.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_children, f"{FILE}, is_folder boolean"), "listed")
        found = listed.filter(~F.col("is_folder")).drop("is_folder")
        files = found if files is None else files.unionByName(found)
        folders = listed.filter("is_folder").select("path")
    return files


def _content(path: str) -> bytes:
    store, inner, _ = store_of(path)
    with store.open_input_stream(inner) as stream:
        return stream.read()


def _with_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files with their bytes, in batches of about ``BYTES_OUT``."""
    for batch in batches:
        first, size, held = 0, 0, []
        for k, path in enumerate(batch.column("path").to_pylist()):
            held.append(_content(path))
            size += len(held[-1])
            if size >= BYTES_OUT or k + 1 == batch.num_rows:
                columns = [batch.column(name).slice(first, len(held)) for name in LISTED_SCHEMA.names[:3]]
                columns[1] = columns[1].cast(_TIME)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(held, pa.binary())], schema=CONTENT_SCHEMA)
                first, size, held = k + 1, 0, []


def with_content(files: DataFrame) -> DataFrame:
    """Files (path, modificationTime, length) with their content, read by the tasks."""
    return files.select("path", "modificationTime", "length").mapInArrow(_with_content, CONTENT)


# --- kept listings ----------------------------------------------------------------------


def _batch_folder(listing: str, number: int) -> str:
    return f"{listing.rstrip('/')}/batch={number:09d}"


def batch_numbers(listing: str) -> list[int]:
    """The batches that count, in order. One folder is listed; it has an entry for each update."""
    store, inner, _ = store_of(listing)
    found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    numbers = sorted(int(i.base_name.removeprefix("batch=")) for i in found if i.base_name.startswith("batch="))
    marked = lambda n: store.get_file_info(store_of(_batch_folder(listing, n))[1] + "/_SUCCESS").type == fs.FileType.File
    # Updates follow each other, so only the last batch may be without a mark.
    return numbers if not numbers or marked(numbers[-1]) else numbers[:-1]


def listed(spark: SparkSession, listing: str) -> DataFrame:
    """The file versions of all batches."""
    folders = [_batch_folder(listing, n) for n in batch_numbers(listing)]
    return spark.read.schema(FILE).parquet(*folders) if folders else spark.createDataFrame([], FILE)


def append_batch(files: DataFrame, listing: str) -> int:
    """Append the versions that no batch has; returns the last batch's number, 0 if there is none."""
    spark, numbers = files.sparkSession, batch_numbers(listing)
    last = numbers[-1] if numbers else 0
    fresh = files.select("path", "modificationTime", "length")
    if last:
        fresh = fresh.join(listed(spark, listing).select(*VERSION), VERSION, "left_anti")
    fresh = kept(fresh, "fresh")
    if fresh.isEmpty():
        return last
    writer = fresh.write.mode("overwrite").option("maxRecordsPerFile", FILES_PER_PART)
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(_batch_folder(listing, last + 1))
    return last + 1


def update(spark: SparkSession, folder: str, listing: str) -> int:
    """List ``folder`` and append what is new to the listing."""
    return append_batch(walk(spark, folder), listing)


@dataclass
class Part(InputPartition):
    """A part file of a batch."""

    path: str


class ListedFiles(DataSource):
    """``listed_files``: the files of a listing, as a table or as a stream.

    Options: ``path``, the listing; ``content`` (default true), whether files are opened.
    """

    @classmethod
    def name(cls) -> str:
        return "listed_files"

    def schema(self) -> str:
        return CONTENT if self._opens() else FILE

    def _opens(self) -> bool:
        return self.options.get("content", "true").lower() == "true"

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options["path"], self._opens())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802 - the interface's name
        return _StreamReader(self.options["path"], self._opens())


class _Parts:
    def __init__(self, listing: str, opens: bool) -> None:
        self.listing, self.opens = listing, opens

    def parts(self, numbers: list[int]) -> list[Part]:
        found = []
        for n in numbers:
            store, inner, before = store_of(_batch_folder(self.listing, n))
            info = store.get_file_info(fs.FileSelector(inner))
            found += [Part(before + i.path) for i in info if posixpath.basename(i.path).startswith("part-")]
        return found

    def rows(self, part: Part) -> Iterator[pa.RecordBatch]:
        store, inner, _ = store_of(part.path)
        with store.open_input_file(inner) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=LISTED_SCHEMA.names[:3]):
                if self.opens:
                    yield from _with_content(iter([batch]))
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(_TIME), batch.column(2)], schema=pa.schema(_FILE))


class _BatchReader(_Parts, DataSourceReader):
    def partitions(self) -> list[Part]:
        return self.parts(batch_numbers(self.listing)) or [Part("")]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from self.rows(partition)


class _StreamReader(_Parts, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {"batch": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"batch": max(batch_numbers(self.listing), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return self.parts([n for n in batch_numbers(self.listing) if start["batch"] < n <= end["batch"]])

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from self.rows(partition)


def read_listing(spark: SparkSession, listing: str, content: bool = True) -> DataFrame:
    """All files of a listing."""
    spark.dataSource.register(ListedFiles)
    return spark.read.format("listed_files").option("content", str(content).lower()).load(listing)


def stream_listing(spark: SparkSession, listing: str, content: bool = True) -> DataFrame:
    """The files of a listing as a stream, a batch after the other."""
    spark.dataSource.register(ListedFiles)
    return spark.readStream.format("listed_files").option("content", str(content).lower()).load(listing)
