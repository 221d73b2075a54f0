"""Streams that process what is new and stop, each with its own checkpoint.

All but those of ``state`` are stateless: the operators are the ones batches use, and
the checkpoint together with the file sink makes each input row count once. A run leaves no
shuffled rows and no open state behind, and of earlier state what a restart needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.operators.canonical import canonicalize
from docrecords.operators.extract import NativeExtractor, PythonExtractor, run_inference
from docrecords.schemas import CANONICAL, DOCUMENT_INTAKE, RESPONSE
from docrecords.session import SHUFFLES_GO, shared_dir, using
from docrecords.sources.files import stamp, stream_files
from docrecords.sources.listing import stream_listing, update
from docrecords.sources.tables import conform
from docrecords.streaming.state import STOPPING

Step = Callable[[DataFrame], DataFrame]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Appends to a table as a stream. Of tables that are rewritten, rows come again; see
    ``state.emit_changes``."""
    return spark.readStream.table(name)


def read_folder(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def _table_checkpoint(spark: SparkSession, table: str) -> str:
    """Below the shared folder, one per table name; a run in another session finds it again."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        raise ValueError("give a checkpoint, or set spark.checkpoint.dir")
    return f"{shared_dir(spark)}/docrecords/streams/{quote(table, safe='')}"


@contextmanager
def _run(spark: SparkSession) -> Iterator[None]:
    """The settings of a run; those of state that the session has chosen stay."""
    with using(spark, SHUFFLES_GO | {k: v for k, v in STOPPING.items() if spark.conf.get(k, None) is None}):
        yield


def drain_to_table(stream: DataFrame, table: str, schema: T.StructType, checkpoint: str | None = None) -> None:
    """Append everything new to a table with the declared layout, then stop."""
    checkpoint = checkpoint or _table_checkpoint(stream.sparkSession, table)
    writer = conform(stream, schema).writeStream.option("checkpointLocation", checkpoint)
    with _run(stream.sparkSession):
        writer.trigger(availableNow=True).toTable(table).awaitTermination()


def drain_to_folder(stream: DataFrame, folder: str, schema: T.StructType, checkpoint: str | None = None) -> None:
    """Append everything new to a parquet folder with the declared layout, then stop.

    Without another place the checkpoint is kept in the folder, where readers pass it over.
    """
    checkpoint = checkpoint or f"{folder.rstrip('/')}/_checkpoint"
    writer = conform(stream, schema).writeStream.option("checkpointLocation", checkpoint)
    with _run(stream.sparkSession):
        writer.trigger(availableNow=True).format("parquet").start(folder).awaitTermination()


def intake_stream(
    spark: SparkSession, folder: str, table: str, glob: str | None = None, checkpoint: str | None = None, max_age: str = "3650d"
) -> None:
    """Take new files in. The checkpoint knows each file, so late arrivals with old
    modification times are not missed, unless they are older than ``max_age``."""
    drain_to_table(stamp(stream_files(spark, folder, glob=glob, max_age=max_age)), table, DOCUMENT_INTAKE, checkpoint)


def listed_intake_stream(
    spark: SparkSession, folder: str, listing: str, table: str, like: str | None = None, checkpoint: str | None = None
) -> None:
    """Take new files in through a kept listing: any number of files, of any age.

    The listing is brought up to date, and its new batches are streamed; a run that fails
    goes on with the batches it had not finished. ``like`` is an SQL pattern of paths.
    """
    update(spark, folder, listing)
    files = stream_listing(spark, listing)
    drain_to_table(stamp(files if like is None else files.filter(F.col("path").like(like))), table, DOCUMENT_INTAKE, checkpoint)


def inference_stream(
    docs: DataFrame,
    table: str,
    extractor: NativeExtractor | None = None,
    fn: PythonExtractor | None = None,
    checkpoint: str | None = None,
) -> None:
    """Documents to responses."""
    drain_to_table(run_inference(docs, extractor, fn), table, RESPONSE, checkpoint)


def canonical_stream(
    responses: DataFrame, table: str, keep: str = "invoice", checkpoint: str | None = None
) -> None:
    """Responses to canonical records."""
    drain_to_table(canonicalize(responses, keep), table, CANONICAL, checkpoint)


def extraction_chain(
    spark: SparkSession,
    documents: str,
    responses: str,
    canonical: str,
    keep: str = "invoice",
    extractor: NativeExtractor | None = None,
    only: Step | None = None,
    checkpoints: tuple[str, str] | tuple[None, None] = (None, None),
) -> None:
    """documents -> responses -> canonical, two streams through a stored table.

    ``only`` narrows the document stream, for instance to one destination.
    """
    docs = read_table(spark, documents)
    inference_stream(docs if only is None else only(docs), responses, extractor, checkpoint=checkpoints[0])
    canonical_stream(read_table(spark, responses), canonical, keep, checkpoints[1])


def only_destination(name: str) -> Step:
    """Rows of one destination of a routed documents table."""
    return lambda docs: docs.filter(F.col("destination") == name)
