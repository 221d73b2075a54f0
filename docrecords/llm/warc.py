"""WARC archives: a deterministic sharded writer and a streaming reader.

``write_archive`` turns rows into WARC/1.1 records, one gzip member each. Records are
range-partitioned by key with bounds that depend on the data alone and sorted within a
shard; a shard rolls to a new file once its compressed size passes ``file_bytes``.
Headers, digests and record ids are made anew from the content, so equal input gives
equal bytes. Files appear through temporary names and a manifest (``shards``).

Of records with equal payloads of at least ``revisit_from`` bytes, the one with the
largest key is written whole, the others as revisits of it.

Defined results: a NULL payload is empty; a NULL uri has no target header and reads as
NULL; NULL keys sort first and are a response only if no record with the same payload
has a key; of rows with the same key and payload the first is the response and the
others revisit it; an empty table gives an empty manifest. Further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import stored, table
from docrecords.llm.shards import ShardWriter, manifest_batch, open_fs, publish
from docrecords.session import run_dir

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-records")
#: About so many keys are looked at to place the bounds of shards.
BOUND_KEYS = 20_000
READ = "record_key string, uri string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, '|'.join(map(str, parts)))}>"


def safe(value: str) -> str:
    """A header value: control characters and blanks at the ends are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f%]|^ | $", lambda m: f"%{ord(m[0]):02X}", value)


def unsafe(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without a time stamp."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def base32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def page_record(key, uri: str | None, payload: bytes, digest: str, created: str, refers: tuple | None) -> bytes:
    """A response with its payload, or, where ``refers`` holds the other key, a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    headers = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(key, digest, bool(refers)))]
    headers += [("WARC-Date", created)]
    headers += [] if uri is None else [("WARC-Target-URI", safe(uri))]
    headers += [("WARC-Payload-Digest", base32(digest)), ("WARC-Block-Digest", base32(hashlib.sha1(block).hexdigest()))]
    if refers:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers[0], digest, False))]
        headers += [] if refers[0] is None else [("X-Refers-To-Key", safe(str(refers[0])))]
    headers += [] if key is None else [("X-Record-Key", safe(str(key)))]
    return member([*headers, ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response")], block)


def shard_bounds(narrow: DataFrame, shard_bytes: int) -> list:
    """Upper keys of all shards but the last, from a hash-chosen set of about BOUND_KEYS keys."""
    total = narrow.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    shards = math.ceil((total["bytes"] or 0) / shard_bytes)
    if shards < 2:
        return []
    step = max(1, total["n"] // BOUND_KEYS)
    chosen = narrow.filter(F.col("key").isNotNull() & (F.pmod(F.xxhash64("key"), F.lit(step)) == 0))
    keys = sorted(tuple(r) for r in chosen.groupBy("key").agg(F.sum("size")).collect())
    whole, done, bounds = sum(s for _, s in keys), 0, []
    for key, size in keys:
        done += size
        if done * shards >= whole * (len(bounds) + 1) and len(bounds) < shards - 1:
            bounds.append(key)
    return bounds


def write_archive(
    records: DataFrame,
    root: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    revisit_from: int = 1000,
    shard_bytes: int = 128 << 20,
    file_bytes: int = 1 << 30,
    created: str = "2020-01-01T00:00:00Z",
    prefix: str = "pages",
) -> DataFrame:
    """Write the records below ``root``; returns the manifest, one row per file.

    ``shard_bytes`` is the payload one task gets, ``file_bytes`` the compressed size at
    which it rolls to the next file.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = records.select(F.col(key).alias("key"), F.col(uri).cast("string").alias("uri"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    narrow = stored(rows.select("key", "digest", F.octet_length("payload").cast("long").alias("size")), "warc-narrow")
    bounds = shard_bounds(narrow, shard_bytes)

    copies = narrow.filter(F.col("size") >= revisit_from)
    groups = copies.groupBy("digest").agg(F.max("key").alias("keep"), F.count("*").alias("n"))
    groups = stored(groups.filter("n > 1").select("digest", "keep"), "warc-copies")
    kept = copies.select("key", "digest").join(groups, "digest").distinct()

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: 0 if pd.isna(k) else bisect.bisect_left(bounds, k)).astype("int32")

    # The verdict of a key and payload sorts right before their records.
    verdicts = kept.select("key", "digest", F.lit(0).alias("body"), "keep", F.lit(None).cast("string").alias("uri"), F.lit(None).cast("binary").alias("payload"))
    bodies = rows.select("key", "digest", F.lit(1).alias("body"), F.lit(None).cast(kept.schema["keep"].dataType).alias("keep"), "uri", "payload")
    both = verdicts.unionByName(bodies).withColumn("shard", shard("key"))
    both = both.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("key", "digest", "body", "uri")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, verdict, last, sequence = ShardWriter(root, file_bytes), None, None, 0
        for batch in batches:
            columns = {n: batch.column(n) for n in ("key", "digest", "body", "keep", "uri", "payload", "shard")}
            for i in range(batch.num_rows):
                r = {n: c[i].as_py() for n, c in columns.items()}
                same = (r["key"], r["digest"])
                if not r["body"]:
                    verdict = (same, r["keep"])
                    continue
                refers = None
                if verdict and verdict[0] == same and (verdict[1] != r["key"] or last == same):
                    refers = (verdict[1],)
                last = same
                if out.sink is None:
                    name = f"{prefix}-{r['shard']:06d}-{sequence:05d}.warc.gz"
                    out.open(name)
                    info = b"software: docrecords\r\nformat: WARC File Format 1.1\r\n"
                    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name)), ("WARC-Date", created)]
                    out.write(member([*headers, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info), 0)
                out.write(page_record(r["key"], r["uri"], r["payload"], r["digest"], created, refers))
                if out.full:
                    sequence += 1
                    yield manifest_batch([out.close()])
        if out.sink is not None:
            yield manifest_batch([out.close()])

    return publish(both.mapInArrow(write, "file string, temporary string, bytes long, records long, sha1 string"), root)


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    z, parts, left = zlib.decompressobj(31), [], b""
    while block := left or stream.read(1 << 20):
        parts.append(z.decompress(block))
        left = b""
        if z.eof:
            yield b"".join(parts)
            left, z, parts = z.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def parse_record(data: bytes, with_payload: bool) -> dict | None:
    """The row of a response or revisit; digests are computed anew and compared."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    if base32(hashlib.sha1(block).hexdigest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    whole = fields["WARC-Type"] == "response"
    if whole and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} differs")
    length = len(payload) if whole else int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    text = lambda name: unsafe(fields[name]) if name in fields else None
    return {
        "record_key": text("X-Record-Key"), "uri": text("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload_digest": digest,
        "payload_bytes": length, "refers_to": text("X-Refers-To-Key"), "payload": payload if whole and with_payload else None,
    }


def read_archive(manifest: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """The records of all files of the manifest, each file streamed by one task."""
    schema = pa.schema([("record_key", pa.string()), ("uri", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_fs(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in members(stream):
                        if row := parse_record(data, with_payload):
                            rows.append(row)
                            size += len(row["payload"] or b"")
                        if len(rows) >= 5000 or size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    width = max(1, min(manifest.count(), 100_000))
    return manifest.select("file").repartition(width).mapInArrow(read, READ)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back."""
    root = run_dir(spark, "warc")
    manifest = write_archive(table(spark, sf_dir, "pages"), root)
    return read_archive(manifest, root).select(
        F.col("record_key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000
"""
