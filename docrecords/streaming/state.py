"""Streams that remember something for each key: what was emitted, or a record's partner.

State is kept in Spark's RocksDB store, per key or per group of keys, so it is spread over the
cluster like any grouping, and a run goes on from its checkpoint. Both operators are idempotent
on rows that come again: equal rows are never emitted twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from docrecords.operators.intake import VERSION

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times as JSON with all their digits.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Settings for runs that stop: a store is closed when it is committed, and of its versions the last two
#: stay, which a run that is begun again needs. Rows of state are packed closely.
STOPPING = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}
#: For runs that touch most of the state: replaced values go when it is committed.
MERGED = {"spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true"}
#: Groups of keys whose state lies together.
KEY_GROUPS = 32_768


def use_keyed_state(spark: SparkSession) -> None:
    """The state store that keyed state needs; a store chosen by the session stays."""
    if "RocksDB" not in spark.conf.get(PROVIDER):
        spark.conf.set(PROVIDER, ROCKSDB)


# --- rows that an upstream emits again -----------------------------------------------------


class _Changes(StatefulProcessor):
    """Keeps the digest of the last row emitted for a key, and how many there were."""

    def __init__(self, first_only: bool) -> None:
        self.first_only = first_only

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "emission int, digest string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802 - the interface's name
        emission, digest = self.last.get() if self.last.exists() else (0, None)
        before = emission
        for row in sorted(rows, key=lambda r: (r["_order"] is not None, r["_order"] or "", r["_digest"])):
            if emission and (self.first_only or row["_digest"] == digest):
                continue
            emission, digest = emission + 1, row["_digest"]
            yield Row(body=row["_body"], emission=emission)
        if emission != before:
            self.last.update((emission, digest))

    def close(self) -> None:
        pass


def emit_changes(
    stream: DataFrame,
    key: Sequence[str] = tuple(VERSION),
    compared: Sequence[str] | None = None,
    order: str | None = None,
    first_only: bool = False,
) -> DataFrame:
    """Each key's row when it comes first, and again when a compared column has changed.

    For upstreams that are rewritten: deletes and updates there make files whose rows were
    read before. Those are passed over; ``emission`` counts the rows of a key from 1. All
    columns but the key are compared unless named. Of rows of one key in one micro-batch the
    greatest ``order`` comes last. With ``first_only`` changes are passed over, too.
    Rows with equal keys, NULL parts included, are one key.
    """
    use_keyed_state(stream.sparkSession)
    compared = [c for c in stream.columns if c not in key] if compared is None else compared
    digest = F.md5(F.to_json(F.struct(*[F.col(c) for c in compared]), {**JSON, "ignoreNullFields": "false"}).cast("binary"))
    place = F.lit(None).cast("string") if order is None else F.to_json(F.struct(F.col(order).alias("v")), JSON)
    rows = stream.select(*key, digest.alias("_digest"), place.alias("_order"), F.to_json(F.struct(*stream.columns), JSON).alias("_body"))
    done = rows.groupBy(*key).transformWithState(_Changes(first_only), "body string, emission int", "Append", "None")
    return done.select(F.from_json("body", stream.schema, JSON).alias("row"), "emission").select("row.*", "emission")


# --- two streams of records of the same keys ------------------------------------------------


class _Partners(StatefulProcessor):
    """Keeps the last record of both sides of each key, and how many results were emitted.

    Keys of a group lie in one value, as JSON: key -> p, f, revision, due. ``due`` is set while
    a record waits for its partner.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "keys string")

    def _read(self) -> dict[str, list]:
        held = self.held.get()
        return {} if held is None else json.loads(held[0])

    def _keep(self, held: dict[str, list], due: int | None) -> None:
        self.held.update((json.dumps(held, ensure_ascii=False, separators=(",", ":")),))
        if due is not None:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        # Of each key: the greatest row of either side, and the time of the latest row.
        fresh: dict[str, list] = {}
        for row in rows:
            found, side = fresh.setdefault(row["_key"], [None, None, 0]), 0 if row["_side"] == "p" else 1
            rank = (row["_order"] is not None, row["_order"] or "", row["_body"])
            if found[side] is None or found[side] < rank:
                found[side] = rank
            found[2] = max(found[2], row["_millis"])
        held, changed, first_due = self._read(), False, None
        for k, (new_p, new_f, arrived) in fresh.items():
            p, f, revision, due = held.get(k, (None, None, 0, None))
            before = (p, f)
            p, f = (p if new_p is None else new_p[2]), (f if new_f is None else new_f[2])
            if (p, f) == before:
                continue
            if (p is not None and f is not None) or revision:
                revision, due = revision + 1, None
                yield Row(p=p, f=f, revision=revision)
            else:
                # Due as soon as the watermark has reached the time of arrival.
                due = arrived - 1 if due is None else min(due, arrived - 1)
                first_due = due if first_due is None else min(first_due, due)
            held[k], changed = [p, f, revision, due], True
        if changed:
            self._keep(held, first_due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        reached = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        held, changed, later = self._read(), False, None
        for one in held.values():
            p, f, revision, due = one
            if due is None:
                continue
            if due <= reached:
                one[2:], changed = [1, None], True
                yield Row(p=p, f=f, revision=1)
            else:
                later = due if later is None else min(later, due)
        if changed:
            self._keep(held, later)

    def close(self) -> None:
        pass


def pair_streams(
    primary: DataFrame, fallback: DataFrame, key: str, delay: str = "1 hour", order: str | None = None, clock: str | None = None, groups: int = KEY_GROUPS
) -> DataFrame:
    """Full outer join of two streams of records on ``key``, with corrections.

    A pair is emitted once both sides are there. A record without a partner is released alone
    when the watermark, ``delay`` behind the latest arrival, has passed it; should its partner
    come after that, or a new record of either side, the pair is emitted as the next
    ``revision``. The greatest revision of a key is what a batch join of the latest records
    gives (see ``latest_revision``). Time is that of arrival, so no record is ever too late;
    ``clock`` names a column to take instead, and then Spark drops rows behind the watermark.

    The output has ``key``, ``revision``, ``in_left``, ``in_right``, and the columns of the
    sides prefixed ``p_`` and ``f_``, as ``operators.merge.merge_pairs`` takes them. Records
    with a NULL key match nothing and pass at once. Of two records of a key and side that come
    together the greatest ``order`` counts.

    Keys lie together in hash groups, of which each run calls Python once and rewrites the
    state of those it touches; a task holds one group at a time. Neither ``groups`` nor the
    layout of the state may change while a checkpoint is in use.
    """
    use_keyed_state(primary.sparkSession)
    sides = {"p": primary, "f": fallback}
    rows = None
    for name, side in sides.items():
        place = F.lit(None).cast("string") if order is None else F.to_json(F.struct(F.col(order).alias("v")), JSON)
        time = F.current_timestamp() if clock is None else F.col(clock).cast("timestamp")
        body = F.to_json(F.struct(*side.columns), JSON)
        part = side.select(F.col(key).alias("key"), F.lit(name).alias("_side"), place.alias("_order"), body.alias("_body"), time.alias("_time"))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.withWatermark("_time", delay).withColumn("_millis", F.unix_millis("_time"))
    text = F.col("key") if isinstance(rows.schema["key"].dataType, T.StringType) else F.to_json(F.struct("key"), JSON)
    group = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
    keyed = rows.filter("key IS NOT NULL").select(group.alias("_group"), text.alias("_key"), "_side", "_order", "_body", "_millis", "_time")
    paired = keyed.groupBy("_group").transformWithState(_Partners(), "p string, f string, revision int", "Append", "EventTime")
    body = lambda name: F.when(F.col("_side") == name, F.col("_body")).alias(name)
    alone = rows.filter("key IS NULL").select(body("p"), body("f"), F.lit(1).alias("revision"))
    read = {name: F.from_json(name, T.StructType(side.schema.fields), JSON) for name, side in sides.items()}
    both = paired.select("p", "f", "revision").unionByName(alone).select("revision", *[c.alias(n) for n, c in read.items()])
    return both.select(
        F.coalesce(F.col(f"p.{key}"), F.col(f"f.{key}")).alias("key"),
        "revision",
        F.col("p").isNotNull().alias("in_left"),
        F.col("f").isNotNull().alias("in_right"),
        *[F.col(f"{n}.{c}").alias(f"{n}_{c}") for n, side in sides.items() for c in side.columns],
    )


def latest_revision(pairs: DataFrame, key: str = "key") -> DataFrame:
    """The last result of each key, and all results with a NULL key."""
    last = pairs.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max("revision").alias("_revision"))
    known = pairs.join(last, (F.col(key) == F.col("_key")) & (F.col("revision") == F.col("_revision")), "left_semi")
    return known.unionByName(pairs.filter(F.col(key).isNull()))
