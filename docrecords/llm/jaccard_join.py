"""N-gram Jaccard join: classes of documents connected by nearly equal shingle sets.

The Jaccard distance is a metric, so a join within a distance (0.1 for op8) can be cut into
regions around pivots. Document pivots alone do not cut a corpus: most documents share nothing with
any pivot, all those distances are 1, and every window would hold everything. So:

1. Equal sets are one node from here on (64-bit hash of the set).
2. Level 0 takes coordinate pivots: shingles are dealt by hash into k classes, and the
   distance of two sets restricted to a class is 0 if they agree there. Sets that link differ
   in at most ``changes`` shingles, so, of more classes than that, one is untouched: linked sets
   share a region (band of sizes, class, hash of the part in it). Boundary windows put sets
   near the upper end of a size band into the next band, too. Regions are read in order of
   their key, range-partitioned by (key, set), which splits hot ones; each set is joined to
   the first of its region, and connected components of these are blocks.
3. Every block is joined exactly in one task: pivots make Voronoi regions, a set also goes
   to each region whose pivot is at most two join distances farther than its own, and regions
   are joined recursively until they are small. Pairs that are already connected are skipped,
   as are pairs that the triangle inequality, |d(x, p) - d(y, p)| > distance, rules out.
4. Blocks beyond ``BLOCK_BYTES`` are cut by the same Voronoi step as a Spark job, again and
   again; where this does not shrink them, they are cut into tiles, each pair of tiles a task.

Where the first cut takes rare shingles (``by_rarest``), sets that hold more shingles of their own
than linked sets can go before it: all sets' shingles are shuffled by hash for that, in packed form,
5 bytes or so each, and the counts of those found once go back to their sets.

NULL and empty texts, and those without words, have no shingles and are linked with nothing.
Rows with equal ids or texts are decided alike. A NULL id never names a component unless all
its documents lack one. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import forget, fresh, shuffle_width, stored, table
from docrecords.llm.components import components

#: Linked: 100 * intersection >= percent * union. Shingles have so many words. These are op8's.
PERCENT, WORDS = 90, 3
#: Size bands grow by this factor from the least size at which unequal sets can link.
BAND_GROWTH = 1.5
#: Set bytes and sets that one task joins; pivots of a step; sets that are joined directly.
BLOCK_BYTES, BLOCK_SETS, PIVOTS, LEAF = 64 << 20, 20_000, 16, 48
#: Sets whose signatures a task gives once only, however often they occur in it.
SEEN_SETS = 500_000
#: Counters of shingles, a byte each: what is broadcast, whatever the corpus.
COUNTERS = 1 << 22
#: Shingles that a task looks for in other sets at a time, and sets that it numbers for that.
CHUNK_SHINGLES, CHUNK_SETS = 1 << 20, 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, width: int = WORDS) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a text."""
    words = text.encode().lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    n = min(width, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total + h[i : len(h) - n + 1 + i])
    return np.unique(total)


def set_key(found: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int(mixed(mixed(found ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(found)))[0].astype(np.int64))


def changes(size: int, percent: int = PERCENT) -> int:
    """At most so many shingles are in just one of two linked sets, the smaller of this size."""
    return size * (100 - percent) // percent


def first_band(percent: int = PERCENT) -> int:
    """The least size at which unequal sets can link."""
    return -(-percent // (100 - percent))


def used_classes(size: int, percent: int = PERCENT) -> int:
    """Classes of which a set of this size gives signatures: some may be empty."""
    return changes(size, percent) + 3 + changes(size, percent) // 16


def bands(size: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(band, number of its classes) of a set: its own, and the next one if it may link there."""
    low, number, growth = first_band(percent), 0, max(BAND_GROWTH, 100 / percent)
    while True:
        high = int(low * growth) + 1
        if size < high:
            break
        low, number = high, number + 1
    found = [(number, used_classes(high - 1, percent))]
    if 100 * size >= percent * high:
        found.append((number + 1, used_classes(int(high * growth), percent)))
    return found


def signatures(found: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Region keys of a set, and whether the region counts even if this set alone asks for it.

    Empty classes agree with each other, but say little: their regions matter only if a set
    has too few classes with shingles, which is so rare that the flag is for exactness.
    """
    keys, asks = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    size = len(found)
    for band, classes in bands(size, percent) if size >= first_band(percent) else []:
        used = min(used_classes(size, percent), classes)
        place = (found % np.uint64(classes)).astype(np.int64)
        near = place < used
        sums, counts = np.zeros(used, np.uint64), np.bincount(place[near], minlength=used)
        np.add.at(sums, place[near], mixed(found[near] + np.uint64(band)))
        number = np.arange(used, dtype=np.uint64) + np.uint64(band << 32)
        keys.append(mixed(sums + mixed(number)))
        asks.append((counts > 0) | (int((counts > 0).sum()) <= changes(size, percent)))
    return np.concatenate(keys), np.concatenate(asks)


def alone(size: int, percent: int = PERCENT) -> int:
    """A set that holds so many shingles that no other set holds is linked with none."""
    return size + 1 + -percent * size // 100


def chunks(docs: DataFrame, text: str, words: int, percent: int, buckets: int) -> DataFrame:
    """The shingles of a part of all hash values, in rows by bucket, and a head for each chunk of sets.

    A row holds the sets' numbers in the chunk (differences) and 32 bits of each shingle; a head
    (``n`` in place of these) the sets' keys and how many shingles without a match rule them out.
    Three times what ``alone`` asks for is looked at, which decides sets of which half is shared, too,
    and is less to shuffle than all.
    """
    share = np.uint64(min(100, 3 * (100 - percent)))
    names = ["bucket", "chunk", "head", "sets", "n"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, needed, held, total = [], [], [], 0

        def rows() -> pa.RecordBatch:
            own = np.array(keys, np.int64)
            number, found = np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate(held)
            bucket = ((found >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, number, found = bucket[order], number[order].astype(np.uint16), found[order].astype(np.uint32)
            start = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = [*start[1:].tolist(), len(bucket)]
            sets = [zlib.compress(np.diff(number[i:j], prepend=np.uint16(0)).tobytes(), 1) for i, j in zip(start.tolist(), ends, strict=False)]
            values = [found[i:j].tobytes() for i, j in zip(start.tolist(), ends, strict=False)]
            chunk = xxhash.xxh3_64_intdigest(own.tobytes())
            columns = [
                pa.array([chunk % buckets, *bucket[start].tolist()], pa.int32()),
                pa.array(np.full(len(start) + 1, chunk, np.uint64).astype(np.int64)),
                pa.array([True, *[False] * len(start)]),
                pa.array([own.tobytes(), *sets], pa.binary()),
                pa.array([np.array(needed, np.int64).tobytes(), *values], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for value in batch.column(0):
                found = shingles(value.as_py(), words)
                key = set_key(found)
                if len(found) < first_band(percent) or key in seen:
                    continue
                if len(seen) < SEEN_SETS:
                    seen.add(key)
                keys.append(key)
                needed.append(alone(len(found), percent))
                held.append(found[found % np.uint64(100) < share])
                total += len(held[-1])
                if total >= CHUNK_SHINGLES or len(held) == CHUNK_SETS:
                    yield rows()
                    keys, needed, held, total = [], [], [], 0
        if keys:
            yield rows()

    body = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body"))
    return body.mapInArrow(compute, "bucket int, chunk long, head boolean, sets binary, n binary")


def unmatched(rows: DataFrame) -> DataFrame:
    """From all rows of a bucket: for each chunk, how many shingles of which sets are there once only; and the heads."""
    names = ["chunk", "head", "sets", "n"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, numbers, values = None, [], [], []

        def counted() -> pa.RecordBatch:
            found, width = np.concatenate(values), [len(v) for v in values]
            order = np.argsort(found)
            new = np.concatenate([[True], found[order[1:]] != found[order[:-1]], [True]])
            once = np.sort(order[new[1:] & new[:-1]])
            place = np.repeat(np.arange(len(own)) * CHUNK_SETS, width)[once] + np.concatenate(numbers)[once]
            place, n = np.unique(place, return_counts=True)
            cuts = np.searchsorted(place, np.arange(len(own) + 1) * CHUNK_SETS)
            parts = [(c, place[i:j] % CHUNK_SETS, n[i:j]) for c, i, j in zip(own, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if i < j]
            sets = [zlib.compress(x.astype(np.uint16).tobytes(), 1) for _, x, _ in parts]
            counts = [zlib.compress(x.astype(np.uint32).tobytes(), 1) for _, _, x in parts]
            return pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in parts], pa.int64()), pa.array([False] * len(parts), pa.bool_()), pa.array(sets, pa.binary()), pa.array(counts, pa.binary())], names=names)

        for batch in batches:
            heads = batch.filter(batch.column(2))
            if heads.num_rows:
                yield pa.RecordBatch.from_arrays(heads.columns[1:], names=names)
            for bucket, chunk, head, sets, n in zip(*(batch.column(i) for i in range(5)), strict=True):
                if head.as_py():
                    continue
                if bucket.as_py() != last:
                    if own:
                        yield counted()
                    last, own, numbers, values = bucket.as_py(), [], [], []
                own.append(chunk.as_py())
                numbers.append(np.frombuffer(zlib.decompress(sets.as_buffer()), np.uint16).cumsum(dtype=np.uint16))
                values.append(np.frombuffer(n.as_py(), np.uint32))
        if own:
            yield counted()

    return rows.mapInArrow(compute, "chunk long, head boolean, sets binary, n binary")


def may_link(docs: DataFrame, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``key`` of the sets that may link with another, some of them repeated.

    Most texts of a corpus hold passages that are nowhere else. A set that links must share
    ``percent`` of its shingles, so those with more shingles that are found once are left out.
    Shingles that meet by their hash count as shared: that leaves sets in, never out.
    """
    width = shuffle_width(docs.sparkSession)
    # A few buckets a task, read one after the other.
    rows = chunks(docs, text, words, percent, 4 * width).repartition(width, "bucket").sortWithinPartitions("bucket")
    found = unmatched(rows).repartition(width, "chunk").sortWithinPartitions("chunk", F.desc("head"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys, needed, total = None, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for chunk, head, sets, n in zip(*(batch.column(i) for i in range(4)), strict=True):
                if chunk.as_py() != last:
                    yield pa.RecordBatch.from_arrays([pa.array(keys[total < needed])], names=["key"])
                    last, keys, needed, total = chunk.as_py(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if head.as_py():  # equal ones, if a chunk occurs again
                    keys, needed = np.frombuffer(sets.as_py(), np.int64), np.frombuffer(n.as_py(), np.int64)
                    total = np.zeros(len(keys), np.int64)
                elif len(keys):
                    total[np.frombuffer(zlib.decompress(sets.as_buffer()), np.uint16)] += np.frombuffer(zlib.decompress(n.as_buffer()), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(keys[total < needed])], names=["key"])

    return found.mapInArrow(compute, "key long")


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many of the sets in ``data`` hold the shingles of each of ``COUNTERS`` hash buckets; of fixed size.

    Exact up to 64, then in steps of an eighth of a doubling.
    """
    step = COUNTERS // 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's counts stay far below the limit of 32 bits, and compress better.
        total = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            for data in batch.column(0):
                # Shingles of a set may meet in a bucket.
                np.add.at(total, (np.frombuffer(data.as_py(), np.uint64) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        parts = [zlib.compress(total[i : i + step].astype(">i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1) for i in range(0, COUNTERS, step)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], names=["part", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                planes = np.frombuffer(zlib.decompress(n.as_buffer()), np.uint8).reshape(4, -1)
                sums[part] = sums.get(part, 0) + np.ascontiguousarray(planes.T).view(">i4").ravel().astype(np.int64)
        if sums:
            scaled = [np.minimum(np.where(v < 64, v, 64 + 8 * np.log2(np.maximum(v, 64) / 64)), 255).astype(np.uint8) for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in scaled], pa.binary())], names=["part", "n"])

    parts = sets.select("data").mapInArrow(count, "part long, n binary").repartition(shuffle_width(sets.sparkSession), "part")
    total = np.zeros(COUNTERS, np.uint8)
    for r in parts.mapInArrow(add, "part long, n binary").collect():
        total[r["part"] * step : (r["part"] + 1) * step] = np.frombuffer(r["n"], np.uint8)
    return total


def rarest(found: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set that come first in the order of counts, of which linked sets share one.

    Linked sets share at least ``percent`` of the shingles of either, so in any order of all
    shingles the first n - needed + 1 of the one and of the other have one in common. Those in
    buckets that only this set is in are shared with none.
    """
    n = len(found)
    if n < first_band(percent):
        return found[:0]
    often = counts[(found & np.uint64(COUNTERS - 1)).astype(np.int64)]
    first = np.lexsort((found, often))[: alone(n, percent)]
    return found[first[often[first] > 1]]


def hashed_sets(docs: DataFrame, text: str, words: int = WORDS, percent: int = PERCENT, signed: bool = True) -> DataFrame:
    """``doc_id``, ``row``, ``size``, ``key`` and, if ``signed``, the signatures of each document's set."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, keys, regions, asked = [], [], [], []
            for value in batch.column(2):
                found = shingles(value.as_py(), words)
                key = set_key(found)
                sizes.append(len(found))
                keys.append(key)
                if signed:
                    sig, asks = signatures(found if key not in seen else found[:0], percent)
                    regions.append(sig.astype(np.int64))
                    asked.append(asks)
                    if len(seen) < SEEN_SETS:
                        seen.add(key)
            columns, names = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], ["doc_id", "row", "size", "key"]
            if signed:
                columns += [pa.array(regions, pa.list_(pa.int64())), pa.array(asked, pa.list_(pa.bool_()))]
                names += ["regions", "asked"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select("doc_id", row_key(docs, text).alias("row"), body.alias("_body"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {kind}, row long, size long, key long" + ", regions array<bigint>, asked array<boolean>" * signed)


def rare_regions(sets: DataFrame, counts: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``key`` and, as signatures, the rarest shingles of each set in ``data``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions = []
            for data in batch.column(1):
                found = np.frombuffer(data.as_py(), np.uint64)
                rare = rarest(found, counts, percent)
                # Linked sets are in one size band.
                own = [mixed(rare + mixed(np.array([band], np.uint64))) for band, _ in bands(len(found), percent)] if len(rare) else []
                regions.append(np.concatenate([np.zeros(0, np.uint64), *own]).astype(np.int64))
            asked = [np.ones(len(x), bool) for x in regions]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(regions, pa.list_(pa.int64())), pa.array(asked, pa.list_(pa.bool_()))], names=["key", "regions", "asked"])

    return sets.select("key", "data").mapInArrow(compute, "key long, regions array<bigint>, asked array<boolean>")


def set_data(docs: DataFrame, text: str, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """The wanted rows, by ``row`` of their document, with their shingles as ``data``."""
    names = [c for c in wanted.columns if c != "row"]
    at = names.index("key")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            # The join leaves equal rows next to each other; one of them is enough.
            keys = batch.column(at).to_pylist()
            fresh = [i for i, k in enumerate(keys) if k != (keys[i - 1] if i else last)]
            last = keys[-1] if keys else last
            some = batch.take(pa.array(fresh, pa.int64()))
            sets = [shingles(v.as_py(), words).tobytes() for v in some.column(len(names))]
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(sets, pa.binary())], names=[*names, "data"])

    texts = docs.select(row_key(docs, text).alias("row"), F.col(text).cast("string").alias("_body"))
    return texts.join(wanted.hint("merge"), "row").select(*names, "_body").mapInArrow(compute, ", ".join(f"{c} long" for c in names) + ", data binary")


def row_key(docs: DataFrame, text: str):
    return F.xxhash64(F.col("doc_id"), F.col(text))


def region_edges(sets: DataFrame, held: list[DataFrame]) -> DataFrame:
    """Each set with the first of each of its regions; ends of partitions meet by their region.

    What is stored for it is added to ``held``, here and below: for ``forget``.
    """
    rows = sets.select("key", F.explode(F.arrays_zip("regions", "asked")).alias("s")).select(F.col("s.regions").alias("region"), "key", F.col("s.asked").alias("asks"))
    rows = rows.repartitionByRange(shuffle_width(sets.sparkSession), "region", "key").sortWithinPartitions("region", "key")
    names = ["region", "head", "key", "asks", "end"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each set but the first of a region; flagged ones for the first and last region."""
        head, first, asks_head, last = None, None, False, None
        for batch in batches:
            region, key, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(region):
                continue
            new = np.concatenate([[head is None or region[0] != head[0]], region[1:] != region[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(region)), -1))
            heads = np.where(start >= 0, key[start], head[1] if head else 0)
            head_asks = np.where(start >= 0, asks[start], asks_head)
            out = ~new & (heads != key)
            yield pa.RecordBatch.from_arrays([pa.array(region[out]), pa.array(heads[out]), pa.array(key[out]), pa.array((asks | head_asks)[out]), pa.array(np.zeros(out.sum(), bool))], names=names)
            if first is None:
                first = (int(region[0]), int(key[0]), bool(asks[0]))
            head, asks_head = (int(region[-1]), int(heads[-1])), bool(head_asks[-1])
            last = (*head, bool(asks_head))
        if first is not None:
            ends = [first, last]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends]), pa.array([e[1] for e in ends]), pa.array([e[1] for e in ends]), pa.array([e[2] for e in ends]), pa.array([True, True])], names=names)

    found = stored(rows.mapInArrow(runs, "region long, head long, key long, asks boolean, end boolean"), "jaccard-regions")
    held.append(found)
    ends = found.filter("end").groupBy("region").agg(F.min("head").alias("_least"), F.max("asks").alias("_asks"))
    across = found.filter("end").join(ends, "region").filter("head <> _least").select("region", F.col("_least").alias("head"), "key", F.col("_asks").alias("asks"))
    edges = found.filter("NOT end").select("region", "head", "key", "asks").unionByName(across)
    # Regions that only empty classes share count if one of their sets asks for them.
    wanted = edges.filter("NOT asks").select("region").distinct().join(edges.filter("asks").select("region").distinct(), "region", "left_semi")
    kept = edges.filter("asks").unionByName(edges.filter("NOT asks").join(wanted, "region", "left_semi"))
    return kept.select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()


class Block:
    """The exact join of the sets of one block."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.percent, self.distance = percent, 1 - percent / 100
        self.size = np.array([len(s) for s in sets], np.int64)
        _, self.cols = np.unique(np.concatenate(sets), return_inverse=True)
        self.start = np.concatenate([[0], self.size.cumsum()])
        self.mark = np.zeros(int(self.cols.max()) + 1, bool)
        self.root = np.arange(len(sets))

    def columns(self, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of these sets one after the other, and where each begins."""
        size = self.size[idx]
        begin = np.concatenate([[0], size.cumsum()[:-1]])
        return self.cols[np.repeat(self.start[idx] - begin, size) + np.arange(size.sum())], begin

    def common(self, p: int, idx: np.ndarray, held: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Sizes of the intersections of set p with others."""
        own = self.cols[self.start[p] : self.start[p + 1]]
        self.mark[own] = True
        cols, begin = held or self.columns(idx)
        found = np.add.reduceat(self.mark[cols], begin, dtype=np.int64)
        self.mark[own] = False
        return found

    def link(self, p: int, idx: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Connect p with those within the join distance; the distances to all."""
        union = self.size[p] + self.size[idx] - common
        linked = idx[100 * common >= self.percent * union]
        for r in np.unique(self.root[linked]):
            if r != self.root[p]:
                self.root[self.root == r] = self.root[p]
        return 1 - common / union

    def join(self, idx: np.ndarray) -> None:
        """Find all links among these sets that connect parts not yet connected."""
        if len(idx) < 2 or (self.root[idx] == self.root[idx[0]]).all():
            return
        if len(idx) <= LEAF:
            return self.direct(idx, None)
        pivots = idx[np.linspace(0, len(idx) - 1, PIVOTS).astype(np.int64)]
        held = self.columns(idx)
        far = np.stack([self.link(p, idx, self.common(p, idx, held)) for p in pivots])
        window = far <= far.min(0) + 2 * self.distance + 1e-9
        home = far.argmin(0)
        for j in range(PIVOTS):
            if not (home == j).any():
                continue
            if window[j].sum() > 0.7 * len(idx):
                return self.direct(idx, far)
            self.join(idx[window[j]])

    def direct(self, idx: np.ndarray, far: np.ndarray | None) -> None:
        """Compare each set outside the largest part with all sets of other parts.

        ``far``: distances to pivots, which rule out pairs by the triangle inequality.
        """
        names, counts = np.unique(self.root[idx], return_counts=True)
        largest = names[counts.argmax()]
        for i in np.flatnonzero(self.root[idx] != largest):
            p = int(idx[i])
            other = self.root[idx] != self.root[p]
            small, large = np.minimum(self.size[idx], self.size[p]), np.maximum(self.size[idx], self.size[p])
            other &= 100 * small >= self.percent * large
            if far is not None:
                other &= (np.abs(far - far[:, i : i + 1]) <= self.distance + 1e-9).all(0)
            if other.any():
                self.link(p, idx[other], self.common(p, idx[other]))


def join_blocks(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """From ``block``, ``key``, ``data``: ``a``, ``b``, each set with one of its part of the block."""
    ordered = rows.repartition(shuffle_width(rows.sparkSession), "block").sortWithinPartitions("block", "key")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, sets = None, [], []

        def links() -> pa.RecordBatch:
            join = Block(sets, percent)
            join.join(np.arange(len(sets)))
            return pa.RecordBatch.from_arrays([pa.array([keys[r] for r in join.root], pa.int64()), pa.array(keys, pa.int64())], names=["a", "b"])

        for batch in batches:
            for b, key, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                b, key = b.as_py(), key.as_py()
                if b != block and len(sets) > 1:
                    yield links()
                if b != block:
                    block, keys, sets = b, [], []
                if not keys or keys[-1] != key:
                    keys.append(key)
                    sets.append(np.frombuffer(data.as_py(), np.uint64))
        if len(sets) > 1:
            yield links()

    return ordered.select("block", "key", "data").mapInArrow(compute, "a long, b long")


def sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("block").agg(F.count("*").alias("sets"), F.sum(F.octet_length("data")).alias("bytes"))


def voronoi(rows: DataFrame, weight: DataFrame, piece: int, percent: int, held: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """One Voronoi step for large blocks: (links to pivots, rows of the regions with windows).

    A block's pivots are joined to pieces of it of about ``piece`` bytes.
    """
    pieces = F.greatest(F.lit(1), F.ceil(F.col("bytes") / piece)).cast("int")
    chosen = rows.groupBy("block", F.pmod("key", F.lit(PIVOTS)).alias("n")).agg(F.min("key").alias("key"))
    pivots = rows.join(chosen.select("block", "key"), ["block", "key"]).join(weight, "block")
    pivots = stored(pivots.select("block", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), "key", "data"), "jaccard-pivots")
    spread = rows.join(weight, "block").withColumn("piece", F.pmod(F.xxhash64("key"), pieces).cast("int")).select("block", "piece", "key", "data")

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, sets = left.column("key").to_pylist(), [np.frombuffer(d.as_buffer(), np.uint64) for d in left.column("data")]
        pivot = dict(zip(right.column("key").to_pylist(), right.column("data").to_pylist(), strict=True))
        order = sorted(pivot)
        join = Block([*sets, *(np.frombuffer(pivot[k], np.uint64) for k in order)], percent)
        idx, far, linked = np.arange(len(sets)), [], []
        for p in range(len(order) if sets else 0):  # a piece may have pivots alone
            common = join.common(len(sets) + p, idx)
            union = join.size[len(sets) + p] + join.size[idx] - common
            far.append(1 - common / union)
            linked.append(100 * common >= percent * union)
        far = np.array(far).reshape(len(order), len(sets))
        inside = far <= far.min(0, initial=1) + 2 * join.distance + 1e-9
        near = [[order[p] for p in np.flatnonzero(column)] for column in np.array(linked, bool).reshape(len(order), len(sets)).T]
        regions = [[order[p] for p in np.flatnonzero(column)] for column in inside.T]
        names = ["block", "key", "data", "near", "regions"]
        return pa.table([left.column("block"), pa.array(keys, pa.int64()), left.column("data"), pa.array(near, pa.list_(pa.int64())), pa.array(regions, pa.list_(pa.int64()))], names=names)

    measured = spread.groupBy("block", "piece").cogroup(pivots.groupBy("block", "piece")).applyInArrow(measure, "block long, key long, data binary, near array<bigint>, regions array<bigint>")
    measured = stored(measured, "jaccard-voronoi")
    held += [pivots, measured]
    links = measured.select(F.explode("near").alias("a"), F.col("key").alias("b"))
    regions = measured.select(F.col("block").alias("parent"), F.explode("regions").alias("region"), "key", "data")
    return links, regions.select(F.xxhash64("parent", "region").alias("block"), "parent", "key", "data")


def tiles(rows: DataFrame, weight: DataFrame, piece: int) -> DataFrame:
    """Rows of blocks cut into tiles, once for each pair of tiles."""
    count = F.greatest(F.lit(1), F.ceil(2 * F.col("bytes") / piece)).cast("int")
    own = rows.join(weight, "block").withColumns({"n": count, "own": F.pmod(F.xxhash64("key"), count).cast("int")})
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return pairs.select(F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other")).alias("block"), "key", "data")


def join_sets(rows: DataFrame, block_bytes: int, block_sets: int, percent: int, held: list[DataFrame]) -> DataFrame:
    """``node``, ``root`` of all linked sets of all blocks, whatever their size."""
    rows = stored(rows, "jaccard-sets")
    weight = stored(sizes(rows), "jaccard-weights")
    held += [rows, weight]
    large = (F.col("bytes") > block_bytes) | (F.col("sets") > block_sets)
    if weight.filter(large).isEmpty():
        return join_blocks(rows, percent).select(F.col("b").alias("node"), F.col("a").alias("root"))
    links = []
    for _ in range(8):
        links.append(join_blocks(rows.join(weight.filter(~large), "block", "left_semi"), percent))
        rows = rows.join(weight.filter(large), "block", "left_semi")
        pivot_links, regions = voronoi(rows, weight, block_bytes // 4, percent, held)
        links.append(pivot_links)
        parts = sizes(regions).join(regions.select("block", "parent").distinct(), "block")
        parts = stored(parts.join(weight.select(F.col("block").alias("parent"), F.col("bytes").alias("whole")), "parent"), "jaccard-parts")
        # A block of which some region keeps most is cut into tiles instead; the rest goes on as regions.
        stuck = parts.filter("bytes > 0.7 * whole").select(F.col("parent").alias("block")).distinct()
        cut = rows.join(stuck, "block", "left_semi")
        links.append(join_blocks(tiles(cut, weight, min(block_bytes, block_bytes * block_sets // 40_000)), percent))
        rows = stored(regions.join(stuck.select(F.col("block").alias("parent")), "parent", "left_anti").select("block", "key", "data"), "jaccard-sets")
        weight = stored(sizes(rows), "jaccard-weights")
        held += [parts, rows, weight]
        if weight.isEmpty():
            break
    else:
        links.append(join_blocks(tiles(rows, weight, block_bytes), percent))
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    return components(every.select("a", "b"))


def jaccard_classes(
    docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, block_sets: int = BLOCK_SETS, words: int = WORDS, percent: int = PERCENT, by_rarest: bool = False
) -> DataFrame:
    """``doc_id``, ``row``, ``n_shingles``, ``class`` and ``component_id`` of every document.

    ``row`` is a hash of id and text, ``class`` one for all documents of a component. With
    ``by_rarest`` the first cut takes regions of rare shingles in place of hash classes, which
    at low percentages are small, and often of nothing but a passage that many texts share;
    sets that hold too many shingles of their own to link take no further part.
    """
    held: list[DataFrame] = []
    hashed = stored(hashed_sets(docs.select("doc_id", text), text, words, percent, not by_rarest), "jaccard-hashed")
    one = hashed.filter("size > 0").groupBy("key").agg(F.min("row").alias("row"))
    if by_rarest:
        likely = stored(may_link(docs, text, words, percent).distinct(), "jaccard-likely")
        wanted = stored(one.join(likely, "key").select("row", "key"), "jaccard-wanted")
        sets = stored(set_data(docs, text, wanted, words), "jaccard-data")
        edges = region_edges(rare_regions(sets, shingle_counts(sets), percent), held)
        blocks = stored(components(edges), "jaccard-blocks")
        rows = sets.join(blocks, sets["key"] == blocks["node"]).select(F.col("root").alias("block"), "key", "data")
        held += [likely, sets]
    else:
        blocks = stored(components(region_edges(hashed, held)), "jaccard-blocks")
        wanted = stored(blocks.join(one, blocks["node"] == one["key"]).select("row", "key", F.col("root").alias("block")), "jaccard-wanted")
        rows = set_data(docs, text, wanted.select("row", "block", "key"), words)
    linked = stored(join_sets(rows, block_bytes, block_sets, percent, held), "jaccard-linked")
    named = hashed.select("doc_id", "row", "size", "key").join(linked, F.col("key") == F.col("node"), "left")
    named = stored(named.select("doc_id", "row", F.col("size").alias("n_shingles"), F.coalesce("root", "key").alias("class")), "jaccard-named")
    forget(*held, hashed, blocks, wanted, linked)
    least = stored(named.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("component_id")), "jaccard-least")
    empty = named.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return named.filter("n_shingles > 0").join(least, "class").select("doc_id", "row", "n_shingles", "class", "component_id").unionByName(
        empty.select("doc_id", "row", "n_shingles", "class", "component_id")
    )


def drop_near_copies(docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT, by_rarest: bool = False) -> DataFrame:
    """One document of each component, the one with the least id, and all without words.

    Of equal rows one stays.
    """
    classes = stored(jaccard_classes(docs, text, words=words, percent=percent, by_rarest=by_rarest), "jaccard-classes")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    row = fresh(docs, "_row")
    kept = classes.filter("n_shingles > 0").groupBy("class").agg(F.min(order).alias("m")).select(F.col("m.row").alias(row))
    rows = docs.withColumn(row, row_key(docs, text))
    repeated = classes.filter("n_shingles > 0").groupBy("row").count().filter("count > 1").select(F.col("row").alias(row))
    repeated = stored(repeated.join(kept, row, "left_semi"), "jaccard-repeated")
    wordless = classes.filter("n_shingles = 0").select(F.col("row").alias(row)).distinct()
    once = stored(kept.join(repeated, row, "left_anti").unionByName(wordless), "jaccard-kept")
    forget(classes)
    result = rows.join(once.hint("merge"), row, "left_semi")
    if not repeated.isEmpty():
        result = result.unionByName(rows.join(repeated, row, "left_semi").dropDuplicates([row]))
    return result.select(*docs.columns)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document."""
    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
