"""Prefix trie of conversations from padded matrices of turn ids.

Conversations with equal first turns share a path of the trie. Each turn is known by a
128-bit id, and each conversation by its list of ids. Conversations are sharded by ranges
of (first ids, conv_id), so that nearly every node lies in one shard, and copies of one
conversation may lie in several. Within a shard the ids become small integers in a padded
matrix, a band of columns at a time; rows are sorted with lexsort, the changes between
neighbouring rows are OR-accumulated from column to column, each change at a depth starts a
node, and reduceat aggregates all nodes of that depth at once.

A node may continue in another shard only if it holds the first or last row of its shard
(or lies below ``KEY_TURNS`` turns under such a node). Only these boundary nodes are
recombined across shards, by the digest of their path; sums over their subtrees take one
round for each doubling of the distance to the ancestors they reach.

A shard holds about ``SHARD_TURNS`` turns, and a band ``BAND`` columns of them. The list of
ids of one conversation (16 bytes a turn) is one row. The digest over the conversations that
end in a node is a chain, so each is computed by one task, from pieces of the shards.

Rows with a NULL conv_id belong to no conversation and are left out. Equal turns of one
conversation are ordered by their ids, repeated rows are turns each. Other columns are not
read. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrecords.llm.common import WORD, shuffle_width, stored, table
from docrecords.llm.repair import CRC32_SQL

SHARD_TURNS, BAND, KEY_TURNS, PIECE_IDS = 400_000, 64, 16, 50_000


def turn_id(role: str = "role", text: str = "text") -> Column:
    """128 bits that identify a turn's role and text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    return F.unhex(F.md5(F.concat(F.length(parts[0]).cast("string"), F.lit(":"), *parts).cast("binary")))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` (id, words) in order. Texts are not moved."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", F.col("turn"), turn_id().alias("id"), words.cast("long").alias("words"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "id", "words")))
    return rows.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


NODE_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("words", pa.int64()),
        ("ends_sha256", pa.string()),
        ("piece", pa.string()),
    ]
)
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, key binary, parent_key binary, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string, piece string"
)


class Shard:
    """The trie of one shard: arrays with one entry per node, parents before children."""

    def __init__(self, conv: np.ndarray, ids: list[list[bytes]], words: np.ndarray) -> None:
        self.conv, self.ids = conv, ids
        self.length = np.fromiter(map(len, ids), np.int64, len(ids))
        self.offset = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        flat = np.empty(int(self.length.sum()), object)
        flat[:] = [x for row in ids for x in row]
        self.codes = pd.factorize(flat)[0] if len(flat) else np.zeros(0, np.int64)
        self.flat_words = words
        lowest = min(range(len(ids)), key=self._rank)
        highest = max(range(len(ids)), key=self._rank)
        self.bounds = np.array([lowest, highest])
        self.ends: dict[int, np.ndarray] = {}
        everyone = np.arange(len(ids))
        columns = {"depth": [0], "parent": [-1], "n": [len(ids)], "least": [conv.min()], "words": [0], "row": [lowest], "open": [True]}
        self.parts = {k: [np.array(v)] for k, v in columns.items()}
        self.count = 1
        done = np.flatnonzero(self.length == 0)
        if len(done):
            self.ends[0] = np.sort(conv[done])
        self._bands(everyone)
        for name, parts in self.parts.items():
            setattr(self, name, np.concatenate(parts))
        self._roll_up()

    def _rank(self, i: int) -> tuple:
        return self.ids[i][:KEY_TURNS], self.conv[i]

    def _bands(self, rows: np.ndarray) -> None:
        rows = rows[self.length[rows] > 0]
        low, group, is_open = 0, np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
        while len(rows):
            width = int(min(BAND, self.length[rows].max() - low))
            matrix = np.full((len(rows), width), -1, np.int64)
            for j in range(width):
                has = self.length[rows] > low + j
                matrix[has, j] = self.codes[self.offset[rows[has]] + low + j]
            order = np.lexsort((self.conv[rows], *matrix.T[::-1], group))
            rows, group, is_open, matrix = rows[order], group[order], is_open[order], matrix[order]
            changed = np.zeros((len(rows), width + 1), bool)
            changed[0] = True
            changed[1:, 0] = group[1:] != group[:-1]
            changed[1:, 1:] = matrix[1:] != matrix[:-1]
            starts_at = np.logical_or.accumulate(changed, axis=1)
            at = np.isin(rows, self.bounds).nonzero()[0]
            for j in range(width):
                starts = np.flatnonzero(starts_at[:, j + 1])
                group, is_open = self._level(low + j + 1, rows, group, is_open, matrix[:, j], starts, at)
            low += width
            keep = self.length[rows] > low
            rows, group, is_open = rows[keep], group[keep], is_open[keep]

    def _level(self, depth, rows, parent, under_open, column, starts, at) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of one depth; returns each row's node, or its last one where it has ended, and if that is open."""
        real = column[starts] >= 0
        least = np.minimum.reduceat(self.conv[rows], starts)[real]
        sizes = np.diff(np.append(starts, len(rows)))
        number = np.full(len(starts), -1, np.int64)
        number[real] = self.count + np.arange(int(real.sum()))
        node = np.repeat(number, sizes)
        first = starts[real]
        above = parent[first]
        if depth > KEY_TURNS:
            opened = under_open[first]
        else:
            opened = np.zeros(len(first), bool)
            held = node[at]
            opened[held[held >= 0] - self.count] = True
        new = {"depth": np.full(len(first), depth), "parent": above, "n": sizes[real], "least": least, "row": rows[first], "open": opened}
        new["words"] = self.flat_words[self.offset[rows[first]] + depth - 1]
        for name, values in new.items():
            self.parts[name].append(values)
        self.count += len(first)
        done = np.flatnonzero((self.length[rows] == depth) & (node >= 0))
        if len(done):
            cuts = np.flatnonzero(np.diff(node[done])) + 1
            for part in np.split(done, cuts):
                self.ends[int(node[part[0]])] = self.conv[rows[part]]
        state = np.zeros(len(starts), bool)
        state[real] = opened
        return np.where(node >= 0, node, parent), np.where(node >= 0, np.repeat(state, sizes), under_open)

    def _roll_up(self) -> None:
        """Children, and sums over subtrees; open nodes get the sums of closed children alone."""
        below = self.parent[1:]
        every = np.bincount(below, minlength=self.count)
        closed = ~self.open
        self.children = np.bincount(below, closed[1:], minlength=self.count).astype(np.int64)
        self.leaves = (closed & (every == 0)).astype(np.int64)
        self.saved = np.where(closed, (self.n - 1) * self.words, 0)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(self.depth)) + 1, [self.count]])
        for low, high in zip(edges[-2:0:-1], edges[:1:-1]):
            mine = low + np.flatnonzero(closed[low:high])
            np.add.at(self.leaves, self.parent[mine], self.leaves[mine])
            np.add.at(self.saved, self.parent[mine], self.saved[mine])

    def keys(self) -> dict[int, bytes]:
        """Digests of the paths of open nodes."""
        states = {0: hashlib.md5()}
        for node in np.flatnonzero(self.open)[1:]:
            state = states[int(self.parent[node])].copy()
            state.update(self.ids[self.row[node]][self.depth[node] - 1])
            states[int(node)] = state
        return {node: state.digest() for node, state in states.items()}

    def batches(self) -> Iterator[pa.RecordBatch]:
        keys = self.keys()
        out = {name: [] for name in NODE_SCHEMA.names}

        def add(**row) -> None:
            for name, values in out.items():
                values.append(row.get(name))

        for node in range(self.count):
            up, is_open = int(self.parent[node]), bool(self.open[node])
            ends = self.ends.get(node, np.zeros(0, np.int64))
            inner = up >= 0 and not self.open[up]
            add(
                conv_id=int(self.least[node]),
                depth=int(self.depth[node]),
                parent_conv_id=int(self.least[up]) if inner else None,
                key=keys.get(node),
                parent_key=keys[up] if up >= 0 and self.open[up] else None,
                n_convs=int(self.n[node]),
                n_children=int(self.children[node]),
                n_leaves=int(self.leaves[node]),
                saved_tokens=int(self.saved[node]),
                words=int(self.words[node]),
                ends_sha256=None if is_open else hashlib.sha256(",".join(map(str, ends.tolist())).encode()).hexdigest(),
            )
            for low in range(0, len(ends) if is_open else 0, PIECE_IDS):
                part = ends[low : low + PIECE_IDS].tolist()
                add(conv_id=part[0], key=keys[node], piece=",".join(map(str, part)))
            if len(out["key"]) >= 10_000:
                yield pa.RecordBatch.from_pydict(out, NODE_SCHEMA)
                out = {name: [] for name in NODE_SCHEMA.names}
        if out["key"]:
            yield pa.RecordBatch.from_pydict(out, NODE_SCHEMA)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, ids, words = [], [], []
    for batch in batches:
        conv.append(batch.column("conv_id").to_numpy(zero_copy_only=False))
        ids += batch.column("ids").to_pylist()
        words.append(batch.column("words").flatten().to_numpy(zero_copy_only=False))
    if ids:
        yield from Shard(np.concatenate(conv), ids, np.concatenate(words).astype(np.int64)).batches()


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the sorted pieces of each node."""
    key, state, done = None, None, []
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(piece.encode())
            else:
                state.update(f",{piece}".encode())
    if key is not None:
        done.append((key, state.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["_key", "ends"])


def prefix_trie(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of all sequences (``conv_id``, ``turns`` of id and words).

    ``conv_id`` and ``depth`` name a node's last turn: the turn of that number of its least
    member. ``n_convs`` members, ``n_children``, ``n_leaves`` below it, ``saved_tokens``: words
    that need not be repeated if each node's turn is stored once, ``ends_sha256``: digest of
    the ids of the members that end there.
    """
    spark = rows.sparkSession
    rows = stored(rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turns"), "trie-rows")
    total = rows.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    shards = shards or max(shuffle_width(spark), -(-total // SHARD_TURNS))
    flat = rows.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))
    parts = flat.repartitionByRange(shards, F.slice("ids", 1, KEY_TURNS), F.col("conv_id")).mapInArrow(_shards, NODE)
    parts = stored(parts, "trie-parts")
    shared = _recombined(parts.filter("key IS NOT NULL AND piece IS NULL"))
    pieces = parts.filter("piece IS NOT NULL").select("key", "conv_id", "piece").repartition(shuffle_width(spark), "key")
    chains = pieces.sortWithinPartitions("key", "conv_id").mapInArrow(_chain, "_key binary, ends string")
    empty = hashlib.sha256(b"").hexdigest()
    shared = shared.join(chains, F.col("key") == F.col("_key"), "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(empty)))
    shared = stored(shared.drop("_key", "ends"), "trie-shared")
    above = shared.select(F.col("key").alias("_key"), F.col("conv_id").alias("_above"))
    nodes = parts.filter("key IS NULL").select(*shared.columns).unionByName(shared)
    nodes = nodes.join(above, F.col("parent_key") == F.col("_key"), "left")
    columns = ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return nodes.select("conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), *columns)


def _recombined(parts: DataFrame) -> DataFrame:
    """The nodes at the boundaries of shards, whole, with the sums of their subtrees."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    firsts = [F.first(c).alias(c) for c in ("depth", "parent_key", "words")]
    nodes = stored(parts.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *firsts, *sums), "trie-open")
    children = nodes.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("_key")).agg(F.count("*").alias("_more"))
    nodes = nodes.join(children, F.col("key") == F.col("_key"), "left")
    nodes = nodes.withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0)))
    nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    nodes = nodes.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    nodes = stored(nodes.drop("_key", "_more").withColumn("_up", F.col("parent_key")), "trie-open")
    reach, deepest = 1, nodes.agg(F.max("depth")).first()[0] or 0
    while reach <= deepest:
        # Each node's sums reach descendants nearer than ``reach``, ``_up`` is its ancestor at that distance.
        more = nodes.filter("_up IS NOT NULL").groupBy(F.col("_up").alias("_key"))
        more = more.agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        further = nodes.select(F.col("key").alias("_from"), F.col("_up").alias("_next"))
        grown = nodes.join(more, F.col("key") == F.col("_key"), "left").join(further, F.col("_up") == F.col("_from"), "left")
        grown = grown.withColumns(
            {
                "n_leaves": F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)),
                "saved_tokens": F.col("saved_tokens") + F.coalesce("_saved", F.lit(0)),
                "_up": F.col("_next"),
            }
        )
        nodes, reach = stored(grown.select(*nodes.columns), "trie-open"), reach * 2
    return nodes.drop("_up").withColumn("parent_conv_id", F.lit(None).cast("long"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """Sequences whose first turns come from the first conversation of their twenty."""
    rows = stored(rows, "trie-sequences")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    heads = rows.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 3).alias("_head"))
    joined = rows.withColumn("_taken", taken).join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("_base"), "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("_head", none), F.lit(1), F.col("_taken"))
    own = F.slice("turns", F.col("_taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt by the contract's rule."""
    return prefix_trie(rebuilt(sequences(table(spark, sf_dir, "conversations"))))


SQL = f"""
WITH o AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
             ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, {CRC32_SQL.format(x="conv_id::VARCHAR")} % 4 AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS turns
      FROM h LEFT JOIN o AS b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, len(turns) AS n, turns[1:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
v AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends,
             CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words FROM p GROUP BY path, d),
k AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
w AS (SELECT v.*, coalesce(k.n, 0) AS n_children FROM v LEFT JOIN k ON v.path = k.path AND v.d = k.d),
s AS (SELECT path[1:a] AS path, a AS d, count_if(n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON w.path = s.path AND w.d = s.d LEFT JOIN w AS u ON u.path = w.path[1:w.d - 1] AND u.d = w.d - 1
"""
