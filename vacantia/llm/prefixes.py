"""Trie of conversation prefixes: where conversations share their first turns.

Every turn has an id, the MD5 of its role and text. Conversations, one row of turn ids each,
are sorted in ranges over the cluster. A task cuts its range into blocks, each a matrix of turn
numbers padded with 0. ``lexsort`` orders it, changes against the row before, OR-accumulated
along the columns, mark where nodes start, and ``reduceat`` sums up every depth. A node's
subtree is a run of rows, so all its figures are sums over rows:

* a row adds a child at each depth where the next one starts,
* a leaf, where the next row does not continue it,
* and the bytes of its turns at the depths where no node starts.

Nodes on the first and last row of a block may go on in the next one. They are marked by a
digest of their turns and recombined over the cluster by it. Only numbers of ranges reach the
driver: for each, how many turns its first row shares with the row before it.

Defined cases: null roles and texts are empty; turns come by number, null first, equal numbers
by turn id; repeated rows are turns of their own; rows without ``conv_id`` belong to no
conversation; a table without conversations has no nodes. One conversation's ids (16 bytes a
turn, no texts) have to fit a row. Other columns are not looked at.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vacantia.session import cut_lineage

CELLS = 1 << 18  # of a block's matrix, padding included
RANGE_TURNS = 1 << 20  # turns in a range of the sort
BROADCAST_NODES = 1 << 18
ID = 16  # bytes of a turn id

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
SPLIT = "key binary, parent_key binary, part long, ends array<long>"  # of nodes that may go on in another block


def turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its turns, as id and bytes of text, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id"))
    listed = F.array_sort(F.collect_list(F.struct("at", "id", "bytes")))
    return slim.withColumn("at", at).groupBy("conv_id").agg(
        F.transform(listed, lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("turns")
    )


def rebuilt(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations whose first turns are those of the first of their family.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % family`` and its own after its
    first ``h``; ``h`` is the CRC-32 of ``c`` in decimal, modulo ``most``.
    """
    own = turns(conversations)
    head = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), F.slice("turns", 1, most).alias("first")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    taken = F.slice(F.coalesce("first", F.array().cast("array<struct<id:binary,bytes:bigint>>")), F.lit(1), F.col("h"))
    kept = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return (
        own.withColumns({"head": F.col("conv_id") - F.col("conv_id") % family, "h": h}).join(head, "head", "left")
        .select("conv_id", F.concat(taken, kept).alias("turns"))
    )


class Rows:
    """Conversations in order: numbers, offsets of their turns, ids and bytes of the turns."""

    def __init__(self, conv: np.ndarray, at: np.ndarray, ids: np.ndarray, size: np.ndarray):
        self.conv, self.at, self.ids, self.size = conv, at, ids, size

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "Rows":
        def flat(column):
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            at = np.asarray(column.offsets, dtype=np.int64)
            return column.values.slice(at[0], at[-1] - at[0]), at - at[0]

        ids, at = flat(batch.column("ids"))
        size, _ = flat(batch.column("bytes"))
        data = b"".join(ids.to_pylist())
        return cls(np.asarray(batch.column("conv_id")), at, np.frombuffer(data, f"S{ID}"), np.asarray(size, dtype=np.int64))

    def cut(self, a: int, b: int) -> "Rows":
        x, y = self.at[a], self.at[b]
        return Rows(self.conv[a:b], self.at[a : b + 1] - x, self.ids[x:y], self.size[x:y])

    def turns(self, i: int) -> np.ndarray:
        return self.ids[self.at[i] : self.at[i + 1]]


def shared(a: np.ndarray | None, b: np.ndarray | None) -> int:
    """How many first turns are the same; -1 without a row."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def path(ids: np.ndarray) -> list[bytes]:
    """A digest of each prefix, the empty one first."""
    state, out = hashlib.md5(), [b"root"]
    for k, x in enumerate(ids.tolist()):
        state.update(x.ljust(ID, b"\0"))
        out.append(state.copy().digest())
    return out


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Rows]:
    """Runs of rows whose padded matrix has about ``most`` cells; a long row is one alone."""
    for batch in batches:
        rows = Rows.of(batch)
        n, start = len(rows.conv), 0
        longest = np.diff(rows.at)
        while start < n:
            width = np.maximum.accumulate(longest[start : start + most])
            cells = np.maximum(width, 1) * np.arange(1, len(width) + 1)
            stop = start + max(1, int(np.searchsorted(cells, most, "right")))
            yield rows.cut(start, stop)
            start = stop


class Block:
    """The nodes of a block, by depth."""

    def __init__(self, rows: Rows, before: int, after: int):
        """``before`` and ``after``: turns shared with the row before the block and after it."""
        length = np.diff(rows.at)
        n, width = len(length), int(length.max(initial=0))
        number = np.zeros((n, width), np.int64)
        held = np.arange(width) < length[:, None]
        number[held] = np.unique(rows.ids, return_inverse=True)[1] + 1 if len(rows.ids) else 0
        size = np.zeros((n, width), np.int64)
        size[held] = rows.size
        order = np.lexsort((rows.conv, *number.T[::-1]))
        number, size, self.length, self.conv = number[order], size[order], length[order], rows.conv[order]
        self.first, self.last = rows.turns(order[0]), rows.turns(order[-1])
        changed = np.logical_or.accumulate(number[1:] != number[:-1], axis=1)
        # Where a run of equal prefixes begins here, and where it begins in the whole order.
        self.run = np.vstack([np.ones((1, width), bool), changed]) & held[order]
        self.start = self.run.copy()
        self.start[0, : max(before, 0)] = False
        common = np.r_[np.minimum(width - changed.sum(axis=1), np.minimum(self.length[1:], self.length[:-1])), after]
        self.leaf = (common < self.length) | (common < 0)
        self.saved = np.cumsum(np.where(self.start, 0, size)[:, ::-1], axis=1)[:, ::-1]
        self.width, self.before, self.after = width, before, after

    def nodes(self) -> Iterator[dict]:
        """Columns of the nodes of each depth; ``key`` where a node may go on outside."""
        n = len(self.conv)
        firsts, lasts = path(self.first), path(self.last)
        above = None  # run of the node above for each row, and its parent's columns
        for depth in range(self.width + 1):
            rows = np.flatnonzero(self.length >= depth)
            begin = np.flatnonzero(self.run[rows, depth - 1]) if depth else np.zeros(1, np.int64)
            conv = np.minimum.reduceat(self.conv[rows], begin)
            count = np.diff(np.r_[begin, len(rows)])
            zero = np.zeros(n, np.int64)
            child = self.start[:, depth].astype(np.int64) if depth < self.width else zero
            saved = self.saved[:, depth - 1] if depth else self.saved[:, 0] if self.width else zero
            key = np.full(len(begin), None, object)
            if depth == 0 or depth <= self.after and len(self.last) >= depth:
                key[-1] = lasts[depth]
            if depth == 0 or depth <= self.before and len(self.first) >= depth:
                key[0] = firsts[depth]
            parent_conv, parent_key = np.full(len(begin), None, object), np.full(len(begin), None, object)
            if depth:
                of, convs, keys = above
                parent = of[rows[begin]]
                parent_key = keys[parent]
                parent_conv = np.where(np.equal(parent_key, None), convs[parent], None)
            of = np.zeros(n, np.int64)
            of[rows] = np.repeat(np.arange(len(begin)), count)
            ended = rows[self.length[rows] == depth]
            ends = np.split(self.conv[ended], np.searchsorted(of[ended], np.arange(1, len(begin))))
            yield {
                "conv_id": conv, "depth": np.full(len(begin), depth), "parent_conv_id": parent_conv, "n_convs": count,
                "n_children": np.add.reduceat(child[rows], begin), "n_leaves": np.add.reduceat(self.leaf[rows].astype(np.int64), begin),
                "saved_tokens": np.add.reduceat(saved[rows], begin), "key": key, "parent_key": parent_key, "ends": ends,
            }
            above = of, conv, key


EMPTY = hashlib.sha256(b"").hexdigest()


def decimals(convs: np.ndarray) -> bytes:
    return ",".join(map(str, convs.tolist())).encode()


def rows_of(nodes: dict, part: int) -> pa.RecordBatch:
    """Ends are hashed where a node lies whole in its block, and listed elsewhere."""
    alone = np.equal(nodes["key"], None)
    digest = [
        None if not own else EMPTY if not len(e) else hashlib.sha256(decimals(e)).hexdigest() for own, e in zip(alone, nodes["ends"])
    ]
    listed = [None if own or not len(e) else e for own, e in zip(alone, nodes["ends"])]
    whole = [pa.array(nodes[c], pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return pa.RecordBatch.from_arrays(
        [
            *whole, pa.array(digest, pa.string()), pa.array(nodes["key"], pa.binary()), pa.array(nodes["parent_key"], pa.binary()),
            pa.array(np.full(len(digest), part), pa.int64()), pa.array(listed, pa.list_(pa.int64())),
        ],
        ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "parent_key", "part", "ends"],
    )


def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all prefixes of the first and the last row of a range."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            ids = batch.column("ids")
            first = ids[0].as_py() if first is None else first
            last = ids[batch.num_rows - 1].as_py()
    if first is None:
        return
    part = TaskContext.get().partitionId()
    for name, ids in (("first", first), ("last", last)):
        digests = path(np.array(ids, f"S{ID}"))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(digests), pa.int64()), pa.array([name] * len(digests), pa.string()),
                pa.array(range(len(digests)), pa.int64()), pa.array(digests, pa.binary()),
            ],
            ["part", "side", "depth", "digest"],
        )


def borders(ranges: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Turns that the first row of a range shares with the row before it, by either range.

    First by the range itself, then by the nearest range before it that has rows. One number
    per range, so both are bounded by the number of partitions.
    """
    found = cut_lineage(ranges.select("ids").mapInArrow(edges, "part long, side string, depth long, digest binary"))
    parts = found.filter("side = 'first' AND depth = 0").select(
        "part", F.lag("part").over(Window.orderBy("part")).alias("before")
    )
    first = found.filter("side = 'first'").join(parts, "part").select("part", "before", "depth", "digest")
    last = found.filter("side = 'last'").select(F.col("part").alias("before"), "depth", "digest")
    same = first.join(last, ["before", "depth", "digest"]).groupBy("part", "before").agg(F.max("depth").alias("n")).collect()
    return {r["part"]: r["n"] for r in same}, {r["before"]: r["n"] for r in same}


def hashed_ends(nodes: DataFrame) -> DataFrame:
    """SHA-256 of the ends of each node that lies in several blocks, in a stream over its parts."""

    def stream(batches):
        key, state = None, None
        for batch in batches:
            done, digests = [], []
            for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends")):
                text = decimals(np.asarray(ends.values))
                if k != key:
                    if key is not None:
                        done.append(key)
                        digests.append(state.hexdigest())
                    key, state = k, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    listed = nodes.filter("ends IS NOT NULL").select("key", "part", "ends")
    return listed.repartition("key").sortWithinPartitions("key", "part").select("key", "ends").mapInArrow(
        stream, "key binary, ends_sha256 string"
    )


def trie(conversations: DataFrame, *, cells: int = CELLS, range_turns: int = RANGE_TURNS) -> DataFrame:
    """Nodes of ``(conv_id, turns array<struct<id binary, bytes bigint>>)``, one row each."""
    rows = cut_lineage(conversations.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.bytes").alias("bytes")))
    total = rows.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    ranges = cut_lineage(
        rows.repartitionByRange(max(1, -(-total // range_turns)), "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    )
    shares = conversations.sparkSession.sparkContext.broadcast(borders(ranges))

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        waiting, before = None, shares.value[0].get(part, -1)
        for rows in blocks(batches, cells):
            if waiting is not None:
                common = shared(waiting.turns(len(waiting.conv) - 1), rows.turns(0))
                for nodes in Block(waiting, before, common).nodes():
                    yield rows_of(nodes, (part << 32) + number)
                before, number = common, number + 1
            waiting = rows
        if waiting is not None:
            for nodes in Block(waiting, before, shares.value[1].get(part, -1)).nodes():
                yield rows_of(nodes, (part << 32) + number)

    nodes = cut_lineage(ranges.mapInArrow(run, f"{NODE}, ends_sha256 string, {SPLIT}"))
    split = nodes.filter("key IS NOT NULL")
    joined = split.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("parent_key").alias("parent_key"),
    )
    joined = cut_lineage(joined.join(hashed_ends(split), "key", "left").fillna({"ends_sha256": EMPTY}))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    if joined.count() <= BROADCAST_NODES:
        parents = F.broadcast(parents)
    whole = nodes.filter("key IS NULL").select(*columns, "parent_key").unionByName(joined.select(*columns, "parent_key"))
    return whole.join(parents, "parent_key", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "__parent")
    ).select(*columns)
