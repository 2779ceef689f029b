"""Finds passages that repeat over a whole corpus, without moving the text of all windows.

A *window* is a fixed number of consecutive units (bytes, or words) of one text. Each
window is filed under its *anchor*: of the short grams inside it the one with the least
hash, the leftmost if several are equal. Equal windows have equal anchors, and windows
that follow one another mostly share one, so a text falls into *segments* of neighbouring
windows with one anchor. Documents are dealt into chunks of bounded size, and then

1. each chunk sends, per distinct anchor, one packed entry to the anchor's bucket;
2. each bucket tells the chunks which anchors repeat, and whether all segments under them
   are equal (then all their windows repeat) or differ (``MIXED``);
3. only segments under mixed anchors are sent with their content to be compared;
4. each chunk learns which windows of its segments repeat, and marks its documents.

A hot anchor costs one entry per chunk in step 1. In step 3 an anchor with more than
``heavy`` segments is split: its windows are dealt one by one by a hash of their content,
so equal ones still meet and no task holds them all. The documents are shuffled once, by
chunk, and that exchange is read again by steps 3 and 4.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vacantia.llm.arrays import U64, expand, mix

CHUNK_BYTES = 4 << 20
STEP = 1 << 18  # units hashed at a time; a step holds some 15 numbers for each
HEAVY = 20_000
UNIFORM, MIXED, SPLIT = 1, 2, 3
_BASE = 0x9E3779B97F4A7C15
_LOW = U64(0xFFFFFFFF)

ENTRY = "bucket int, chunk int, anchor binary, seg binary, flags binary, segs binary, doc binary"
REPLY = "chunk int, kind int, anchor binary, seg binary, first binary, last binary, doc binary"
PIECE = "bucket int, chunk int, anchor long, seg long, at int, content binary, many boolean, doc long, other long"


@dataclass
class Segments:
    """Segments of some texts: first window (a unit's number), windows, anchor, content hash."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    seg: np.ndarray

    def take(self, which: np.ndarray) -> "Segments":
        return Segments(self.start[which], self.windows[which], self.anchor[which], self.seg[which])


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        power = np.full(n, base, U64)
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


def sliding_min(key: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` consecutive keys, from minima within blocks of ``w``."""
    n = len(key) - w + 1
    full = np.full(-(-len(key) // w) * w, ~U64(0))
    full[: len(key)] = key
    blocks = full.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def segments(
    values: np.ndarray, left: np.ndarray, window: int, gram: int, step: int = STEP, table: np.ndarray | None = None
) -> Segments:
    """Segments of the texts whose units have these 64-bit values (with ``table``, are these
    places in a table of values); ``left`` counts the units from each one to the end of its
    text. Long inputs are taken in steps that overlap by a window, so each window is in one
    segment."""
    found = []
    for a in range(0, max(0, len(values) - window + 1), step):
        v = values[a : a + step + window - 1]
        m = len(v) - window + 1
        ok = left[a : a + m] >= window
        if not ok.any():
            continue
        v = v if table is None else table[v]
        power, inverse = _powers(step + window)
        total = np.zeros(len(v) + 1, U64)
        np.cumsum(v * power[: len(v)], out=total[1:])
        grams = mix((total[gram:] - total[:-gram]) * inverse[: len(v) - gram + 1])
        key = (grams & ~_LOW) | np.arange(len(grams), dtype=U64)
        at = (sliding_min(key, window - gram + 1) & _LOW).astype(np.int64)
        begin = ok.copy()
        begin[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
        start = np.flatnonzero(begin)
        edge = np.r_[np.flatnonzero(begin | ~ok), m]
        windows = edge[np.searchsorted(edge, start, "right")] - start
        content = (total[start + windows + window - 1] - total[start]) * inverse[start]
        seg = mix(content + windows.astype(U64) * U64(0xD1342543DE82EF95))
        found.append((start + a, windows, grams[at[start]], seg))
    if not found:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none.astype(U64), none.astype(U64))
    return Segments(*map(np.concatenate, zip(*found)))


def pack(values: np.ndarray) -> bytes:
    """Bytes of the values, all first bytes, then all second ones and so on: runs of equal
    high bytes are left to the shuffle's compression."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unpack(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.frombuffer(blob, np.uint8).reshape(width, -1).T.copy().view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, U64), dtype=U64)


def gather(table: pa.Table, name: str, read: Callable) -> list[np.ndarray]:
    return [read(x.as_py()) for x in table.column(name)]


def together(arrays: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype)


class Chunk:
    """The documents of one chunk, cut into segments. ``doc`` is the number by which a
    segment's text is ranked (0 where ranks do not count)."""

    def __init__(self, found: Segments, doc: np.ndarray):
        self.found, self.doc = found, doc


@dataclass(frozen=True)
class Search:
    """What is searched for. ``cut`` makes a ``Chunk`` of a table of documents, ``content``
    gives the bytes of some of its windows, ``compare`` finds repeats among pieces.

    Without ``by_document`` a window repeats when it occurs twice anywhere; with it, when it
    occurs in two documents, and the smallest of their ranks is told.
    """

    window: int
    cut: Callable
    content: Callable
    compare: Callable
    by_document: bool
    heavy: int = HEAVY
    step: int = STEP

    def entries(self, key, table: pa.Table, buckets: int) -> pa.Table:
        chunk = self.cut(table, self.step)
        order = np.argsort(chunk.found.anchor, kind="stable")
        anchor, seg, doc = chunk.found.anchor[order], chunk.found.seg[order], chunk.doc[order]
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else order
        rows: dict[str, list] = {c.split()[0]: [] for c in ENTRY.split(", ")}
        if len(first):
            count = np.diff(np.r_[first, len(anchor)])
            low, high = np.minimum.reduceat(seg, first), np.maximum.reduceat(seg, first)
            doc_low = np.minimum.reduceat(doc, first)
            often = np.maximum.reduceat(doc, first) > doc_low if self.by_document else count > 1
            flags = (low != high).astype(np.uint8) | often.astype(np.uint8) << 1
            anchor = anchor[first]
            bucket = ((anchor >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(anchor)]):
                rows["bucket"].append(int(bucket[a]))
                rows["chunk"].append(key)
                rows["anchor"].append(pack_sorted(anchor[a:b]))
                rows["seg"].append(pack(low[a:b]))
                rows["flags"].append(flags[a:b].tobytes())
                rows["segs"].append(pack(count[a:b].astype(np.uint32)))
                rows["doc"].append(pack(doc_low[a:b]) if self.by_document else b"")
        return _table(rows, ENTRY)

    def replies(self, table: pa.Table) -> pa.Table:
        """For each chunk the anchors of it that repeat."""
        anchors = gather(table, "anchor", unpack_sorted)
        sizes = [len(a) for a in anchors]
        chunk = np.repeat(np.asarray(table.column("chunk")), sizes)
        anchor = together(anchors, U64)
        seg = together(gather(table, "seg", lambda b: unpack(b, U64)), U64)
        flags = together(gather(table, "flags", lambda b: np.frombuffer(b, np.uint8)), np.uint8)
        segs = together(gather(table, "segs", lambda b: unpack(b, np.uint32)), np.uint32)
        doc = (
            together(gather(table, "doc", lambda b: unpack(b, np.int64)), np.int64)
            if self.by_document else np.zeros(len(anchor), np.int64)
        )
        order = np.argsort(anchor, kind="stable")
        chunk, anchor, seg, flags, segs, doc = (x[order] for x in (chunk, anchor, seg, flags, segs, doc))
        if not len(anchor):
            return _table({c.split()[0]: [] for c in REPLY.split(", ")}, REPLY)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        count = np.diff(np.r_[first, len(anchor)])
        flag = np.bitwise_or.reduceat(flags, first)
        repeats = (count > 1) | (flag & 2 > 0)
        mixed = (flag & 1 > 0) | (np.minimum.reduceat(seg, first) != np.maximum.reduceat(seg, first))
        many = np.add.reduceat(segs.astype(np.int64), first) > self.heavy
        status = np.where(mixed, np.where(many, SPLIT, MIXED), UNIFORM).astype(np.uint8)
        least = np.minimum.reduceat(doc, first)
        slot, which = expand(first[repeats], count[repeats])
        which = np.flatnonzero(repeats)[which]
        return _reply(0, chunk[slot], anchor[slot], None, status[which], None, least[which] if self.by_document else None)

    def pieces(self, key, docs: pa.Table, told: pa.Table, buckets: int) -> pa.Table:
        """Segments under mixed anchors, each distinct one of the chunk once, with content."""
        anchor, status, _ = _told(told)
        chunk = self.cut(docs, self.step)
        found = chunk.found
        at, known = _lookup(found.anchor, anchor)
        use = np.flatnonzero(known & (status[at] >= MIXED)) if len(anchor) else np.zeros(0, np.int64)
        order = use[np.lexsort((found.seg[use], found.anchor[use]))]
        some, doc, split = found.take(order), chunk.doc[order], status[at[order]] == SPLIT if len(order) else order > 0
        new = _changes(some.anchor, some.seg)
        first = np.flatnonzero(new)
        if not len(first):
            return _table({c.split()[0]: [] for c in PIECE.split(", ")}, PIECE)
        low, high = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
        many = np.diff(np.r_[first, len(new)]) > 1
        one, split = some.take(first), split[first]
        # Whole segments go by anchor; the windows of split ones by what they hold.
        whole = np.flatnonzero(~split)
        content = self.content(chunk, one.start[whole], one.windows[whole])
        bucket = mix(one.anchor[whole])
        rows = [whole, np.zeros(len(whole), np.int64), content, bucket]
        heavy = np.flatnonzero(split)
        place, which = expand(one.start[heavy], one.windows[heavy])
        if len(place):
            which = heavy[which]
            windows = self.content(chunk, place, np.ones(len(place), np.int64))
            rows = [
                np.r_[whole, which], np.r_[rows[1], place - one.start[which]], [*content, *windows],
                np.r_[bucket, [U64(_content_hash(w)) for w in windows]],
            ]
        row, at, content, bucket = rows
        return pa.table(
            {
                "bucket": pa.array((bucket % U64(buckets)).astype(np.int32)),
                "chunk": pa.array(np.full(len(row), key, np.int32)),
                "anchor": pa.array(one.anchor[row].view(np.int64)), "seg": pa.array(one.seg[row].view(np.int64)),
                "at": pa.array(at.astype(np.int32)), "content": pa.array(content, pa.binary()),
                "many": pa.array(many[row]), "doc": pa.array(low[row]), "other": pa.array(high[row]),
            }
        )

    def compared(self, table: pa.Table) -> pa.Table:
        """Runs of repeating windows of each piece, to every chunk that sent it."""
        anchor = np.asarray(table.column("anchor")).view(U64)
        seg = np.asarray(table.column("seg")).view(U64)
        at, chunk = np.asarray(table.column("at")).astype(np.int64), np.asarray(table.column("chunk"))
        order = np.lexsort((at, seg, anchor))
        new = _changes(anchor[order], seg[order], at[order])
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(order)])
        piece = order[first]
        content = [table.column("content")[int(i)].as_py() for i in piece]
        reduce = lambda f, name: f.reduceat(np.asarray(table.column(name))[order], first)
        many = reduce(np.logical_or, "many") | (count > 1)
        which, low, high, doc = self.compare(
            content, many, reduce(np.minimum, "doc"), reduce(np.maximum, "other")
        )
        slot, run = expand(first[which], count[which])
        row = order[slot]
        return _reply(
            1, chunk[row], anchor[row], seg[row], (low + at[piece[which]])[run].astype(np.int32),
            (high + at[piece[which]])[run].astype(np.int32), doc[run] if self.by_document else None,
        )

    def marked(self, docs: pa.Table, told: pa.Table) -> tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]:
        """The chunk, and the runs of its windows that repeat: first, last, least rank."""
        chunk = self.cut(docs, self.step)
        found = chunk.found
        anchor, status, doc = _told(told)
        at, known = _lookup(found.anchor, anchor)
        use = np.flatnonzero(known & (status[at] == UNIFORM)) if len(anchor) else np.zeros(0, np.int64)
        first, last = [found.start[use]], [found.start[use] + found.windows[use] - 1]
        least = [doc[at[use]]]
        runs = told.filter(pa.compute.equal(told.column("kind"), 1))
        if runs.num_rows:
            read = lambda name, kind: together(gather(runs, name, lambda b: unpack(b, kind)), kind)
            a, s = read("anchor", U64), read("seg", U64)
            low, high = read("first", np.int32), read("last", np.int32)
            rank = read("doc", np.int64) if self.by_document else np.zeros(len(a), np.int64)
            by = np.lexsort((s, a))
            a, s, low, high, rank = (x[by] for x in (a, s, low, high, rank))
            # Runs of each (anchor, seg), joined to all segments of that kind.
            head = np.flatnonzero(_changes(a, s))
            size = np.diff(np.r_[head, len(a)])
            # Two 64-bit keys as one, by their place among the told ones.
            at, known = _lookup_pairs(found.anchor, found.seg, a[head], s[head])
            use = np.flatnonzero(known)
            slot, which = expand(head[at[use]], size[at[use]])
            start = found.start[use][which]
            first.append(start + low[slot])
            last.append(start + high[slot])
            least.append(rank[slot])
        return chunk, np.concatenate(first), np.concatenate(last), np.concatenate(least)


def _content_hash(content: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(content)


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _lookup(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return at, known[at] == values


def _lookup_pairs(a, b, known_a, known_b) -> tuple[np.ndarray, np.ndarray]:
    """Place of each pair among known distinct pairs, and whether it is one."""
    joint = mix(a) ^ b
    known = mix(known_a) ^ known_b
    order = np.argsort(known, kind="stable")
    at, same = _lookup(joint, known[order])
    at = order[at] if len(order) else at
    return at, same & (known_a[at] == a) & (known_b[at] == b) if len(order) else same


def _told(told: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = told.filter(pa.compute.equal(told.column("kind"), 0))
    anchor = together(gather(table, "anchor", lambda b: unpack(b, U64)), U64)
    status = together(gather(table, "first", lambda b: np.frombuffer(b, np.uint8)), np.uint8)
    doc = together(gather(table, "doc", lambda b: unpack(b, np.int64) if b else np.zeros(0, np.int64)), np.int64)
    if not len(doc):
        doc = np.zeros(len(anchor), np.int64)
    order = np.argsort(anchor, kind="stable")
    return anchor[order], status[order], doc[order]


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _table(rows: dict[str, list], schema: str) -> pa.Table:
    kinds = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array(rows[name], _ARROW[kind]) for name, kind in kinds})


def _reply(kind: int, chunk, anchor, seg, first, last, doc) -> pa.Table:
    """One packed row per chunk."""
    rows: dict[str, list] = {c.split()[0]: [] for c in REPLY.split(", ")}
    order = np.argsort(chunk, kind="stable")
    chunk = chunk[order]
    cut = np.flatnonzero(_changes(chunk)) if len(chunk) else chunk
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(chunk)]):
        which = order[a:b]
        rows["chunk"].append(int(chunk[a]))
        rows["kind"].append(kind)
        for name, values in zip(("anchor", "seg", "first", "last", "doc"), (anchor, seg, first, last, doc)):
            rows[name].append(b"" if values is None else pack(values[which]))
    return _table(rows, REPLY)


def search(
    docs: DataFrame, wanted: Search, finish: Callable, schema: str, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Runs ``finish(documents of a chunk, chunk, runs)`` on every chunk of ``(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    buckets, piece_buckets = max(1, -(-chunks // 3)), 4 * chunks
    # Rows without an id are dealt by their text.
    key = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    dealt = docs.select(F.pmod(key, F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text").repartition("chunk")

    entries = dealt.groupBy("chunk").applyInArrow(
        lambda key, t: wanted.entries(key[0].as_py(), t, buckets), ENTRY
    )
    replies = entries.groupBy("bucket").applyInArrow(lambda t: wanted.replies(t), REPLY)
    pieces = dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        lambda key, t, told: wanted.pieces(key[0].as_py(), t, told, piece_buckets), PIECE
    )
    compared = pieces.groupBy("bucket").applyInArrow(lambda t: wanted.compared(t), REPLY)
    return dealt.groupBy("chunk").cogroup(replies.unionAll(compared).groupBy("chunk")).applyInArrow(
        lambda key, t, told: finish(t, *wanted.marked(t, told)), schema
    )
