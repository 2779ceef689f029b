"""Substring dedup: bytes covered by a long string that starts at two places or more.

Candidates come from ``passages`` (windows of 200 bytes). The pieces that have to be
compared are sorted as suffixes in two stages: those smaller than their successors are
sorted directly, the others are induced from them by scanning the buckets of first bytes
in order. Neighbours in that order whose common prefix has 200 bytes repeat.

Defined cases: a null text counts as empty and yields 0 bytes; strings never cross
documents; the strings are judged on the input, overlaps and the same document included; a
row that comes twice makes all its strings of 200 bytes repeat; rows without an id are
treated like others; no text or row is left out, however long or frequent.
"""

import hashlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacantia.llm import passages
from vacantia.llm.arrays import U64, odd_constants, text_bytes

LENGTH = 200
GRAM = 50
_VALUES = odd_constants(256, 4)
_STEP = 8


class Packed:
    """Eight bytes at any place as one number that sorts like them; text ends read as 0.

    ``stop`` is the end of the string that each place belongs to. Whoever compares two
    numbers compares the bytes left as well, which tells ends from zero bytes.
    """

    def __init__(self, data: np.ndarray):
        padded = np.zeros(len(data) + _STEP, np.uint8)
        padded[: len(data)] = data
        self.at_ = np.ndarray((len(data) + 1,), ">u8", buffer=padded, strides=(1,))

    def at(self, place: np.ndarray, stop: np.ndarray) -> np.ndarray:
        value = self.at_[np.minimum(place, len(self.at_) - 1)].astype(U64)
        # Few strings end within eight bytes; only there something is cut.
        some = np.flatnonzero(stop - place < _STEP)
        keep = np.clip(stop[some] - place[some], 0, _STEP)
        drop = np.minimum((_STEP - keep).astype(U64) * U64(8), U64(63))
        value[some] = np.where(keep > 0, (value[some] >> drop) << drop, U64(0))
        return value


def _places(n: int) -> type:
    """The smallest kind of number for places among ``n`` bytes."""
    return np.int32 if n < 1 << 30 else np.int64


def smaller_than_next(data: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which suffixes sort before the one that starts a byte later; a string's end sorts first."""
    n, kind = len(data), _places(len(data))
    ends = stop[:-1] != stop[1:]
    rising, falling = np.zeros(n, bool), np.ones(n, bool)
    rising[:-1] = (data[:-1] < data[1:]) & ~ends
    falling[:-1] = (data[:-1] > data[1:]) | ends
    # Equal neighbours are of the kind of the next place where bytes differ.
    decided = np.where(rising | falling, np.arange(n, dtype=kind), kind(n))[::-1]
    return rising[np.minimum.accumulate(decided, out=decided)[::-1]]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _order(group: np.ndarray, key: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order by key and then bytes left inside each group; groups are numbered and stay in order."""
    by = np.argsort(key)
    small = np.uint16 if group[-1] < 1 << 16 else np.int64  # 16 bits sort in linear time
    by = by[np.argsort(group.astype(small)[by], kind="stable")]
    if (left < _STEP).any():
        # Equal bytes are told apart by the string's end; few runs hold one.
        run = np.cumsum(_runs(group[by], key[by])) - 1
        ends = np.zeros(run[-1] + 1, bool)
        ends[run[left[by] < _STEP]] = True
        some = np.flatnonzero(ends[run])
        by[some] = by[some][np.lexsort((left[by[some]], run[some]))]
    return by


def sort_directly(packed: Packed, place: np.ndarray, stop: np.ndarray, depth: int) -> np.ndarray:
    """``place`` in the order of the suffixes there, by their first ``depth`` bytes."""
    order = np.arange(len(place), dtype=place.dtype)
    # Of the places still tied: where they stand in the order, next byte, end, first of a group.
    active, at, end, head = order.copy(), place, stop, np.zeros(len(place), bool)
    head[:1] = True
    for _ in range(0, depth, _STEP):
        if len(active) < 2:
            break
        key, left = packed.at(at, end), np.minimum(end - at, _STEP).astype(np.int8)
        changed = ~head & _runs(key, left)
        # Copies stay alike for long: only groups whose next bytes differ are sorted.
        if changed.any():
            number = np.cumsum(head, dtype=place.dtype) - 1
            differ = np.zeros(number[-1] + 1, bool)
            differ[number[changed]] = True
            some = np.flatnonzero(differ[number])
            by = some[_order(np.cumsum(head[some], dtype=place.dtype) - 1, key[some], left[some])]
            order[active[some]] = order[active[by]]
            at, end = at.copy(), end.copy()
            for x in (key, left, at, end):
                x[some] = x[by]
            head = head | _runs(key, left)
        tied = left == _STEP
        tied[:-1] &= ~head[:-1] | ~head[1:]
        tied[-1] &= not head[-1]
        active, at, end, head = active[tied], at[tied] + _STEP, end[tied], head[tied]
    return place[order]


def two_stage(data: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of all strings, in order of their first ``depth`` bytes at least.

    ``depth`` bounds the direct sort; what is induced from it is ordered as deeply.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    stop = np.repeat(offsets[1:].astype(_places(n)), np.diff(offsets))
    direct = np.flatnonzero(smaller_than_next(data, stop)).astype(stop.dtype)
    direct = sort_directly(Packed(data), direct, stop[direct], depth)
    del stop
    first = data[direct]
    direct_at = np.searchsorted(first, np.arange(257))
    before = np.full(n, -1, np.int16)  # the byte before each place, -1 at a string's start
    before[1:] = data[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = -1
    queue: list[list[np.ndarray]] = [[] for _ in range(256)]

    def hand_on(places: np.ndarray, above: int) -> None:
        """Queues what precedes these places, if it sorts in a later bucket."""
        byte = before[places]
        use = byte > above
        byte, places = byte[use], places[use] - 1
        order = np.argsort(byte, kind="stable")
        byte, places = byte[order], places[order]
        cut = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]]) if len(byte) else byte
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(byte)]):
            queue[int(byte[a])].append(places[a:b])

    # The ends of the strings sort before everything; the last byte of each comes from them.
    ends = offsets[1:][np.diff(offsets) > 0]
    last = (ends - 1).astype(direct.dtype)
    by = np.argsort(data[last], kind="stable")
    for c in range(256):
        some = last[by][slice(*np.searchsorted(data[last][by], [c, c + 1]))]
        if len(some):
            queue[c].append(some)
    out = []
    for c in range(256):
        level = np.concatenate(queue[c]) if queue[c] else direct[:0]
        induced = []
        while len(level):
            induced.append(level)
            level = level[before[level] == c] - 1
        bucket = np.concatenate([*induced, direct[direct_at[c] : direct_at[c + 1]]])
        out.append(bucket)
        hand_on(bucket, c)
        queue[c] = []
    return np.concatenate(out)


def common_prefix(packed: Packed, a: np.ndarray, b: np.ndarray, stop_a, stop_b, most: int) -> np.ndarray:
    """Bytes that suffixes ``a`` and ``b`` begin with alike, up to ``most``."""
    out = np.zeros(len(a), np.int64)
    todo = np.arange(len(a))
    for done in range(0, most, _STEP):
        x, y = packed.at(a[todo] + done, stop_a[todo]), packed.at(b[todo] + done, stop_b[todo])
        room = np.minimum(stop_a[todo] - a[todo], stop_b[todo] - b[todo]) - done
        same = np.full(len(todo), _STEP)
        unlike = np.flatnonzero(x != y)
        change = x[unlike] ^ y[unlike]
        same[unlike] = 0
        for j in range(1, _STEP):
            same[unlike] += change >> U64(64 - 8 * j) == 0
        same = np.clip(np.minimum(same, room), 0, _STEP)
        out[todo] += same
        todo = todo[same == _STEP]
    return np.minimum(out, most)


def repeats(content: list[bytes], many: np.ndarray, *_) -> tuple:
    """Runs of windows of each piece that occur elsewhere: piece, first, last window."""
    data, offsets = text_bytes(pa.array(content, pa.large_binary()))
    array = two_stage(data, offsets, LENGTH)
    stop = np.repeat(offsets[1:].astype(array.dtype), np.diff(offsets))
    array = array[stop[array] - array >= LENGTH]
    again = np.zeros(len(data) + 1, bool)
    if len(array) > 1:
        a, b = array[:-1], array[1:]
        same = common_prefix(Packed(data), a, b, stop[a], stop[b], LENGTH) >= LENGTH
        again[a[same]] = again[b[same]] = True
    starts = np.diff(offsets) - LENGTH + 1
    for i in np.flatnonzero(many):
        again[offsets[i] : offsets[i] + starts[i]] = True
    edge = np.flatnonzero(again[1:] != again[:-1]) + 1
    edge = np.r_[0, edge] if again[0] else edge
    first, last = edge[::2], edge[1::2] - 1
    # A run never passes from one piece to the next: the last 199 places start no window.
    piece = np.searchsorted(offsets, first, "right") - 1
    return piece, first - offsets[piece], last - offsets[piece], np.zeros(len(piece), np.int64)


class _Bytes(passages.Chunk):
    def __init__(self, docs: pa.Table, step: int):
        self.buf, self.offsets = text_bytes(docs.column("text"))
        # Nothing as long as the chunk is held in more bits than it needs.
        kind = np.int32 if len(self.buf) < 1 << 31 else np.int64
        left = np.repeat(self.offsets[1:].astype(kind), np.diff(self.offsets))
        left -= np.arange(len(self.buf), dtype=kind)
        found = passages.segments(self.buf, left, LENGTH, GRAM, step, _VALUES)
        super().__init__(found, np.zeros(len(found.start), np.int64))


def _content(chunk: _Bytes, start: np.ndarray, windows: np.ndarray) -> list[bytes]:
    data = chunk.buf.tobytes()
    return [data[a : a + n + LENGTH - 1] for a, n in zip(start.tolist(), windows.tolist())]


SEARCH = passages.Search(LENGTH, _Bytes, _content, repeats, by_document=False)


def _maximal(first: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of bytes, none of them over two documents, joined where they meet inside one."""
    order = np.argsort(first, kind="stable")
    first, upto = first[order], np.maximum.accumulate(end[order])
    doc = np.searchsorted(offsets, first, "right")
    new = np.ones(len(first) + 1, bool)
    new[1:-1] = (first[1:] > upto[:-1]) | (doc[1:] != doc[:-1])
    return first[new[:-1]], upto[new[1:]]


def _finish(with_text: bool):
    def finish(docs: pa.Table, chunk: _Bytes, first, last, _) -> pa.Table:
        n, at = docs.num_rows, chunk.offsets
        first, end = _maximal(first, last + LENGTH, at)
        change = np.zeros(len(chunk.buf) + 1, np.int8)
        change[first] += 1
        change[end] -= 1
        removed = np.cumsum(change[:-1], dtype=np.int8, out=change[:-1]).view(bool)
        runs = np.searchsorted(first, at)
        upto = np.r_[0, np.cumsum(end - first)][runs]
        kept = chunk.buf[~removed].tobytes()
        kept_at = at - upto
        texts = [kept[kept_at[i] : kept_at[i + 1]] for i in range(n)]
        out = {
            "doc_id": docs.column("doc_id"), "n_bytes": pa.array(np.diff(at)),
            "n_removed": pa.array(np.diff(upto)), "n_spans": pa.array(np.diff(runs)),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        }
        if with_text:
            out["kept"] = pa.array(texts, pa.binary())
        return pa.table(out)

    return finish


def remove_repeats(
    docs: DataFrame, *, with_text: bool = False, chunk_bytes: int = passages.CHUNK_BYTES,
    heavy: int = passages.HEAVY, step: int = passages.STEP,
) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, hash of what is left (and it)."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return passages.search(
        docs, replace(SEARCH, heavy=heavy, step=step), _finish(with_text),
        schema + ", kept binary" * with_text, chunk_bytes,
    )
