"""Text as numpy arrays, inside tasks: byte views, words, hashes, windows.

All functions work on one Arrow batch (or a part of one) and hold a small multiple of
its bytes. Nulls count as empty texts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_GOLDEN, _MIX1, _MIX2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd multipliers, one stream per seed."""
    start = U64((seed * 0xD1342543DE82EF95) & (2**64 - 1))
    return mix(start + np.arange(1, n + 1, dtype=U64) * _GOLDEN) | U64(1)


#: Word classes as byte tables. Every code point from U+0080 is made of bytes >= 0x80,
#: so a class that takes all of them can be decided byte by byte.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[0x20] = NOT_SPACE[0x09:0x0E] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def parts(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``limit`` bytes of text each.

    A single row is never cut, so a part is at most ``limit`` plus one text.
    """
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.cumsum(np.asarray(size, dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(total[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and the ``n + 1`` offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(at) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """Words of a run of texts: byte positions, text number and 64-bit hash of each."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        inside = table[buf]
        edge = np.empty(len(buf) + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[offsets] = True
        cut = np.flatnonzero(edge)
        first = cut[:-1]
        word = inside[first] if len(buf) else np.zeros(0, bool)
        self.buf = buf
        self.start = first[word]
        self.end = cut[1:][word]
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.hash = span_hashes(buf, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return self.bounds[self.text + 1] - np.arange(len(self.start))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    eight = np.ndarray((len(buf) + 1,), "<u8", buffer=padded, strides=(1,))
    size = end - start
    out = mix(size.astype(U64) * _GOLDEN + _MIX2)
    todo, at = np.arange(len(start)), start
    while len(todo):
        keep = np.minimum(end[todo] - at, 8).astype(U64)
        mask = ~U64(0) >> ((U64(8) - keep) * U64(8))
        out[todo] = mix(out[todo] * _MIX1 ^ mix((eight[at] & mask) + _GOLDEN))
        at = at + 8
        more = at < end[todo]
        todo, at = todo[more], at[more]
    return out


def window_hashes(values: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive values, text ends not regarded."""
    m = max(0, len(values) - k + 1)
    out = np.zeros(m, U64)
    for j, c in enumerate(odd_constants(k, seed)):
        out += values[j : j + m] * c
    return mix(out)


def unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by ``a`` then ``b``."""
    if not len(a):
        return a, b
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    return a[new], b[new]


def expand(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges ``[start, start + count)``, with the number of each range."""
    which = np.repeat(np.arange(len(starts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(first - starts, counts), which


def sums(at: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Sums of the weights at each of ``n`` places, float64 also where nothing is summed."""
    return np.bincount(at, weight, n).astype(np.float64)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any of the given ranges."""
    change = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(change[:n]) > 0
