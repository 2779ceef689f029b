"""Packing into windows of ``WINDOW`` tokens, neighbours found by lexical retrieval.

Texts become token ids of a given tokenizer, closed by ``END``. What fills windows of its own
is cut off; the rest of each document is a piece. Pieces are dealt, as the table is stored, to
shards of about ``SHARD_TOKENS`` tokens, each with a BM25 inverted index over token ids. A
seed opens a window; the unused pieces nearest to it fill it, highest score first, pieces
without a shared token last, and the piece that does not fit whole is cut and seeds the next
window. So every window is full but the last of a shard, which is cut into sequences whose
sizes are powers of two. No id is padding, none is lost.

A shard lies in one task and nothing is shuffled; memory is a small multiple of a part of the
texts and of a shard. Sequence ids hold the number of the task above that of the sequence.

Defined cases: a null or empty text is the id ``END`` alone; a text of any length is cut into
windows; repeated rows are documents of their own; an empty table has no pieces; ids may be null.
Other columns are not looked at.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from vacantia.llm.arrays import LOWER, NOT_SPACE, expand, mix, parts, span_hashes, text_bytes
from vacantia.llm.contamination import member

WINDOW = 2048
END = 1
SHARD_TOKENS = 1 << 18
PART_BYTES = 2 << 20
K1, B = 1.2, 0.75
NUMBER_BITS = 36  # of a sequence id; the number of the task is above

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Units:
    """Ids of texts, put together from those of their units.

    For tokenizers that lower-case, drop white space and never join a word with what is not a
    word: then a text's ids are those of its units, the runs between ASCII white space, cut
    where an ASCII letter or digit meets ASCII punctuation. What special tokens and
    contractions are written with makes no cut, and only units of ASCII without ``<|`` are
    lower-cased beforehand. Each different unit is encoded once; the last ``keep`` stay known.
    """

    def __init__(self, tokenizer: Tokenizer, keep: int = 1 << 19):
        self.tokenizer, self.keep = tokenizer, keep
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def any(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and how many each has."""
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.array([len(e) for e in encoded], np.int64)
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(size.sum())), size

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units of ASCII letters, many in one call: each ends where a word ends."""
        runs = [" ".join(texts[i : i + TOGETHER]) for i in range(0, len(texts), TOGETHER)]
        encoded = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in encoded)])
        end = np.flatnonzero(self.ends[flat]) + 1
        if len(end) != len(texts) or end[-1:].sum() != len(flat):
            return self.any(texts)
        return flat, np.diff(np.r_[0, end])

    def learn(self, key: np.ndarray, texts: list[str], word: bool) -> None:
        flat, size = self.words(texts) if word else self.any(texts)
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.r_[self.ids, flat]
        place = np.searchsorted(self.known, key)  # both in order
        self.known = np.insert(self.known, place, key)
        self.start, self.size = np.insert(self.start, place, start), np.insert(self.size, place, size)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each closed by ``END``, and the offsets."""
        buf, offsets = text_bytes(texts)
        begin, end = unit_spans(buf, offsets)
        low = LOWER[buf]
        plain = np.r_[0, np.cumsum((buf >= 0x80) | ((buf == 0x3C) & (np.r_[buf[1:], 0] == 0x7C)))]
        kept = plain[end] > plain[begin]  # these stay as they are written
        key = span_hashes(low, begin, end)
        key[kept] = mix(span_hashes(buf, begin[kept], end[kept]))
        one, first, of = np.unique(key, return_index=True, return_inverse=True)
        new = ~member(one, self.known)[0]
        if len(self.known) + new.sum() > self.keep:
            self.forget()
            new[:] = True
        letters = np.r_[0, np.cumsum((low >= 0x61) & (low < 0x7B))]
        word = (letters[end] - letters[begin] == end - begin)[first]
        for kind, data in ((True, low), (False, low), (False, buf)):
            some = np.flatnonzero(new & (word == kind) & (kept[first] == (data is buf)))
            if len(some):
                at, whole = first[some], data.tobytes()
                texts = [whole[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist())]
                self.learn(one[some], texts, kind)
        place = np.searchsorted(self.known, one)[of]
        size = self.size[place]
        # END closes each text: after its units, an id of its own.
        bounds = np.searchsorted(begin, offsets)
        total = np.r_[0, np.cumsum(size)][bounds] + np.arange(len(bounds))
        flat, _ = expand(self.start[place], size)
        out = np.full(int(total[-1]), END, np.uint32)
        inside = np.ones(len(out), bool)
        inside[total[1:] - 1] = False
        out[inside] = self.ids[flat]
        return out, total


@lru_cache(maxsize=1)
def units_of(vocabulary: str) -> Units:
    """One per worker process, which runs many tasks; what it knows changes no result."""
    return Units(Tokenizer.from_file(vocabulary))


TOGETHER = 1000  # units encoded in one call
WORD_END = "</w>"  # closes the last token of a word in the vocabulary
_CLASS = np.zeros(256, np.uint8)  # 0 white space, 1 no cut on this side, 2 letter or digit, 3 punctuation
_CLASS[NOT_SPACE] = 1
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = _CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 2
_CLASS[[0x27, 0x3C, 0x3E, 0x7C]] = 1


def unit_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = _CLASS[buf]
    edge = np.ones(len(buf) + 1, bool)
    edge[1:-1] = ((kind[1:] == 0) != (kind[:-1] == 0)) | ((kind[1:] ^ kind[:-1]) == 1) & (kind[1:] >= 2) & (kind[:-1] >= 2)
    edge[offsets] = True
    at = np.flatnonzero(edge)
    if len(at) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = kind[at[:-1]] > 0
    return at[:-1][word], at[1:][word]


class Neighbours:
    """BM25 inverted index of the pieces of a shard, over token ids."""

    def __init__(self, ids: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        size = np.diff(at)
        piece = np.repeat(np.arange(n), size)
        vocabulary, term = np.unique(ids, return_inverse=True)
        key, tf = np.unique(piece * len(vocabulary) + term, return_counts=True)
        self.piece, self.term = np.divmod(key, len(vocabulary))
        self.of = np.searchsorted(self.piece, np.arange(n + 1))
        df = np.bincount(self.term, minlength=len(vocabulary))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        idf[vocabulary == END] = 0.0
        share = idf[self.term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.piece] / size.mean()))
        order = np.argsort(self.term, kind="stable")
        self.posting, self.share = self.piece[order], share[order]
        self.start, self.count, self.n = np.cumsum(df) - df, df, n
        self.useful = idf > 0

    def scores(self, seed: int) -> np.ndarray:
        """Score of every piece, the terms of ``seed`` as the query."""
        terms = self.term[self.of[seed] : self.of[seed + 1]]
        terms = terms[self.useful[terms]]
        place, _ = expand(self.start[terms], self.count[terms])
        return np.bincount(self.posting[place], self.share[place], self.n)


def windows(ids: np.ndarray, at: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of each sequence in order: numbers, first token and length of each.

    Every sequence but those made of the last, not full, window has ``window`` tokens.
    """
    index = Neighbours(ids, at)
    left = np.diff(at)
    done = np.zeros(index.n, np.int64)
    seed, following = 0, 1
    while True:
        score = index.scores(seed)
        open_ = np.flatnonzero(left > 0)
        open_ = open_[open_ != seed]
        order = np.r_[seed, open_[np.argsort(-score[open_], kind="stable")]]
        upto = np.cumsum(left[order])
        last = int(np.searchsorted(upto, window))
        used = order[: last + 1]
        length = left[used]
        if last < len(used):
            length[-1] -= upto[last] - window
        yield used, done[used], length
        done[used] += length
        left[used] -= length
        if last >= len(order):
            return
        if left[used[-1]]:
            seed = int(used[-1])
            continue
        while following < index.n and not left[following]:
            following += 1
        if following == index.n:
            return
        seed = following


def power_sizes(n: int) -> list[int]:
    """Falling powers of two that make up ``n``."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cut(used: np.ndarray, first: np.ndarray, length: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, ...]:
    """Cuts the pieces of one run of tokens into sequences of the given sizes.

    Piece, first token, length, number of the sequence and offset in it of each new piece.
    """
    end = np.cumsum(length)
    edge = np.sort(np.r_[0, end, np.cumsum(sizes)])
    edge = edge[np.r_[True, edge[1:] != edge[:-1]]]
    begin, size = edge[:-1], np.diff(edge)
    which = np.searchsorted(end, begin, "right")
    sequence = np.searchsorted(np.cumsum(sizes), begin, "right")
    offset = begin - (np.cumsum(sizes) - sizes)[sequence]
    return used[which], first[which] + begin - (end - length)[which], size, sequence, offset


class Shard:
    """Pieces waiting to be packed together."""

    def __init__(self):
        self.ids, self.doc, self.start, self.total, self.tokens = [], [], [], [], 0

    def add(self, ids: np.ndarray, doc: np.ndarray, start: np.ndarray, total: np.ndarray) -> None:
        self.ids.append(ids)
        self.doc.append(doc)
        self.start.append(start)
        self.total.append(total)
        self.tokens += len(ids)


def packed(shard: Shard, window: int, number: int) -> tuple[list, int]:
    """Columns of the pieces of a shard, and the next free sequence number."""
    ids, doc = np.concatenate(shard.ids), np.concatenate(shard.doc)
    start, total = np.concatenate(shard.start), np.concatenate(shard.total)
    size = np.minimum(total - start, window)
    at = np.r_[0, np.cumsum(size)]
    out = []
    for used, first, length in windows(ids, at, window):
        sizes = [window] if length.sum() == window else power_sizes(int(length.sum()))
        piece, token, long, sequence, offset = cut(used, first, length, sizes)
        out.append((piece, token, long, number + sequence, offset))
        number += len(sizes)
    piece, token, long, sequence, offset = map(np.concatenate, zip(*out))
    place, _ = expand(at[piece] + token, long)
    return [doc[piece], start[piece] + token, long, ids[place], total[piece], sequence, offset], number


def pack(docs: DataFrame, vocabulary: str, *, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece with its ``ids`` (little-endian 32-bit); ``window`` is a power of two.

    ``vocabulary`` is the file of a tokenizer as `Units` needs it, at that path on every
    executor.
    """
    def rows(columns: list, task: int) -> pa.RecordBatch:
        doc, start, length, ids, total, sequence, offset = columns
        places = np.r_[0, np.cumsum(length)] * 4
        blob = pa.Array.from_buffers(
            pa.large_binary(), len(length),
            [None, pa.py_buffer(places.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())],
        ).cast(pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), blob,
                pa.array(total, pa.int64()), pa.array(sequence + (task << NUMBER_BITS), pa.int64()), pa.array(offset, pa.int64()),
            ],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def run(batches):
        units = units_of(vocabulary)
        task, number, shard = TaskContext.get().partitionId(), 0, Shard()
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                ids, at = units.encode(part.column("text"))
                total = np.diff(at)
                whole = total // window
                text, nth = np.repeat(np.arange(len(total)), whole), expand(np.zeros(len(whole), np.int64), whole)[0]
                doc = np.array(part.column("doc_id").to_pylist(), object)
                if len(text):
                    place, _ = expand(at[text] + nth * window, np.full(len(text), window))
                    columns = [
                        doc[text], nth * window, np.full(len(text), window), ids[place], total[text],
                        number + np.arange(len(text)), np.zeros(len(text), np.int64),
                    ]
                    yield rows(columns, task)
                    number += len(text)
                rest = np.flatnonzero(total % window)
                size = total[rest] % window
                upto = np.cumsum(size)
                done = 0
                while done < len(rest):  # pieces go to the open shard until it is full
                    room = (upto[done - 1] if done else 0) + shard_tokens - shard.tokens
                    stop = max(done + 1, int(np.searchsorted(upto, room, "right")))
                    some = rest[done:stop]
                    place, _ = expand(at[some + 1] - size[done:stop], size[done:stop])
                    shard.add(ids[place], doc[some], (whole * window)[some], total[some])
                    done = stop
                    if shard.tokens >= shard_tokens or done < len(rest):
                        columns, number = packed(shard, window, number)
                        yield rows(columns, task)
                        shard = Shard()
        if shard.tokens:
            columns, number = packed(shard, window, number)
            yield rows(columns, task)

    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, PIECE)
