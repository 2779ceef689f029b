"""Substring dedup by words: repeated-phrase automata.

``passages`` confirms which windows of 13 words start in two documents or more, and the
smallest document id of each. Every chunk then makes phrases of its confirmed windows
(neighbouring windows with one smallest document are one phrase), compiles them into an
Aho-Corasick automaton over word numbers, its shard of all phrases, and streams all its
documents through it to locate every occurrence.

Defined cases: a null or empty text has no words; phrases never cross documents; the
windows are judged on the input; of documents with one phrase the one with the smallest id
keeps it, rows that share that id all do, and repeats inside it stay; rows without an id
rank after all others and are equals among themselves. No row, window or occurrence is
left out.
"""

import hashlib
from dataclasses import replace

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacantia.llm import passages
from vacantia.llm.arrays import NOT_SPACE, Words, covered, expand, text_bytes

WINDOW = 13
GRAM = 4
_NO_ID = np.iinfo(np.int64).max


class _Texts(passages.Chunk):
    def __init__(self, docs: pa.Table, step: int):
        self.words = words = Words(*text_bytes(docs.column("text")), NOT_SPACE)
        self.rank = np.asarray(docs.column("doc_id").combine_chunks().fill_null(_NO_ID))
        found = passages.segments(words.hash, words.left(), WINDOW, GRAM, step)
        super().__init__(found, self.rank[words.text[found.start]])

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with one space behind each, and where each begins."""
        w = self.words
        at = np.r_[0, np.cumsum(w.end - w.start + 1)]
        out = np.full(int(at[-1]), 0x20, np.uint8)
        place, which = expand(w.start, w.end - w.start)
        out[place - w.start[which] + at[:-1][which]] = w.buf[place]
        return out.tobytes(), at


def _content(chunk: _Texts, start: np.ndarray, windows: np.ndarray) -> list[bytes]:
    data, at = chunk.joined()
    return [data[at[a] : at[a + n + WINDOW - 1] - 1] for a, n in zip(start.tolist(), windows.tolist())]


def confirm(content: list[bytes], many: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """Runs of windows of each piece that occur in two documents: piece, first, last, least.

    Windows are compared by their words. ``low`` and ``high`` are the smallest and the
    largest id of the documents with a piece.
    """
    least: dict[bytes, int] = {}
    most: dict[bytes, int] = {}
    windows = []
    for text, a, b in zip(content, low.tolist(), high.tolist()):
        words = text.split(b" ")
        own = [b" ".join(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
        windows.append(own)
        for w in own:
            if a < least.get(w, _NO_ID + 1):
                least[w] = a
            if b > most.get(w, -_NO_ID - 2):
                most[w] = b
    runs = []
    for i, own in enumerate(windows):
        begin = None
        for j, w in enumerate([*own, None]):
            rank = least[w] if w is not None and least[w] < most[w] else None
            if begin is not None and rank != begin[1]:
                runs.append((i, begin[0], j - 1, begin[1]))
                begin = None
            if begin is None and rank is not None:
                begin = (j, rank)
    out = np.array(runs, np.int64).reshape(-1, 4)
    return out[:, 0], out[:, 1], out[:, 2], out[:, 3]


SEARCH = passages.Search(WINDOW, _Texts, _content, confirm, by_document=True)


def _occurrences(chunk: _Texts, first, last, least) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every occurrence of a phrase in a document after its least one."""
    words = chunk.words
    # Number the chunk's words, so that automaton and documents are made of small integers.
    _, number = np.unique(words.hash, return_inverse=True)
    number = number.ravel().tolist()
    # Only what a document loses is a phrase here, and windows that follow one another in a
    # document with one least id are one phrase.
    use = np.flatnonzero(chunk.rank[words.text[first]] > least)
    use = use[np.argsort(first[use], kind="stable")]
    first, last, least = first[use], last[use], least[use]
    new = np.ones(len(use), bool)
    text = words.text[first]
    new[1:] = (first[1:] != last[:-1] + 1) | (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    first, last, least = first[begin], last[np.r_[begin[1:], len(use)] - 1] if len(use) else last, least[begin]
    phrases: dict[tuple, int] = {}
    for a, b, rank in zip(first.tolist(), last.tolist(), least.tolist()):
        phrase = tuple(number[a : b + WINDOW])
        phrases[phrase] = min(rank, phrases.get(phrase, rank))
    if not phrases:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase, rank in phrases.items():
        automaton.add_word(phrase, (len(phrase), rank))
    automaton.make_automaton()
    starts, ends = [], []
    bounds = words.bounds.tolist()
    for t, rank in enumerate(chunk.rank.tolist()):
        a, b = bounds[t], bounds[t + 1]
        if b - a < WINDOW:
            continue
        for end, (size, first_rank) in automaton.iter(tuple(number[a:b])):
            if first_rank < rank:
                starts.append(a + end + 1 - size)
                ends.append(a + end + 1)
    return np.array(starts, np.int64), np.array(ends, np.int64)


def _finish(with_text: bool):
    def finish(docs: pa.Table, chunk: _Texts, first, last, least) -> pa.Table:
        words = chunk.words
        removed = covered(len(words.start), *_occurrences(chunk, first, last, least))
        data, at = chunk.joined()
        keep = np.flatnonzero(~removed)
        bounds = np.searchsorted(keep, words.bounds)
        kept = np.frombuffer(data, np.uint8)[np.repeat(~removed, np.diff(at))].tobytes()
        kept_at = np.r_[0, np.cumsum(np.diff(at)[keep])]
        texts = [
            kept[kept_at[a] : max(kept_at[a], kept_at[b] - 1)]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
        ]
        n = words.counts()
        out = {
            "doc_id": docs.column("doc_id"), "n_words": pa.array(n), "n_removed": pa.array(n - np.diff(bounds)),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        }
        if with_text:
            out["kept"] = pa.array(texts, pa.binary())
        return pa.table(out)

    return finish


def remove_phrases(
    docs: DataFrame, *, with_text: bool = False, chunk_bytes: int = passages.CHUNK_BYTES,
    heavy: int = passages.HEAVY, step: int = passages.STEP,
) -> DataFrame:
    """One row per document: words, removed words, hash of the words that stay (and these)."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return passages.search(
        docs, replace(SEARCH, heavy=heavy, step=step), _finish(with_text),
        schema + ", kept binary" * with_text, chunk_bytes,
    )
