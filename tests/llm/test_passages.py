import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from vacantia.llm import phrases, queries, suffixes
from vacantia.llm.arrays import text_bytes


def plain_bytes(rows, length=200):
    count = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for doc_id, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def plain_words(rows, window=13):
    rank = lambda i: (i is None, i or 0)
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            least[key] = min(least.get(key, rank(i)), rank(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if least[tuple(w[j : j + window])] < rank(i):
                gone[j : j + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def same(df, want):
    order = lambda rows: sorted(map(repr, map(tuple, rows)))
    got = df.collect()
    assert order(got) == order(want)
    return got


@pytest.mark.parametrize("query,plain", [("op4_substring_dedup", plain_bytes), ("op10_repeated_phrases", plain_words)])
def test_query_on_documents(spark, query, plain):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = same(queries.QUERIES[query](spark, folder), plain(docs))
    assert sum(r["n_removed"] for r in got) > 0


def edge_rows():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdé"), rng.integers(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, other = text(60), text(40)
    rows = [(i, f"{text(20)} {shared} {text(30)}") for i in range(12)]
    rows += [(100 + i, f"{text(9)}\n{other[: 150 + 10 * i]} {text(9)}") for i in range(12)]
    rows += [(None, None), (None, shared), (None, shared), (7, None), (8, ""), (9, " \n "), (9, shared), (9, shared)]
    rows += [(200, "a" * 3000), (201, "ab " * 900), (202, "\x00" * 250), (203, "\x00" * 199 + "x")]
    rows += [(300, text(30_000) + " " + other), (301, (shared + " ") * 3)]
    return rows


# Small limits make several chunks, overlapping steps and split anchors.
@pytest.mark.parametrize("limits", [{}, {"heavy": 3, "chunk_bytes": 20_000, "step": 700}])
def test_edge_rows(spark, limits):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_words int, chunk string")
    same(suffixes.remove_repeats(df, **limits), plain_bytes(rows))
    same(phrases.remove_phrases(df, **limits), plain_words(rows))
    kept = phrases.remove_phrases(df, with_text=True).filter("n_words = 0").first()
    assert bytes(kept["kept"]) == b""
    assert suffixes.remove_repeats(df.limit(0)).collect() == []
    assert phrases.remove_phrases(df.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(x % 3 for x in b)), max_size=6))
def test_two_stage_order(strings):
    data, offsets = text_bytes(pa.array(strings, pa.large_binary()))
    order = suffixes.two_stage(data, offsets, 64)
    stop = np.repeat(offsets[1:], np.diff(offsets))
    suffix = [bytes(data[i : stop[i]]) for i in order]
    assert sorted(order.tolist()) == list(range(len(data))) and suffix == sorted(suffix)
    a, b = order[:-1], order[1:]
    if len(a):
        lcp = suffixes.common_prefix(suffixes.Packed(data), a, b, stop[a], stop[b], 64)
        for x, y, n in zip(suffix, suffix[1:], lcp.tolist()):
            assert x[:n] == y[:n] and (n == min(len(x), len(y)) or x[n] != y[n])


def test_copies_are_not_sorted_again_at_every_step(monkeypatch):
    one = bytes(np.random.default_rng(1).integers(97, 123, 400, dtype=np.uint8))
    other = one[:300] + b"\0" + one[301:]
    data, offsets = text_bytes(pa.array([one, other, one[:399], other + b"\0"], pa.large_binary()))
    stop = np.repeat(offsets[1:], np.diff(offsets))
    sorted_rows, usual = [], suffixes._order
    monkeypatch.setattr(suffixes, "_order", lambda g, k, n: sorted_rows.append(len(g)) or usual(g, k, n))
    found = suffixes.sort_directly(suffixes.Packed(data), np.arange(len(data)), stop, 408)
    text = data.tobytes()
    suffix = [text[i : stop[i]] for i in found.tolist()]
    assert suffix == sorted(suffix)
    # Nearly all stay in groups of four or two for many steps; few of these steps tell members apart.
    assert sum(sorted_rows) < 4 * len(data)


@pytest.mark.parametrize("step", ["entries", "finish"])
def test_a_chunk_of_substring_dedup_is_held_in_few_bytes(step):
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, 40_000, np.uint8)).decode() for _ in range(100)]
    docs = pa.table({"doc_id": pa.array(range(101), pa.int64()), "text": [*texts, texts[0]]})
    told = suffixes.SEARCH.replies(suffixes.SEARCH.entries(0, docs, 1))
    tracemalloc.start()
    if step == "entries":
        suffixes.SEARCH.entries(0, docs, 1)
    else:
        suffixes._finish(False)(docs, *suffixes.SEARCH.marked(docs, told))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * 4_040_000


def test_ranges_join_inside_a_document_only():
    first, end = suffixes._maximal(np.array([12, 0, 5, 10, 3]), np.array([15, 4, 10, 12, 5]), np.array([0, 10, 10, 20]))
    assert (first.tolist(), end.tolist()) == ([0, 10], [10, 15])
    first, end = suffixes._maximal(np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([0, 0]))
    assert len(first) == len(end) == 0


def test_a_bucket_of_pieces_is_compared_in_few_bytes():
    rng = np.random.default_rng(6)
    data = bytes(rng.integers(97, 101, 100_000, np.uint8))
    pieces = [data[a : a + 300] for a in rng.integers(0, 99_700, 3_000).tolist()]
    tracemalloc.start()
    suffixes.repeats(pieces, np.zeros(3_000, bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90 * 900_000
