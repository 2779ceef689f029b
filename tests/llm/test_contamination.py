import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from vacantia.llm import arrays, contamination as C

DOCS = "doc_id long, text string, n_words string, items int"
ITEMS = "item_id long, text string, doc_id long"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(items):
    out = {}
    for item_id, text, *_ in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            out.setdefault(tuple(w[i : i + 13]), set()).add(item_id)
    return out


def plain(docs, items):
    known = windows(items)
    sizes = {len(k) for k in known}
    out = []
    for doc_id, text, *_ in docs:
        w, hit, ids = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := known.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= found
        ids = sorted(str(i) for i in ids - {None})
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def fixture():
    rng = np.random.default_rng(4)
    word = lambda: rng.choice(["the", "of", "Été", "a1", "x", "über"]) + str(rng.integers(0, 40))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(int(n)), 0) for i, n in enumerate(rng.integers(1, 60, 40))]
    items += [(50, None, 0), (51, " .!", 0), (None, text(20), 0), (52, items[3][1], 0), (3, items[3][1], 0), (53, "x " * 400, 0)]
    docs = []
    for i in range(120):
        src = items[int(rng.integers(0, 40))][1]
        part = src if i % 3 else " ".join(src.split()[:12])
        docs.append((i, f"{text(int(rng.integers(0, 200)))} {part.upper().replace('É', 'é')}, {text(30)}"))
    docs += [(200, None), (201, ""), (None, items[0][1]), (5, items[5][1]), (5, items[5][1]), (202, "x " * 3000)]
    docs += [(203, text(40_000) + " " + items[7][1]), (204, items[42][1]), (205, " ".join(t for _, t, _ in items if t))]
    return [(*d, "clash", 1) for d in docs], items


def order(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 600, "shard_bytes": 5000}])
def test_verdicts_against_brute_force(spark, limits):
    docs, items = fixture()
    if limits:
        docs = docs[::4] + docs[120:]
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = C.contamination(df, bench, **limits)
    want = plain(docs, items)
    assert order(got.drop("spans", "items").collect()) == order(want)
    assert 0 < sum(w[5] for w in want) < len(want)
    if not limits:
        kept = C.decontaminate(df, bench)
        assert kept.columns == df.columns
        assert order(kept.collect()) == order(d for d, w in zip(docs, want) if not w[5])
        assert C.contamination(df.limit(0), bench).collect() == []
        none = C.contamination(df, bench.limit(0)).collect()
        assert {(r["n_hit"], r["contaminated"]) for r in none} == {(0, False)}


def test_longest_matches(spark):
    docs, items = fixture()
    docs = docs[::6] + docs[123:125]
    got = {
        (r["item_id"], r["item_word"]): (r["n_words"], r["doc_id"], r["doc_word"])
        for r in C.longest_matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items[:40], ITEMS), shard_bytes=4000).collect()
    }
    texts = [(d[0], words(d[1])) for d in docs]
    want = {}
    for item_id, text, *_ in items[:40]:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            best = 0
            for _, d in texts:
                for j in range(len(d)):
                    n = 0
                    while i + n < len(w) and j + n < len(d) and w[i + n] == d[j + n]:
                        n += 1
                    best = max(best, n)
            if best >= min(13, len(w) - i):
                want[str(item_id), i] = best
    assert {k: v[0] for k, v in got.items()} == want
    by = {}
    for d, w in texts:
        by.setdefault(d, []).append(w)
    for (item_id, i), (n, doc_id, at) in got.items():
        w = words(items[int(item_id)][1])
        assert any(d[at : at + n] == w[i : i + n] for d in by[doc_id])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aB9é漢 \t\n.", max_size=40), max_size=8))
def test_words_of_batches(texts):
    column = pa.array([*texts, None], pa.string())
    w = C.lower_words(column)
    got = [[] for _ in range(len(texts) + 1)]
    for t, a, b in zip(w.text, w.start, w.end):
        got[t].append(w.buf[a:b].tobytes().decode())
    assert got == [*map(words, texts), []]
    flat = [x for t in got for x in t]
    assert len(set(w.hash.tolist())) == len(set(flat))
    assert [len(g) for g in got] == w.counts().tolist()


@given(st.lists(st.binary(min_size=1, max_size=40), max_size=20))
def test_hashes_depend_on_content_alone(spans):
    one = np.frombuffer(b"".join(spans), np.uint8)
    two = np.frombuffer(b"-".join([b"", *spans]), np.uint8)
    at = np.cumsum([0, *map(len, spans)])
    start = at[:-1] + np.arange(1, len(spans) + 1)
    a = arrays.span_hashes(one, at[:-1], at[1:])
    b = arrays.span_hashes(two, start, start + np.diff(at))
    assert a.tolist() == b.tolist() and len(set(a.tolist())) == len(set(spans))
