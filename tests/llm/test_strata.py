import math
import re
from collections import Counter

import numpy as np
import pytest

from vacantia.llm import strata

DOCS = "doc_id long, text string, rank int, score string, m long"
ITEMS = "item_id long, text string, doc_id int, n string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k=10):
    counted = [(d[0], Counter(terms(d[1]))) for d in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    texts, total = len(counted), sum(n for *_, n in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    for item, text, *_ in items:
        query, found = Counter(terms(text)), []
        for i, c, n in counted:
            m = 100 - 75 + 75 * n * texts // total
            score = sum(
                q * math.floor(1000 * math.log((2 * texts + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 8 * m))
                for w, q in query.items() if w in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, k=10):
    docs, items = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    return sorted(map(tuple, strata.search(strata.build(docs), items, k).collect()), key=repr)


def corpus(n, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    size = np.where(rng.random(n) < 0.4, 12, rng.integers(1, 80, n))
    return [(i, " ".join(words[j] for j in rng.zipf(1.4, s) % 60), 1, "x", 2) for i, s in enumerate(size.tolist())]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_against_brute_force(spark, k):
    docs = corpus(400)
    items = [(i, d[1], 1, "x") for i, d in enumerate(corpus(25, 7))]
    assert got(spark, docs, items, k) == plain(docs, items, k)


@pytest.mark.parametrize("batch,segment,cells,block", [(1, 30, 10, 5), (7, 200, 1 << 21, 1 << 20)])
def test_segments_blocks_and_batches(spark, monkeypatch, batch, segment, cells, block):
    """Strata cut into many segments, items into many blocks, scores into many pieces."""
    monkeypatch.setattr(strata, "SEGMENT_TERMS", segment)
    monkeypatch.setattr(strata, "BROADCAST_STRATA", 2)
    monkeypatch.setattr(strata, "ITEM_BYTES", block * 20)
    docs, items = corpus(120, 3), [(i, d[1], 1, "x") for i, d in enumerate(corpus(6, 5))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert got(spark, docs, items) == plain(docs, items)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pieces_hold_whole_items():
    item, size = np.array([0, 0, 1, 3, 3, 3]), np.array([1, 2, 1 << 22, 1, 1, 1])
    assert list(strata.pieces(item, size, 4)) == [(0, 2), (2, 3), (3, 6)]


def test_skipped_segments_cannot_reach_the_floor(spark):
    """The bound of a segment is never below a score in it, and segments are really skipped."""
    docs = spark.createDataFrame(corpus(300), DOCS)
    index = strata.build(docs)
    rows = index.segments.toArrow().combine_chunks().to_batches()[0]
    items = strata.Items([corpus(300)[5][1]])
    items.weigh(index.texts, {})
    best = strata.Best(1, 1)
    best.floor[:] = 1 << 60
    strata.visit(rows, items, best)
    assert not len(best.item)
    best.floor[:] = 1
    strata.visit(rows, items, best)
    for i in range(rows.num_rows):
        one = strata.Best(1, 1000)
        strata.visit(rows.slice(i, 1), items, one)
        assert not len(one.score) or one.score.max() <= best.score[0]


def test_edge_rows(spark):
    docs = [(d[0], d[1], 1, "x", 2) for d in [
        (1, "a b c"), (2, None), (3, ""), (4, "A  b!c"), (4, "a b c"), (None, "a b c"), (5, "x " * 60_000 + "a"), (6, "ä Ä 日本"),
        (7, "..."), (8, "a"), (8, "a"), (9, "b_c`d[e"),
    ]]
    items = [(1, "A b", 1, "x"), (1, "a a a b", 1, "x"), (None, "c", 1, "x"), (2, None, 1, "x"), (3, "", 1, "x"), (4, "unknown", 1, "x"), (5, "ä 日本 x", 1, "x")]
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, [], items) == got(spark, docs, []) == got(spark, [(1, None, 1, "x", 2)], items) == []
