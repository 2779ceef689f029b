import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from vacantia.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    """Trie of the rebuilt conversations by dictionaries."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, turn_key(role, text), role, text))
    whole = {}
    for c, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(t[3:] for t in sorted(own.get(c - c % 5, []))[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        cost = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in m if whole[c] == p).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def nodes(df, **sizes):
    found = prefixes.trie(prefixes.rebuilt(df), **sizes)
    assert found.columns == NAMES
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1], r[2] or 0))


def drawn(seed, n):
    """Few different turns, so that prefixes are shared; a third of all conversations are one."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        size = rng.randrange(0, 14)
        words = [rng.choice("ab") for _ in range(size)] if rng.random() < 0.66 else ["same"] * 9
        rows += [(c, t, "user", w * 3, "x", 1) for t, w in enumerate(words)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"cells": 1, "range_turns": 40}, {"cells": 60, "range_turns": 300}, {"cells": 200}])
def test_against_brute_force(spark, sizes):
    rows = drawn(4, 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert nodes(df, **sizes) == sorted(plain(rows), key=lambda r: (r[0], r[1], r[2] or 0))


@pytest.mark.parametrize("sizes", [{}, {"cells": 3, "range_turns": 5}])
def test_edge_rows(spark, sizes):
    rows = [
        (1, None, "user", "a", "x", 1), (1, 0, None, None, "x", 1), (1, 0, "", "", "x", 1), (1, 5, "u", "late", "x", 1),
        (2, 3, "user", "é" * 50_000, "x", 1), (2, 3, "user", "é" * 50_000, "x", 1), (None, 0, "user", "lost", "x", 1),
        (5, 0, "user", "head", "x", 1), (6, 0, "user", "own", "x", 1), (7, -4, "a", "b", "x", 1), (7, -4, "ab", "", "x", 1),
        (10, 1, "user", "head", "x", 1), *[(11, t, "r", str(t % 3), "x", 1) for t in range(300)], (12, 1, "u", "", "x", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(df, **sizes) == sorted(plain(rows), key=lambda r: (r[0], r[1], r[2] or 0))
    assert nodes(df.limit(0), **sizes) == []
    assert nodes(df.filter("conv_id IS NULL"), **sizes) == []


def test_only_turnless_conversations(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 9 > 1 and c % 5)
    rows = [(c, 0, "user", "a", "x", 1)]
    got = nodes(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_one_batch_per_row(spark):
    rows = drawn(9, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert nodes(df) == sorted(plain(rows), key=lambda r: (r[0], r[1], r[2] or 0))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
