import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from vacantia.llm import jaccard, pairs

SCHEMA = "doc_id long, text string, class_id string"


def shingle_set(text, k=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(rows):
    sets = [shingle_set(r[1]) if r[0] is not None else set() for r in rows]
    links = [
        [j for j, y in enumerate(sets) if j != i and x and y and 5 * len(x & y) >= 4 * len(x | y)]
        for i, x in enumerate(sets)
    ]
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        same = [rows[j][0] for j in seen if sets[j] == sets[i]] if sets[i] else [doc_id]
        out.append((doc_id, min(same, default=None) if doc_id is not None else None, len(links[i]),
                    min(rows[j][0] for j in seen) if doc_id is not None else None))
    return sorted(map(repr, out))


def fixture():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgé"), 5))
    rows, next_id = [], 10
    for size in (60, 200, 30):
        base = [word() for _ in range(size)]
        for changes in [0, 0, 0, *range(1, 12)]:
            text = list(base)
            for at in rng.integers(0, size, changes):
                text[at] = word()
            rows.append((next_id, " ".join(text)))
            next_id += 1
    base = [word() for _ in range(150)]
    for i in range(90):  # a group of near copies larger than the blocks of the test
        text = list(base)
        text[int(rng.integers(0, 150))] = word()
        rows.append((next_id + i, " ".join(text)))
    rows += [
        (1, None), (2, ""), (3, " .,\n"), (4, "One two"), (5, "one, TWO!"), (6, "two one"), (None, rows[0][1]),
        (7, rows[0][1].upper().replace("É", "é")), (8, "x " * 20_000), (9, "x " * 30_000), (8, "x " * 20_000),
        (500, " ".join(word() for _ in range(50_000))),
    ]
    return [(*r, "clash") for r in rows]


@pytest.mark.parametrize("limits", [{}, {"block": 16, "set_block": 8}])
def test_join_against_brute_force(spark, limits):
    rows = fixture()
    got = jaccard.similar(spark.createDataFrame(rows, SCHEMA), **limits).collect()
    assert sorted(map(repr, map(tuple, got))) == plain(rows)


def test_one_document_of_each_group_stays(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    first = {eval(x)[0]: eval(x)[3] for x in plain(rows)}
    want = [r for r in dict.fromkeys(rows) if first[r[0]] == r[0]]  # of equal rows one stays
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))
    assert jaccard.similar(df.limit(0)).collect() == []


@pytest.mark.parametrize("limits", [{}, {"block": 4, "set_block": 2}])
def test_ids_with_several_texts(spark, limits):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [
        (3, a), (7, a), (7, b), (9, b + " more"), (7, b), (7, a + " more"), (2, c), (2, c), (2, c + " more"), (2, None),
        (2, ""), (11, b + " more"), (None, a), (None, a), (12, "alone"),
    ]
    rows = [(*r, "clash") for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    got = jaccard.similar(df, **limits).collect()
    assert sorted(map(repr, map(tuple, got))) == plain(rows)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one(df, **limits).collect()]
    of_two = [x for x in kept if x[0] == 2 and x[1]]
    assert len(of_two) == 1 and of_two[0][1] in (c, c + " more")
    rest = [x for x in kept if x not in of_two]
    want = [(3, a), (7, b), (2, None), (2, ""), (None, a), (None, a), (12, "alone")]
    assert sorted(map(repr, rest)) == sorted(map(repr, want))


def test_groups_larger_than_a_block_are_dealt_by_pairs_of_blocks(spark):
    rows = spark.range(0, 20_000).select(F.lit(5).cast("long").alias("key"), F.col("id").alias("member"))
    small = spark.range(0, 300).select((F.col("id") % 100 + 10).alias("key"), (F.col("id") + 50_000).alias("member"))
    met = pairs.spread(rows.unionAll(small), "key", "member", block=256, tasks=3, own_pairs=True)
    sizes = met.groupBy("task").agg(F.count("*").alias("n"), F.countDistinct("key", "low", "high").alias("k")).collect()
    blocks = -(-20_000 // 256)
    large = [r for r in sizes if r["task"] < 0]
    assert len(large) == blocks * (blocks + 1) // 2 and {r["k"] for r in large} == {1}
    assert max(r["n"] for r in large) <= 2 * 256 * 1.4
    assert sum(r["n"] for r in sizes if r["task"] >= 0) == 300 and sum(r["n"] for r in large) == 20_000 * blocks


def test_pruning_keeps_pairs_at_the_threshold():
    n = jaccard.BANDS * jaccard.PER_BAND
    enough = jaccard.least_matches(n, jaccard.STEP, 0.8, jaccard.EPSILON)
    rng = np.random.default_rng(0)
    agree = np.cumsum(rng.random((20_000, n)) < 0.8, axis=1)[:, jaccard.STEP - 1 :: jaccard.STEP]
    assert (agree >= enough).all(axis=1).mean() > 0.99
    unlike = np.cumsum(rng.random((20_000, n)) < 0.4, axis=1)[:, jaccard.STEP - 1 :: jaccard.STEP]
    assert (unlike >= enough).all(axis=1).mean() < 0.01


def test_overlaps_of_sets():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert jaccard.overlaps(sets).tolist() == want
    assert jaccard.overlaps(sets[:2]).tolist() == [w[:2] for w in want[:2]]
