import numpy as np
import pytest

from vacantia.llm import embeddings, pairs

SCHEMA = "vec_id long, embedding array<double>, label int, component string"


def plain(rows, least=0.98):
    good = {}
    for k, (i, v, label, *_) in enumerate(rows):
        if i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            good[k] = (label, x / np.sqrt(x @ x))
    links = {k: [] for k in good}
    for a, (la, x) in good.items():
        for b, (lb, y) in good.items():
            if a < b and la == lb and len(x) == len(y) and x @ y >= least:
                links[a].append(b)
                links[b].append(a)
    out = []
    for k, row in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        first = None if row[0] is None else min(rows[j][0] for j in seen)
        out.append((row[0], len(links.get(k, [])), first, row[0] is None or row[0] == first))
    return out


def order(rows):
    return sorted(map(repr, rows))


def clusters(seed, n, spread, size=9):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, size))
    out = []
    for i in range(n):
        v = centres[i % 6] + spread * rng.standard_normal(size)
        out.append((i * 3, v.tolist(), int(i % 6 > 3), "x"))
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_links_and_components_against_brute_force(spark, block):
    rows = clusters(3, 150, 0.06) + clusters(4, 40, 0.0)[:30]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    want = plain(rows)
    found, there = sum(r[1] for r in got), sum(w[1] for w in want)
    assert there > 500 and found >= 0.999 * there
    assert order(map(tuple, got)) == order(want)


def test_edge_rows(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [
        (5, v, 1, "a"), (4, v, 1, "a"), (3, v, 2, "a"), (2, v, None, "a"), (1, None, 1, "a"), (6, [], 1, "a"),
        (7, [0.0, 0.0, 0.0], 1, "a"), (8, [0.0, -0.0, 0.0], 1, "a"), (9, [1.0, None, 3.0], 1, "a"),
        (10, [1.0, nan, 3.0], 1, "a"), (11, [inf, 2.0, 3.0], 1, "a"), (12, [2.0, 4.0, 6.0], 1, "a"),
        (13, [1e300, 2e300, 3e300], 1, "a"), (14, [1e-300, 2e-300, 3e-300], 1, "a"), (15, [1.0, 2.0], 1, "a"),
        (None, v, 1, "a"), (16, [-1.0, -2.0, -3.0], 1, "a"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert order(map(tuple, embeddings.near_duplicates(df).collect())) == order(plain(rows))
    twice = embeddings.near_duplicates(df.filter("vec_id = 5").union(df.filter("vec_id = 5"))).collect()
    assert [tuple(r) for r in twice] == [(5, 1, 5, True)] * 2
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("sizes", [(2, 4), (3, 8)])
def test_near_groups_of_different_lengths(spark, sizes):
    rows = []
    for k, size in enumerate(sizes):
        rows += [(1000 * k + i, v, 1, "x") for i, v, *_ in clusters(5 + k, 40, 0.02, size)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert order(map(tuple, got)) == order(plain(rows))
    assert {r[0] // 1000 for r in got if r[1]} == {0, 1}


def test_tables_find_pairs_at_the_threshold():
    per_table, tables = embeddings.table_shape(100_000, 0.98, 2.0, 1e-5)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.standard_normal((400, 32))
    y -= (x * y).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    near = 0.98 * x + np.sqrt(1 - 0.98**2) * y
    a, b = (embeddings.keys(m, 11, tables, per_table, 2.0) for m in (x, near))
    assert (a == b).any(axis=1).all()
    share = (a == b).mean()
    assert abs(share - embeddings.agree(0.98, 2.0) ** per_table) < 0.05


@pytest.mark.parametrize("size", [1, 2, 50])
def test_components_of_paths_and_stars(spark, size):
    edges = [(i, i + 1) for i in range(100, 100 + size)] + [(7, 1000 + i) for i in range(size)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {i: 100 for i in range(100, 101 + size)} | {7: 7} | {1000 + i: 7 for i in range(size)}
    assert dict(map(tuple, pairs.components(df).collect())) == want
