"""Comparing the members of groups in tasks of bounded size, and joining links to components.

Groups may be of any size. One with more members (or bytes) than a block holds is cut into
blocks, and every two blocks meet in a task; only links, sums and one edge per member leave
a task, never all pairs.
"""

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.arrays import expand
from vacantia.session import cut_lineage

PAIRS = 1 << 19  # pairs compared at a time


def spread(
    rows: DataFrame, key: str, member: str, *, block: int, tasks: int, own_pairs: bool,
    size: Column | None = None, block_bytes: int = 16 << 20, part: str | None = None,
) -> DataFrame:
    """``rows`` of groups with two members or more, dealt to tasks by pairs of blocks.

    With ``part``, only groups whose rows differ in that column.

    Adds ``task``, ``low`` and ``high`` (the blocks that meet) and ``own`` (the block of the
    row). With ``own_pairs`` a block also meets itself; otherwise only in a group of one
    block, and whoever compares two blocks compares their members among themselves as well.

    ``tasks`` is for groups of one block, which stay as many rows as they are; a group of more
    adds a task of at most two blocks for every two of its blocks, however many these are.
    """
    size = F.lit(0) if size is None else size
    groups = (
        rows.groupBy(key)
        .agg(
            F.count("*").alias("__n"), F.sum(size).alias("__bytes"),
            F.min(part or key).alias("__low"), F.max(part or key).alias("__high"),
        )
        .filter("__low <> __high" if part else "__n > 1")
    )
    blocks = F.ceil(F.greatest(F.col("__n") / block, F.col("__bytes") / block_bytes)).cast("int")
    out = rows.join(groups.select(key, F.greatest(blocks, F.lit(1)).alias("__blocks")), key)
    out = out.withColumn("own", F.pmod(F.xxhash64(member, F.lit(7)), F.col("__blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("__blocks") - 1)
    if not own_pairs:
        others = F.filter(others, lambda o: (o != F.col("own")) | (F.col("__blocks") == 1))
    out = out.withColumn("__other", F.explode(others)).withColumns(
        {"low": F.least("own", "__other"), "high": F.greatest("own", "__other")}
    )
    # Groups of one block share the tasks; every two blocks of a larger one have their own.
    few = F.pmod(F.xxhash64(key), F.lit(tasks).cast("long"))
    task = F.when(F.col("__blocks") == 1, few).otherwise(-1 - F.shiftrightunsigned(F.xxhash64(key, "low", "high"), 1))
    return out.withColumn("task", task).drop("__blocks", "__other")


def runs(*keys: np.ndarray, then: tuple[np.ndarray, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that brings equal keys together, and start and size of each run in it.

    Rows of a run are in the order of ``then``.
    """
    order = np.lexsort((*then[::-1], *keys[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    start = np.flatnonzero(new)
    return order, start, np.diff(np.r_[start, len(order)])


def batches(start: np.ndarray, count: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
    """Pairs of each ``own`` row with the rows in its range, some at a time."""
    total = np.cumsum(count)
    a = 0
    while a < len(own):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")))
        other, which = expand(start[a:b], count[a:b])
        yield own[a:b][which], other
        a = b


def star_links(
    start: np.ndarray, count: np.ndarray, test: Callable, part: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked within each run of rows.

    Rows of one ``part`` are connected already: they are not tested and give no link.

    All rows are tested against the first of their run; those that fail, against all others.
    A run whose rows are mostly alike so takes few tests, and no link between two rows of
    it stays unknown that would connect more.
    """
    n = int(count.sum())
    first = np.repeat(start, count)
    row = np.arange(n)
    part = row if part is None else part
    alike = part == part[first]
    inner = np.flatnonzero(~alike)
    ok = np.zeros(n, bool)
    for i in range(0, len(inner), PAIRS):
        some = inner[i : i + PAIRS]
        ok[some] = test(first[some], some)
    a, b = [first[ok]], [row[ok]]
    ok |= alike
    rest = np.flatnonzero(~ok)
    end = np.repeat(start + count, count)
    for x, y in batches(first[rest] + 1, end[rest] - first[rest] - 1, rest):
        use = (part[x] != part[y]) & (ok[y] | (x < y))
        x, y = x[use], y[use]
        good = test(x, y)
        a.append(x[good])
        b.append(y[good])
    return np.concatenate(a), np.concatenate(b)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of ``n`` rows over the links."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    while (root[root] != root).any():
        root = root[root]
    return root


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every id in an edge: the smallest id that it reaches.

    Alternating large and small stars; each round is a partial minimum and a join that
    Spark can split at hot ids, and ends in a checkpoint.
    """
    x, y = F.greatest(a, b), F.least(a, b)
    now = edges.select(x.alias("u"), y.alias("v")).filter("u != v").distinct()
    now, before = cut_lineage(now), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        now = cut_lineage(small.select("e.u", "e.v").filter("u != v").distinct())
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionAll(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
