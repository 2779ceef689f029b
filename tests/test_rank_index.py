"""The stored ranking against a sort, and what a page opens."""

import pytest
from pyspark.sql import functions as F

from vacantia.operators import rank_index

def order():
    return [F.col("score").desc_nulls_last(), F.col("id")]


def rows(n):
    """A third of all rows in one group."""
    return [(i, "hot" if i % 3 == 0 else f"g{i % 7}" if i % 5 else None, None if i % 11 == 0 else (i * 37) % 50) for i in range(n)]


def sort_key(r):
    return r[2] is None, -(r[2] or 0), r[0]


@pytest.mark.parametrize("ranges", [1, 7])
def test_pages_and_groups(spark, tmp_path, ranges):
    data = rows(230)
    df = spark.createDataFrame(data, "id long, g string, score int").repartition(5)
    whole, grouped = str(tmp_path / "whole"), str(tmp_path / "grouped")
    rank_index.write(df, order(), whole, "v1", ranges=ranges)
    rank_index.write(df, order(), grouped, "v1", group="g", ranges=ranges)
    want = [r[0] for r in sorted(data, key=sort_key)]
    ranked = rank_index.ranks(spark, whole, "v1").collect()
    assert [r["id"] for r in sorted(ranked, key=lambda r: r["global_rank"])] == want
    assert sorted(r["global_rank"] for r in ranked) == list(range(1, 231))
    for number, size in ((1, 10), (4, 33), (23, 10), (24, 10), (1, 1000)):
        got = rank_index.page(spark, whole, "v1", number, size).collect()
        assert [r["id"] for r in got] == want[(number - 1) * size : number * size]
        assert [r["global_rank"] for r in got] == list(range(1, 231))[(number - 1) * size : number * size]
    for g in ("hot", "g1", None, "unknown"):
        own = [r[0] for r in sorted((r for r in data if r[1] == g), key=sort_key)]
        for number in (1, 3):
            got = rank_index.group_page(spark, grouped, "v1", "g", g, number, 6).collect()
            assert [r["id"] for r in got] == own[(number - 1) * 6 : number * 6]
    placed = rank_index.group_positions(spark, grouped, "v1", "g").collect()
    assert sorted((r["g"] or "", r["position"], r["id"]) for r in placed) == sorted(
        (g or "", k + 1, r[0]) for g in {r[1] for r in data} for k, r in enumerate(sorted((r for r in data if r[1] == g), key=sort_key))
    )


def test_a_page_opens_its_folders_only(spark, tmp_path):
    root = str(tmp_path / "whole")
    rank_index.write(spark.createDataFrame(rows(200), "id long, g string, score int"), order(), root, "v1", ranges=8)
    plan = rank_index.page(spark, root, "v1", 3, 10)._jdf.queryExecution().executedPlan().toString()
    assert "__part#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "__row" in plan.split("PushedFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        rank_index.page(spark, root, "v2", 1)


def test_empty_ranking(spark, tmp_path):
    root = str(tmp_path / "empty")
    rank_index.write(spark.createDataFrame([], "id long, g string, score int"), order(), root, "v1", group="g")
    with pytest.raises(ValueError):
        rank_index.ranks(spark, root, "v1")
