"""The stored index against the scanning search, and what a search reads."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacantia.operators import search, search_index

SCHEMA = "id long, kind string, place string, text string"
FACETS = {"kind": "kind", "place": "place"}


def drawn(seed, n, start=0):
    rng = random.Random(seed)
    words = ["data", "Engineer", "sales", "the", "and", "Éclair", "x1", "of"]
    return [
        (start + i, rng.choice(["a", "b", "", None]), rng.choice(["p", "q", "r"]), " ".join(rng.choices(words, [9, 5, 3, 20, 15, 1, 2, 12], k=rng.randrange(0, 30))))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two days in blocks of about 20 rows; the second day was written twice."""
    root = str(tmp_path_factory.mktemp("index"))
    first, second = drawn(1, 150), drawn(2, 90, 1000)
    for day, rows in (("2026-05-01", first), ("2026-05-02", drawn(3, 10, 5000)), ("2026-05-02", [*second, second[0], (None, "a", "p", "data")])):
        df = spark.createDataFrame(rows, SCHEMA)
        search_index.write_day(df, F.col("text"), root, day, key="id", facets=FACETS, block_rows=20)
    return root, spark.createDataFrame(first + second, SCHEMA)


@pytest.mark.parametrize(
    "query,selected,page,size",
    [
        ("data", {}, 1, 5), ("the", {"place": ["r"], "kind": ["nothing"]}, 1, 5), ("data engineer", {"kind": ["a"]}, 2, 5),
        ("x1 DATA sales", {}, 1, 400), ("data missing", {}, 1, 5), ("", {"kind": ["a", "b", ""], "place": ["p", "q"]}, 2, 5),
        ("éclair of", {"kind": ["a", "b", ""], "place": ["p", "q"]}, 1, 3),
    ],
)
def test_same_as_the_scan(spark, stored, query, selected, page, size):
    root, rows = stored
    want = search.search(rows, F.col("text"), query, facets=FACETS, selected=selected, page=page, page_size=size).collect()
    got = search_index.search(spark, root, query, facets=["kind", "place"], selected=selected, page=page, page_size=size, first_blocks=2).collect()
    assert [(r["key"], r["kind"], r["place"], round(r["score"], 9)) for r in got] == [
        (r["id"], r["kind"], r["place"], round(r["score"], 9)) for r in want
    ]
    got = search_index.search(spark, root, query, facets=["kind"], selected=selected, page=None)
    assert got.count() == search.search(rows, F.col("text"), query, facets=FACETS, selected=selected, page=None).count()


@pytest.mark.parametrize("selected", [{}, {"kind": ["a"]}, {"kind": ["a", "b", ""], "place": ["p", "q"]}, {"place": ["r"], "kind": ["b", "nothing"]}])
def test_facet_counts_of_a_selection(spark, stored, selected):
    root, rows = stored
    left = search.facet_filter(rows, FACETS, selected)
    want = sorted(
        (f, r[0], r["n"]) for f in FACETS for r in left.groupBy(f).agg(F.count("*").alias("n")).collect() if r[0]
    )
    assert sorted(map(tuple, search_index.facet_counts(spark, root, selected).collect())) == want


def test_a_search_reads_the_buckets_of_its_words(spark, stored):
    root, _ = stored
    hits = search_index.search(spark, root, "data engineer", facets=["kind"], page=None)
    files = hits.inputFiles()
    assert files and all("/postings/day=" in f for f in files)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term, [data,engineer])" in plan
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_empty_index(spark, tmp_path):
    root = str(tmp_path / "index")
    with pytest.raises(ValueError):
        search_index.search(spark, root, "data", facets=["kind"])
    search_index.write_day(spark.createDataFrame([], SCHEMA), F.col("text"), root, "2026-05-01", key="id", facets=FACETS)
    assert search_index.search(spark, root, "data", facets=["kind"], selected={"kind": ["a"]}).collect() == []
    assert search_index.facet_counts(spark, root, {"kind": ["a"]}).collect() == []


@pytest.mark.parametrize("least", [1, 1 << 18])
def test_postings_of_a_block(monkeypatch, least):
    monkeypatch.setattr(search_index, "BATCH_POSTINGS", least)
    rows = pa.table({
        "key": ["k2", "k0", "k1"], "block": pa.array([7, 7, 7], pa.int32()), "slot": pa.array([2, 0, 1], pa.int32()),
        "spaced": ["b a b", "a", ""], "f_x": [None, "p", "q"],
    })
    found = search_index._postings(["f_x"])(pa.concat_tables([rows[:1], rows[1:]]))
    entry = lambda *v: dict(zip(("slot", "key", "tf", "len", "f_x"), v))
    names = ("term", "block", "n", "max_tf", "min_len", "postings")
    assert sorted(found.to_pylist(), key=lambda r: r["term"] or "~") == [dict(zip(names, r)) for r in (
        ("a", 7, 2, 1, 1, [entry(0, "k0", 1, 1, "p"), entry(2, "k2", 1, 3, None)]),
        ("b", 7, 1, 2, 3, [entry(2, "k2", 2, 3, None)]),
        (None, 7, 3, 0, 0, [entry(0, "k0", 0, 1, "p"), entry(1, "k1", 0, 0, "q"), entry(2, "k2", 0, 3, None)]),
    )]
    none = search_index._postings([])(rows.slice(2).set_column(3, "spaced", pa.array([""])).set_column(2, "slot", pa.array([0], pa.int32())))
    assert [(r["term"], r["n"], len(r["postings"])) for r in none.to_pylist()] == [(None, 1, 1)]


def test_a_day_splits_its_texts_once_and_bounds_a_block_by_bytes(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    monkeypatch.setattr(search_index, "BLOCK_BYTES", 1000)
    spaced = search_index._spaced
    calls = []
    monkeypatch.setattr(search_index, "_spaced", lambda text: calls.append(1) or spaced(text))
    rows = [(i, "a", "p", f"Wörter, {i % 3} und " + "mehr " * 20) for i in range(60)]
    search_index.write_day(spark.createDataFrame(rows, SCHEMA), F.col("text"), root, "2026-05-01", key="id", facets=FACETS)
    assert len(calls) == 1
    stored = spark.read.parquet(f"{root}/rows")
    assert (stored.count(), stored.agg(F.sum("len")).first()[0]) == (60, 60 * 23)
    assert stored.select("block").distinct().count() > 3
    assert search_index.search(spark, root, "wörter 2", facets=["kind"], page=None).count() == 20


def test_columns_that_are_never_null(spark, tmp_path):
    root = str(tmp_path / "index")
    rows = spark.range(30).select("id", F.lit("a").alias("kind"), F.concat(F.lit("data "), F.col("id")).alias("text"))
    search_index.write_day(rows, F.col("text"), root, "2026-05-01", key="id", facets={"kind": "kind"}, block_rows=8)
    assert [r["key"] for r in search_index.search(spark, root, "data 7", facets=["kind"]).collect()] == [7]
    assert list(map(tuple, search_index.facet_counts(spark, root).collect())) == [("kind", "a", 30)]
