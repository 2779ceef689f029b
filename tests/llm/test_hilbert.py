import zlib
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from vacantia.llm import hilbert


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (3, 4)])
def test_curve_visits_every_cell_by_unit_steps(spark, n, bits):
    cells = list(product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(n)))
    at = hilbert.curve_index([F.col(f"c{i}") for i in range(n)], bits)
    order = [tuple(r)[:n] for r in sorted(df.withColumn("k", at).collect(), key=lambda r: r["k"])]
    assert sorted(r["k"] for r in df.withColumn("k", at).collect()) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(order, order[1:]))


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string, n_chars long")


def test_shards_hold_equal_rows_and_gapless_slots(spark):
    texts = [None, "", "é" * 5, "same", "same", "x" * 5000]
    rows = [
        (None if i % 50 == 7 else i, texts[i % 6], None if i % 9 == 0 else "en", "hot" if i % 3 else f"s{i}", "taken", i)
        for i in range(503)
    ]
    rows += [rows[3]] * 5
    out = hilbert.shard(docs(spark, rows), shards=7).collect()
    assert len(out) == len(rows)
    counts = Counter(r["shard"] for r in out)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n))
    for r in out:
        body = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 16, zlib.crc32(body), "rows")
        assert r["grown_shard"] is None
    assert sorted(r["n_chars"] for r in out) == sorted(r[5] for r in rows)


def test_shards_follow_the_curve(spark):
    rows = [(i, "t" * (i % 90), "en", f"s{i % 13}", None, i) for i in range(400)]
    out = hilbert.shard(docs(spark, rows), shards=5, keep=False).collect()
    assert "text" not in out[0].asDict()
    order = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in out)


def test_empty_and_tiny_tables(spark):
    assert hilbert.shard(docs(spark, []), shards=4).collect() == []
    out = hilbert.shard(docs(spark, [(1, "a", "en", "s", None, 1)]), shards=4).collect()
    assert [(r["shard"], r["slot"]) for r in out] == [(0, 0)]


def test_whole_strings_make_the_cells(spark):
    """Fifteen sources that differ only after a long beginning lie in a shard each."""
    rows = [(i, "same", "en", f"https://example.org/crawl/{i % 15:02d}", None, i) for i in range(300)]
    for keep in (True, False):
        out = hilbert.shard(docs(spark, rows), shards=15, keep=keep).collect()
        assert len({(r["shard"], r["doc_id"] % 15) for r in out}) == 15


def test_cells_follow_the_rows_not_the_values(spark):
    values = [None] * 10 + ["hot"] * 200 + [f"v{i:03d}" for i in range(190)]
    df = spark.createDataFrame([(v, 1) for v in values], "s string, n int").repartition(5)
    total, (cell, _) = hilbert.cells(df, ["s", "n"])
    known = sorted(v for v in values if v)
    cuts = {known[-(-len(known) * i // 16) - 1] for i in range(1, 16)}
    assert total == 400
    for r in df.select("s", cell.alias("c")).distinct().collect():
        assert r["c"] == (0 if r["s"] is None else sum(r["s"] >= c for c in cuts))
