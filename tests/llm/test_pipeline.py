import re
import zlib
from collections import Counter

import corpus_pipeline

from tests.llm.test_jaccard import shingle_set
from tests.llm.test_toxicity import bags
from vacantia.llm import mixing, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(rows, toxic, items):
    """Ids that are left after the three filters, by comparing everything with everything."""
    rows = [r for r in rows if not toxic[r["doc_id"]]]
    sets = [shingle_set(r["text"]) for r in rows]
    gone, seen = set(), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            x = sets[todo.pop()]
            for j, y in enumerate(sets):
                if j not in group and x and y and 5 * len(x & y) >= 4 * len(x | y):
                    group.add(j)
                    todo.append(j)
        seen |= group
        first = min(rows[j]["doc_id"] for j in group)
        gone |= {rows[j]["doc_id"] for j in group} - {first}
    left = []
    windows = {tuple(w[i : i + 13]) for w in map(words, items) if w for i in range(max(1, len(w) - 12))}
    sizes = {len(w) for w in windows}
    for r in rows:
        if r["doc_id"] in gone:
            continue
        w, hit = words(r["text"]), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            left.append(r["doc_id"])
    return sorted(left)


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    toxic = {r["doc_id"]: r["predicted"] for r in toxicity.scores(docs, marks).collect()}
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = docs.collect()
    out = corpus_pipeline.run(spark, folder)
    got = out.collect()
    assert sorted(r["doc_id"] for r in got) == plain(rows, toxic, items)
    by = {r["doc_id"]: r for r in rows}
    counts = Counter(r["shard"] for r in got)
    assert not got or max(counts.values()) - min(counts[s] for s in range(40)) <= 1
    for r in got:
        assert all(r[c] == by[r["doc_id"]][c] for c in docs.columns)
        assert r["text_crc32"] == zlib.crc32((r["text"] or "").encode())
    return docs, out


def test_pipeline_against_brute_force(spark):
    docs, out = check(spark, FOLDER)
    assert 0 < out.count() < docs.count()
    assert queries.QUERIES["pipeline"](spark, FOLDER).columns == out.columns


def test_pipeline_on_edge_rows(spark, tmp_path):
    docs, labels = bags(80)
    rows = [(i, t, "en", "s", len(t or "")) for i, t, *_ in docs]
    bench = [(1, "alpha beta gamma"), (2, None), (None, "delta"), (1, "alpha beta gamma")]
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0), (502, "alpha beta gamma", "en", "s", 16),
             (503, "word " * 50_000, "en", "s", 1), (504, "word " * 40_000, "en", "s", 1), (505, rows[1][1], "de", "t", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    check(spark, str(tmp_path))


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, FOLDER)
        if name != "sharding":
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.collect() == []


def test_the_mix_survives_sharding(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    corpus_pipeline.mix_sources(spark, docs, FOLDER).write.parquet(f"{tmp_path}/mixed")
    docs.write.parquet(f"{tmp_path}/unmixed")
    place = {r["doc_id"]: (r["slot"], r["place"]) for r in mixing.plan(docs).collect()}
    out = {
        k: sorted(corpus_pipeline.shard(spark, spark.read.parquet(f"{tmp_path}/{k}"), FOLDER).collect(), key=lambda r: (r["shard"], r["slot"]))
        for k in ("mixed", "unmixed")
    }
    assert len(out["mixed"]) == len(place) == docs.count()
    for a, b in zip(out["mixed"], out["mixed"][1:]):
        if a["shard"] == b["shard"]:
            assert b["slot"] == a["slot"] + 1 and place[a["doc_id"]] < place[b["doc_id"]]
    curves = [[r["curve"] for r in out["mixed"] if r["shard"] == s] for s in range(40)]
    assert all(max(a) <= min(b) for a, b in zip(curves, curves[1:]))
    slots = [{r["doc_id"]: (r["shard"], r["slot"]) for r in rows} for rows in out.values()]
    assert slots[0] != slots[1]


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "sharding"
    ]
