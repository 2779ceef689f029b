import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vacantia.llm import licenses, queries

SCHEMA = "doc_id long, text string, path string, license string, score double"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(rows):
    n = len(rows)
    vocabulary = {w for _, t in licenses.TEMPLATES for w in words(t)}
    seen = Counter(w for r in rows for w in set(words(r[1])) & vocabulary)
    weight = lambda w: (math.log((n + 1) / (seen[w] + 1)) if w in vocabulary else math.log((n + 1) / 2)) + 1
    vector = lambda t: {w: c * weight(w) for w, c in Counter(words(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = [(k, vector(t)) for k, t in licenses.TEMPLATES]
    own, files = {}, {}
    for i, r in enumerate(rows):
        found, size = [], 0
        for at, line in enumerate((r[1] or "").split("\n")):
            v = vector(line)
            if v:
                best = max(sum(v.get(w, 0) * x for w, x in t.items()) / norm(v) / norm(t) for _, t in templates)
                name = min(k for k, t in templates if sum(v.get(w, 0) * x for w, x in t.items()) / norm(v) / norm(t) >= best - 1e-12)
                if best >= licenses.LEAST:
                    found.append((-round(best, 9), name))
                    size += len(words(line))
        folder, _, base = (r[2] or "").rpartition("/")
        own[i] = (min(found), folder) if found else (None, folder)
        if found and (size >= 0.25 * len(words(r[1])) or re.match(licenses.FILE_NAME, base)):
            files[folder] = min(files.get(folder, (9, "")), min(found))
    out = []
    for i, r in enumerate(rows):
        best, folder = own[i]
        if best:
            out.append((r[0], best[1], -best[0], "own", folder, None))
            continue
        up = folder.split("/")
        for k in range(len(up), -1, -1):
            above = "/".join(up[:k])
            if above in files:
                out.append((r[0], files[above][1], -files[above][0], "inherited", folder, above))
                break
        else:
            out.append((r[0], None, None, "none", folder, None))
    return out


def order(rows):
    return sorted(repr((*r[:2], None if r[2] is None else round(r[2], 6), *r[3:])) for r in map(tuple, rows))


def fixture():
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, mit, "a/LICENSE"), (2, "code here", "a/b/c/x.py"), (3, f"some text\n{gpl}\nmore text " * 9, "a/b/y.py"),
        (4, "plain", "a/b/z.py"), (5, gpl, "a/d/COPYING.txt"), (6, "", "a/d/e/f"), (7, None, "a/d/e/f"), (8, "x", None),
        (9, "x", "q/r"), (10, "Licensed under CC BY-NC 4.0.", "top"), (None, "code", "a/x"), (2, "code here", "a/b/c/x.py"),
        (11, "license " * 50_000, "z/w/long"), (12, "the of and to " * 300 + "\n" + mit, "k/LICENSE"), (13, "y", "k/l/m/n"),
        (14, "All rights reserved.\n" + mit, "v/two"), (15, "y", "v/other"), (16, "y", "/abs/path"), (17, "Licensed under CC BY 4.0.", "/abs/LICENSE"),
    ]
    return [(*r, "clash", 0.0) for r in rows]


@pytest.mark.parametrize("top", [True, False])
def test_scan_against_brute_force(spark, top):
    rows = [r for r in fixture() if top or r[2] != "top"]
    df = spark.createDataFrame(rows, SCHEMA)
    got = licenses.licenses(df, F.col("path")).collect()
    assert order(got) == order(plain(rows))
    assert {r["origin"] for r in got} == {"own", "inherited"} | (set() if top else {"none"})
    assert licenses.licenses(df.limit(0), F.col("path")).collect() == []


@pytest.mark.parametrize("batch", ["1", "2", "10000"])
def test_batches_without_a_license_line(spark, batch):
    """Parts of one task with and without candidate lines make batches of one schema."""
    mit = "Released under the MIT License."
    rows = [(i, t, f"d{i}/x") for i, t in enumerate(["plain text"] * 6 + [mit] * 4 + ["", None] * 3 + [mit, "text"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert order(licenses.licenses(df, F.col("path")).collect()) == order(plain(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_query_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = []
    for d in docs:
        up = [d["source"], d["lang"], str(d["doc_id"] // 500)][: 1 if d["doc_id"] % 50 == 0 else 2 if d["doc_id"] % 10 == 0 else 3]
        rows.append((d["doc_id"], d["text"], "/".join([*up, str(d["doc_id"])])))
    assert order(queries.op9_licenses(spark, folder).collect()) == order(plain(rows))


def test_common_words_weigh_alike_at_any_size(spark):
    line = "Released under the MIT License see"
    for n in (20, 2000):
        rows = [(i, "released\nunder\nthe\nmit\nlicense\nsee" if i % 5 < 3 else "other", f"d{i}/x") for i in range(n)]
        df = spark.createDataFrame([*rows, (n, line, "own/x")], "doc_id long, text string, path string")
        got = {r["doc_id"]: r for r in licenses.licenses(df, F.col("path")).collect()}
        assert got[n]["license"] == "MIT" and got[n]["origin"] == "own"
        # All six words are in the same number of texts.
        assert abs(got[n]["cosine"] - (5 / 6) ** 0.5) < 1e-6
        assert all(got[i]["license"] is None for i in range(n))


def test_other_words_by_their_real_frequencies(spark):
    line = "Released under the MIT License see see docs"
    rows = [(i, ["see", "docs\nsee", "x"][i % 3], f"d{i}/x") for i in range(300)] + [(300, line, "own/x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    seen = {"see": 201, "docs": 101}
    weight = lambda w: math.log(302 / (seen.get(w, 1) + 1)) + 1
    known = 5 * weight("mit") ** 2
    want = math.sqrt(known / (known + (2 * weight("see")) ** 2 + weight("docs") ** 2))
    got = [r for r in licenses.licenses(df, F.col("path")).collect() if r["doc_id"] == 300]
    assert abs(got[0]["cosine"] - want) < 1e-6


@pytest.mark.parametrize("path,want", [("a/b/c", "a/b"), ("a", ""), ("", ""), (None, ""), ("/x", ""), ("a//b", "a/")])
def test_directory(spark, path, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(licenses.directory(F.col("p"))).first()[0] == want
