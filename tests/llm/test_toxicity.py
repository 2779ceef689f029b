import zlib

import numpy as np
import pyarrow as pa

from vacantia.llm import queries, toxicity

DOCS = "doc_id long, text string, score double, sentences string"
LABELS = "doc_id long, toxic int, quality int"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def bags(n=400):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        lines = [" ".join(rng.choice(words, 8)) for _ in range(rng.integers(1, 30))]
        if i % 4 == 0:
            at = int(rng.integers(0, len(lines)))
            lines[at] += f" zoudé{rng.choice(list('xyz'))}k here"
        docs.append((i, ". ".join(lines), 1.0, "x"))
        labels.append((i, int(i % 4 == 0), 1))
    return docs, labels


def test_scores_find_documents_and_their_sentences(spark):
    docs, labels = bags()
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    out = {r["doc_id"]: r for r in toxicity.scores(df, marks).collect()}
    assert len(out) == len(docs)
    for i, text, *_ in docs:
        r = out[i]
        assert r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["predicted"] == int(i % 4 == 0)
        if i % 4 == 0:
            spans = [text[s["start"] : s["end"]] for s in r["sentences"]]
            assert len(spans) == 1 and "zoudé" in spans[0]
    kept = toxicity.reject(df, marks)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(400) if i % 4]


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = bags(200)
    df = spark.createDataFrame(docs, DOCS)
    turned = [(i, 1 - y if held(i) else y, q) for i, y, q in labels]
    a = toxicity.scores(df, spark.createDataFrame(labels, LABELS)).collect()
    b = toxicity.scores(df, spark.createDataFrame(turned, LABELS)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_edge_rows(spark):
    docs, labels = bags(120)
    docs += [(1000, None, 0.0, None), (1001, "", 0.0, None), (None, docs[0][1], 0.0, None), docs[4], docs[4]]
    docs += [(1002, "word " * 100_000, 0.0, None), (1003, "!?\n" * 1000, 0.0, None)]
    labels += [(None, 1, 1), (5, None, 1), (5, 7, 1), (0, 0, 1), (99_999, 1, 1)]
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    rows = toxicity.scores(df, marks).collect()
    assert len(rows) == len(docs) and all(r["score"] is not None for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[1000]["predicted"] == by[1001]["predicted"] == by[1002]["predicted"] == by[1003]["predicted"] == 0
    assert by[None]["held_out"] is False and by[None]["predicted"] == 1
    assert toxicity.scores(df.limit(0), marks).collect() == []
    assert {r["score"] for r in toxicity.scores(df, marks.limit(0)).collect()} == {0.0}
    assert {r["predicted"] for r in toxicity.scores(df, marks.filter("toxic = 1")).collect()} == {1}


def test_long_texts_are_learnt_from(spark):
    docs, labels = bags(300)
    long_ = [(i, t + ". plain words" * 4000 if i % 4 else t + ". plain words" * 9000, x, y) for i, t, x, y in docs]
    df, marks = spark.createDataFrame(long_, DOCS), spark.createDataFrame(labels, LABELS)
    rows = toxicity.scores(df, marks).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in rows]) > 0.97
    # The bound of the bytes takes fewer rows, of any length that fits.
    small = toxicity.train(df, marks, most_bytes=1 << 19)
    assert len(toxicity.train(df, marks).features) > len(small.features)


def test_the_model_is_fitted_outside_the_driver(spark, monkeypatch):
    docs, labels = bags(200)
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    usual = toxicity.train(df, marks)
    here = sorted((i, text, labels[i][1]) for i, text, *_ in docs if not held(i))
    same = toxicity.fit(pa.array([t for _, t, _ in here]), np.array([y for *_, y in here]))
    assert (usual.features == same.features).all() and (usual.weights == same.weights).all() and usual.bias == same.bias

    def refuse(*_):
        raise AssertionError("fitted in the driver")

    monkeypatch.setattr(toxicity, "fit", refuse)  # of this process only
    assert len(toxicity.train(df, marks).features) == len(usual.features)
    monkeypatch.undo()
    assert not len(toxicity.train(df, marks.filter("toxic > 1")).features)


def test_many_offending_sentences_of_one_text(spark):
    docs, labels = bags(200)
    text = "é plain. zoudéxk here! " * 40_000
    df = spark.createDataFrame([*docs, (1000, text, 0.0, None)], DOCS)
    row = toxicity.scores(df, spark.createDataFrame(labels, LABELS)).filter("doc_id = 1000").first()
    spans = [text[x["start"] : x["end"]] for x in row["sentences"] if "zou" in text[x["start"] : x["end"]]]
    assert spans == [" zoudéxk here!"] * 40_000


def test_sentences_cut_texts_without_gaps():
    texts = ["a b. c!? d\ne", "", None, "x", ".", "é. ü"]
    s = toxicity.Sentences(pa.array(texts, pa.string()))
    joined = "".join(t or "" for t in texts).encode()
    spans = [s.span(i) for i in range(int(s.first[-1]))]
    assert b"".join(joined[a:b] for a, b in spans) == joined
    assert s.count.tolist() == [5, 1, 1, 1, 2, 2]


def test_held_out_accuracy_on_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    ones = np.array([r["score"] for r in rows if r["toxic"] == 1])
    zeros = np.array([r["score"] for r in rows if r["toxic"] == 0])
    assert (ones[:, None] > zeros[None, :]).mean() > 0.95
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    assert (zeros >= 0.5).mean() < 0.01
