import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import public_tokenizers
from tokenizers import Tokenizer

from vacantia.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "a", "Hello  world's don't\tstop\n", "é é ́x ΟΔΟΣ Σ ς İ ß", "<|endoftext|> x<|startoftext|>y",
    "x y z　w", "123 4.5.6 $$$ ...!?", "日本語 テキスト", "a\x00b \x1f\x1c", " line ", "\U0001f600‍ x", "ab" * 5000,
]


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def check(rows, docs, window=packing.WINDOW):
    """Every id once, sequences gapless, sizes full or powers of two."""
    tokenizer = Tokenizer.from_file(PATH)
    want, pieces, sequences = {}, {}, {}
    for d in docs:
        want.setdefault(d["doc_id"], []).append(plain_ids(tokenizer, d["text"]))
    for r in rows:
        assert r["length"] * 4 == len(r["ids"]) and r["length"] > 0
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == want.keys()
    for key, texts in want.items():
        got = sorted((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]) for r in pieces[key])
        if len(texts) == 1:
            assert sum((g[1] for g in got), []) == texts[0]
            assert [g[0] for g in got] == np.cumsum([0, *[len(g[1]) for g in got]])[:-1].tolist()
            assert {g[2] for g in got} == {len(texts[0])}
        else:
            assert sorted(i for g in got for i in g[1]) == sorted(sum(texts, []))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    return sequences


@pytest.mark.parametrize("keep", [3, 1 << 20])
def test_ids_of_odd_texts(keep):
    tokenizer = Tokenizer.from_file(PATH)
    units = packing.Units(tokenizer, keep)
    rng = random.Random(5)
    alphabet = ["a", "B", "j", "J", "\u030c", "1", "'", "s", "S", "!", ",", '"', "<", "|", ">", " ", "\n", "\u2028", "é", "—", "<|ENDOFTEXT|>", "<|endoftext|>", "'ll", "_"]
    drawn = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(4000)]
    for some in (ODD, drawn[:2000], drawn[2000:], ODD, [], [None], ["", ""]):
        ids, at = units.encode(pa.array(some, pa.string()))
        for i, text in enumerate(some):
            assert ids[at[i] : at[i + 1]].tolist() == plain_ids(tokenizer, text), text
        assert len(at) == len(some) + 1


def test_query_loses_no_id(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs, PATH).collect()
    sequences = check(rows, docs.collect())
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) <= tokens // packing.WINDOW + 12 * (tokens // packing.SHARD_TOKENS + 8)
    got = {(r["doc_id"], r["start"]): r for r in queries.op12_packing(spark, folder).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"], r["start"]]
        assert (g["length"], g["doc_tokens"], g["ids_crc32"]) == (r["length"], r["doc_tokens"], zlib.crc32(bytes(r["ids"])))


@pytest.mark.parametrize("window,shard", [(4, 16), (16, 200), (2048, 1 << 18), (1, 7)])
def test_edge_rows(spark, window, shard):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)]
    rows += [(5, "same text", "x", 1)] * 3 + [(None, "no id", "x", 1), (99, "w " * 3000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, sequence_id int").repartition(3)
    check(packing.pack(docs, PATH, window=window, shard_tokens=shard).collect(), docs.collect(), window)
    assert packing.pack(docs.limit(0), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, window=12)


def test_nearest_unused_pieces_fill_the_window():
    """The windows of a shard are those that plain BM25 over all unused pieces gives."""
    rng = np.random.default_rng(3)
    size = rng.integers(1, 40, 60)
    ids = np.concatenate([np.r_[rng.zipf(1.5, n - 1) % 300 + 2, packing.END] for n in size]).astype(np.uint32)
    at = np.r_[0, np.cumsum(size)]
    texts = [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    df = {t: sum(t in x for x in texts) for t in set(ids.tolist())}

    def score(seed, other):
        out = 0.0
        for t in set(texts[seed]) - {packing.END}:
            tf = texts[other].count(t)
            idf = np.log1p((len(texts) - df[t] + 0.5) / (df[t] + 0.5))
            out += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(texts[other]) / np.mean(size)))
        return out

    left, seed = {i: len(t) for i, t in enumerate(texts)}, 0
    for used, first, length in packing.windows(ids, at, 64):
        order = [seed, *sorted((i for i in left if i != seed), key=lambda i: (-round(score(seed, i), 9), i))]
        want, room = [], 64
        for i in order:
            if room:
                want.append((i, len(texts[i]) - left[i], min(room, left[i])))
                room -= want[-1][2]
        assert [tuple(map(int, x)) for x in zip(used, first, length)] == want
        for i, _, n in want:
            left[i] -= n
        seed = want[-1][0] if left[want[-1][0]] else min((i for i in left if left[i]), default=None)
        left = {i: n for i, n in left.items() if n}
    assert not left


def test_power_sizes():
    for n in range(1, 5000):
        sizes = packing.power_sizes(n)
        assert sum(sizes) == n and all(s & (s - 1) == 0 for s in sizes)
