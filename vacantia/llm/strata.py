"""Ranked lexical search over a length-stratified index.

A document's normaliser ``m`` depends on its number of terms alone, so documents of equal
``m`` form a stratum, and a term's share of the score is a function of ``tf`` alone in it.
The index holds each stratum as segments: its terms, and under each term the documents by
falling ``tf``. A search takes the greatest ``tf`` of each term in a segment for the bound of
an item's score there, visits the segments of a batch by falling bound, skips those that cannot
reach the item's k-th score so far, and computes the impact of a ``tf`` once for all postings.

A stratum of any size is dealt to segments of about ``SEGMENT_TERMS`` terms, so a hot length
is many segments; every document is indexed whole. Terms are told apart by 64-bit hashes.

Defined cases: a null or empty text has no terms, is not counted and never found; each row
of the documents is a document, so repeated rows are found as often as they come; rows without
an id rank after all others of their score; an item without terms finds nothing; each row of
the items is a query of its own. Other columns of either table are not looked at.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vacantia.llm.arrays import expand, parts, text_bytes
from vacantia.llm.contamination import lower_words, member
from vacantia.session import cut_lineage

SEGMENT_TERMS = 1 << 20
TASK_TERMS = 1 << 23
PART_BYTES = 4 << 20
ITEM_BYTES = 1 << 20  # item texts searched for at a time
CELLS = 1 << 21  # scores, and postings, held at a time
SEGMENTS = 256  # segments whose bounds are held at a time
BROADCAST_STRATA = 100_000

SEGMENT = "m long, docs array<long>, terms binary, term_runs binary, tf binary, run_postings binary, postings binary"


@dataclass
class Index:
    segments: DataFrame
    texts: int  # documents with a term
    terms: int  # all their terms


def lengths(docs: DataFrame) -> DataFrame:
    """How many documents have ``n`` terms, for each ``n`` above 0."""

    def count(batches):
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                n, docs = np.unique(lower_words(part.column("text")).counts(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["n", "docs"])

    counted = docs.select("text").mapInArrow(count, "n long, docs long")
    return counted.groupBy("n").agg(F.sum("docs").alias("docs")).filter("n > 0")


def blobs(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Values as one binary per range of ``at`` (``n + 1`` offsets)."""
    places = (at * values.itemsize).astype(np.int64)
    wide = pa.Array.from_buffers(
        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    )
    return wide.cast(pa.binary())


def counted_terms(docs: DataFrame, texts: int, terms: int) -> DataFrame:
    """Distinct terms with their ``tf`` of each document, its ``m`` and its number in the task."""

    def count(batches):
        seen = 0
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                words = lower_words(part.column("text"))
                n = words.counts()
                order = np.lexsort((words.hash, words.text))
                term, text = words.hash[order], words.text[order]
                new = np.ones(len(order), bool)
                new[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                tf = np.diff(np.r_[first, len(order)]).astype(np.uint32)
                at = np.searchsorted(text[first], np.arange(part.num_rows + 1))
                some = pa.array(n > 0)
                out = pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(25 + 75 * n.astype(np.int64) * texts // terms, pa.int64()),
                        pa.array(seen + np.arange(part.num_rows), pa.int64()), blobs(term[first], at), blobs(tf, at),
                    ],
                    ["doc_id", "m", "number", "terms", "tf"],
                )
                seen += part.num_rows
                yield out.filter(some)

    return docs.mapInArrow(count, "doc_id long, m long, number long, terms binary, tf binary")


def segment(rows: pa.Table) -> pa.Table:
    """One segment of the documents of one stratum."""
    data, at = text_bytes(rows.column("terms"))
    term = np.frombuffer(data.tobytes(), np.uint64)
    tf = np.frombuffer(text_bytes(rows.column("tf"))[0].tobytes(), np.uint32)
    doc = np.repeat(np.arange(rows.num_rows, dtype=np.int32), np.diff(at) // 8)
    order = np.lexsort((doc, ~tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    new_term = np.r_[True, term[1:] != term[:-1]]
    run = np.flatnonzero(new_term | np.r_[True, tf[1:] != tf[:-1]])
    first = np.flatnonzero(new_term)
    whole = [
        term[first], np.r_[np.searchsorted(run, first), len(run)].astype(np.int32), tf[run],
        np.r_[run, len(term)].astype(np.int32), doc,
    ]
    ids = rows.column("doc_id").combine_chunks()
    docs = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.table(
        [rows.column("m").slice(0, 1), docs, *[pa.array([x.tobytes()], pa.binary()) for x in whole]],
        names=["m", "docs", "terms", "term_runs", "tf", "run_postings", "postings"],
    )


def build(docs: DataFrame) -> Index:
    """The index of ``(doc_id, text)``, written to the shared folder; two passes over the texts."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    by_length = cut_lineage(lengths(docs))
    texts, terms = by_length.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum(F.expr("n * docs")), F.lit(0))).first()
    if not texts:
        return Index(docs.sparkSession.createDataFrame([], SEGMENT), 0, 0)
    large = (
        by_length.groupBy(F.expr(f"25 + (75L * n * {texts}L) DIV {terms}L").alias("m"))
        .agg(F.sum(F.expr("n * docs")).alias("terms")).filter(F.col("terms") > SEGMENT_TERMS)
        .select("m", F.ceil(F.col("terms") / SEGMENT_TERMS).alias("segments"))
    )
    if large.count() <= BROADCAST_STRATA:
        large = F.broadcast(large)
    dealt = counted_terms(docs, texts, terms).join(large, "m", "left").withColumn(
        "segment", F.pmod("number", F.coalesce("segments", F.lit(1)))
    )
    tasks = max(1, -(-terms // TASK_TERMS))
    segments = (
        dealt.select("doc_id", "m", "segment", "terms", "tf").repartition(tasks, "m", "segment")
        .groupBy("m", "segment").applyInArrow(segment, SEGMENT)
    )
    return Index(cut_lineage(segments), texts, terms)


class Segment:
    """Views of the arrays of one row of the index."""

    def __init__(self, row: dict):
        self.m = row["m"]
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.term_runs = np.frombuffer(row["term_runs"], np.int32)
        self.tf = np.frombuffer(row["tf"], np.uint32)
        self.run_postings = np.frombuffer(row["run_postings"], np.int32)
        self.postings = np.frombuffer(row["postings"], np.int32)

    def frequencies(self) -> np.ndarray:
        return np.diff(self.run_postings[self.term_runs])

    def impacts(self) -> np.ndarray:
        """Share of the score of each run, computed once per ``tf`` of the stratum."""
        tf, of = np.unique(self.tf, return_inverse=True)
        tf = tf.astype(np.int64)
        return (1_000_000_000 * tf // (1000 * tf + 8 * self.m))[of]


class Items:
    """Items of a block as triples (item, number of the term, times it stands there)."""

    def __init__(self, texts: list[str | None]):
        words = lower_words(pa.array(texts, pa.large_string()))
        self.n = len(texts)
        self.vocabulary, number = np.unique(words.hash, return_inverse=True)
        key, self.times = np.unique(words.text * len(self.vocabulary) + number, return_counts=True)
        self.item, self.term = np.divmod(key, max(1, len(self.vocabulary)))
        self.weight = np.zeros(len(self.vocabulary), np.int64)

    def weigh(self, texts: int, seen: dict[int, int]) -> None:
        df = [seen.get(i, 0) for i in range(len(self.vocabulary))]
        self.weight = np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * n + 1))) for n in df], np.int64)


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.floor = np.ones(n, np.int64)  # least score that may still enter
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = np.r_[self.item, item], np.r_[self.score, score], np.r_[self.doc, doc]
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        start = np.searchsorted(item, item)
        rank = np.arange(len(item)) - start
        keep = rank < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        full = rank == self.k - 1
        self.floor[item[full]] = score[full]


NO_ID = np.iinfo(np.int64).max


def visit(rows: pa.RecordBatch, items: Items, best: Best) -> None:
    """Scores the items in the segments of ``rows`` by falling bound."""
    heads = rows.select(["m", "terms", "term_runs", "tf", "run_postings", "postings"]).to_pylist()
    segments = [Segment(r) for r in heads]
    bounds = np.zeros((len(segments), items.n), np.int64)
    found = []
    for s, one in enumerate(segments):
        known, at = member(items.vocabulary, one.terms)
        impact = one.impacts()
        some = np.flatnonzero(known[items.term])
        first = impact[one.term_runs[at[items.term[some]]]]
        np.add.at(bounds[s], items.item[some], items.times[some] * items.weight[items.term[some]] * first)
        found.append((some, at, impact))
    for s in np.argsort(-bounds.max(axis=1, initial=0), kind="stable"):
        alive = bounds[s] >= best.floor
        one, (some, at, impact) = segments[s], found[s]
        some = some[alive[items.item[some]]]
        if not len(some):
            continue
        term = at[items.term[some]]
        ids = rows.column("docs")[int(s)].values
        ids = np.asarray(ids.fill_null(int(NO_ID)) if ids.null_count else ids)
        size = one.run_postings[one.term_runs[term + 1]] - one.run_postings[one.term_runs[term]]
        for a, b in pieces(items.item[some], size, len(ids)):
            local, number = np.unique(items.item[some[a:b]], return_inverse=True)
            share = items.times[some[a:b]] * items.weight[items.term[some[a:b]]]
            run, entry = expand(one.term_runs[term[a:b]].astype(np.int64), one.term_runs[term[a:b] + 1] - one.term_runs[term[a:b]])
            at_run = one.run_postings[run].astype(np.int64)
            place, of = expand(at_run, one.run_postings[run + 1] - at_run)
            score = np.zeros(len(local) * len(ids), np.int64)
            np.add.at(score, number[entry[of]] * len(ids) + one.postings[place], (share[entry] * impact[run])[of])
            hit = np.flatnonzero(score >= np.repeat(best.floor[local], len(ids)))
            which, doc = np.divmod(hit, len(ids))
            best.add(local[which], score[hit], ids[doc])


def pieces(item: np.ndarray, size: np.ndarray, docs: int) -> Iterator[tuple[int, int]]:
    """Cuts the entries, sorted by item, into whole items of about ``CELLS`` scores and postings."""
    start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    cost = np.cumsum(np.maximum(np.add.reduceat(size.astype(np.int64), start), docs))
    end = np.r_[start[1:], len(item)]
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(cost, (cost[i - 1] if i else 0) + CELLS, "right")))
        yield int(start[i]), int(end[j - 1])
        i = j


def item_blocks(items: DataFrame) -> Iterator[list]:
    """Rows of the items with their number, some bytes of text at a time."""
    block, size = [], 0
    for number, row in enumerate(items.toLocalIterator()):
        block.append((number, row[0], row[1]))
        size += len(row[1] or "")
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Items reach the tasks in blocks of about ``ITEM_BYTES``; each block reads the dictionaries
    once for the document frequencies and the postings once for the scores.
    """
    spark = items.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"number long, item_id {kind}, doc_id long, score long")
    for rows in item_blocks(items) if index.texts else ():
        block = Items([r[2] for r in rows])
        shared = spark.sparkContext.broadcast(block.vocabulary)

        def frequencies(batches, shared=shared):
            for batch in batches:
                terms, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for row in batch.to_pylist():
                    one = Segment(row | {"tf": b"", "postings": b"", "m": 0})
                    known, at = member(shared.value, one.terms)
                    terms.append(np.flatnonzero(known))
                    sizes.append(one.frequencies()[at[known]].astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(terms)), pa.array(np.concatenate(sizes))], ["term", "n"])

        seen = (
            index.segments.select("terms", "term_runs", "run_postings")
            .mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n"))
        )
        block.weigh(index.texts, dict(map(tuple, seen.collect())))  # at most one row a word of the block
        whole = spark.sparkContext.broadcast(block)

        def scores(batches, whole=whole):
            best = Best(whole.value.n, k)
            for batch in batches:
                for at in range(0, batch.num_rows, SEGMENTS):
                    visit(batch.slice(at, SEGMENTS), whole.value, best)
            ids = pa.array(best.doc, pa.int64(), mask=best.doc == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(best.item), ids, pa.array(best.score)], ["item", "doc_id", "score"])

        names = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], f"item long, number long, item_id {kind}")
        hits = index.segments.mapInArrow(scores, "item long, doc_id long, score long")
        hits = _top(hits, "item", k).join(F.broadcast(names), "item")
        out = out.unionByName(hits.select(*out.columns))
    ranked = out.withColumn("rank", F.row_number().over(_order("number")).cast("int"))
    return ranked.select("item_id", "rank", "doc_id", "score")


def _order(key: str):
    return Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())


def _top(hits: DataFrame, key: str, k: int) -> DataFrame:
    return hits.withColumn("__rank", F.row_number().over(_order(key))).filter(F.col("__rank") <= k).drop("__rank")
