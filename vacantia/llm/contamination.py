"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each task cuts its documents into shards, numbers their words by the benchmark's
vocabulary and sorts the suffixes that can begin a match (a suffix array of the shard).
Every benchmark suffix and every window is then binary-searched in it: windows give all
their occurrences, suffixes give the longest verbatim match and where it lies.

A window is ``window`` consecutive words of an item; an item of fewer words (but not
none) is one window. A document is contaminated when ``share`` of its words or more lie
in occurrences of windows.

Defined cases: a null or empty text has no words and is never contaminated; a null item
text has no windows; a window of an item whose id is null counts as hit, but is listed
under no id; a repeated document row gets the same result each time, a repeated item id
counts once. Columns of other meaning pass through untouched whatever their names.

The benchmark reaches the tasks in blocks of at most ``block_bytes`` of text (plus one
item), so what is broadcast is bounded whatever its size. With more than one block the
documents pass through one scan per block, with a checkpoint between.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia.llm.arrays import (
    ALNUM, LOWER, U64, Words, covered, expand, parts, text_bytes, unique_pairs,
)
from vacantia.session import cut_lineage

WINDOW = 13
SHARE = 20  # contaminated from one word in so many
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
_IDS_PER_KEY = 3
_BITS = U64(21)  # three word numbers to a 64-bit key; a block holds fewer than 2**21 words

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def lower_words(column: pa.Array) -> Words:
    buf, offsets = text_bytes(column)
    return Words(LOWER[buf], offsets, ALNUM)


class Keys:
    """Reads word numbers as packed keys; places beyond the end read as 0."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.concatenate([ids, np.zeros(_IDS_PER_KEY, np.int64)]).astype(U64)
        self.n = len(ids)

    def at(self, place: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
        """Keys at ``place``; of them only the first ``room`` words count, if given."""
        out = np.zeros(len(place), U64)
        for j in range(_IDS_PER_KEY):
            word = self.ids[np.minimum(place + j, self.n)]
            if room is not None:
                word = np.where(j < room, word, U64(0))
            out = (out << _BITS) | word
        return out


def cut_at_zero(key: np.ndarray) -> np.ndarray:
    """Drops what follows a 0 (the end of a suffix) inside a key."""
    low = (U64(1) << _BITS) - U64(1)
    first, second = key >> (_BITS + _BITS), (key >> _BITS) & low
    key = np.where(second == 0, key & ~low, key)
    return np.where(first == 0, U64(0), key)


def suffix_array(keys: Keys, places: np.ndarray) -> np.ndarray:
    """``places`` in the order of the suffixes that start there; a suffix ends at a 0."""
    order = np.arange(len(places))
    group = np.zeros(len(places), np.int64)  # of each slot of order
    active = np.arange(len(places))  # slots still tied
    depth = 0
    while len(active) > 1:
        who = order[active]
        key = cut_at_zero(keys.at(places[who] + depth))
        by = np.lexsort((key, group[active]))
        order[active] = who[by]
        key, g = key[by], group[active]
        new = np.r_[True, (g[1:] != g[:-1]) | (key[1:] != key[:-1])]
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        ended = key & ((U64(1) << _BITS) - U64(1)) == 0
        tied = ~new | ~np.r_[new[1:], True]
        active = active[tied & ~ended]
        depth += _IDS_PER_KEY
    return places[order]


def compare(
    query: Keys, at: np.ndarray, size: np.ndarray, shard: Keys, place: np.ndarray, whole: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Order (-1, 0, 1) of query suffixes against shard suffixes, and their common words.

    Only the first ``size`` words of a query count. With ``whole`` a shard suffix that goes
    on after them is larger, else it is equal.
    """
    order, common = np.zeros(len(at), np.int8), np.zeros(len(at), np.int64)
    todo, depth = np.arange(len(at)), 0
    while len(todo):
        room = size[todo] - depth
        a = query.at(at[todo] + depth, room)
        b = cut_at_zero(shard.at(place[todo] + depth))
        if not whole:
            b = np.where(room < _IDS_PER_KEY, _first(b, room), b)
        order[todo] = np.where(a < b, -1, np.where(a > b, 1, 0))
        differs = a ^ b
        same = np.zeros(len(todo), np.int64)
        for j in range(_IDS_PER_KEY, 0, -1):
            same = np.where(differs >> (_BITS * U64(_IDS_PER_KEY - j)) == 0, np.maximum(same, j), same)
        common[todo] += np.minimum(same, np.maximum(room, 0))
        todo = todo[(a == b) & (room > _IDS_PER_KEY)]
        depth += _IDS_PER_KEY
    return order, common


def _first(key: np.ndarray, room: np.ndarray) -> np.ndarray:
    drop = _BITS * (_IDS_PER_KEY - np.clip(room, 0, _IDS_PER_KEY)).astype(U64)
    return (key >> drop) << drop


def search(
    query: Keys, at: np.ndarray, size: np.ndarray, shard: Keys, array: np.ndarray,
    *, after_equal: bool = False, whole: bool = False,
) -> np.ndarray:
    """Binary search of all queries at once: where each would be inserted."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    while (open_ := low < high).any():
        todo = np.flatnonzero(open_)
        middle = (low[todo] + high[todo]) >> 1
        order, _ = compare(query, at[todo], size[todo], shard, array[middle], whole)
        right = (order > 0) | (after_equal & (order == 0))
        low[todo[right]] = middle[right] + 1
        high[todo[~right]] = middle[~right]
    return low


class Block:
    """Some benchmark items, ready to be searched for."""

    def __init__(self, item_ids: list[str | None], texts: list[str | None], window: int):
        words = lower_words(pa.array(texts, pa.large_string()))
        self.vocabulary, ids = np.unique(words.hash, return_inverse=True)
        if len(self.vocabulary) >= 1 << int(_BITS):
            raise ValueError("a benchmark block holds too many different words")
        self.names = item_ids
        self.item = words.text
        self.first = words.bounds[:-1]
        self.ids = ids.astype(np.int64) + 1
        size = words.counts()
        left = words.left()
        # A window starts wherever it fits, and at the start of a shorter item.
        short = (size < window)[words.text] & (np.arange(len(ids)) == words.bounds[words.text])
        starts = np.flatnonzero((left >= window) | short)
        length = np.minimum(left[starts], window)
        keys, group = Keys(self.ids), np.zeros(len(starts), np.int64)
        for depth in range(0, window, _IDS_PER_KEY):
            key = keys.at(starts + depth, length - depth)
            group = np.unique(np.stack([group.astype(U64), key]), axis=1, return_inverse=True)[1].ravel()
        _, rep, self.of_start = np.unique(group, return_index=True, return_inverse=True)
        self.window_at, self.window_size = starts[rep], length[rep]
        self.starts = starts
        self.left = left
        self.shortest = int(self.window_size.min()) if len(rep) else 0
        pairs = unique_pairs(self.of_start.astype(np.int64), self.item[starts])
        self.items_of = pairs[1]
        self.items_at = np.searchsorted(pairs[0], np.arange(len(rep) + 1))
        inside = np.flatnonzero(self.item[1:] == self.item[:-1])
        self.bigrams = np.unique(self.ids[inside] << 32 | self.ids[inside + 1])


def member(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values if len(of) else np.zeros(len(values), bool), at


class Shard:
    """Suffix array of some documents, over the suffixes that can match a whole window."""

    def __init__(self, texts: pa.Array, block: Block):
        self.words = w = lower_words(texts)
        known, at = member(w.hash, block.vocabulary)
        ids = np.where(known, at + 1, 0).astype(np.int64)
        # A 0 after each text ends its suffixes.
        self.place = np.arange(len(ids)) + w.text
        stream = np.zeros(len(ids) + len(w.bounds), np.int64)
        stream[self.place] = ids
        self.keys = Keys(stream)
        pair, _ = member(stream[:-1] << 32 | stream[1:], block.bigrams)
        # Words from each place on that follow one another somewhere in the benchmark.
        n = len(stream)
        stop = np.where(np.r_[pair, False], n, np.arange(n))
        reach = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n) + 1
        can = (stream > 0) & (reach >= max(1, block.shortest))
        self.array = suffix_array(self.keys, np.flatnonzero(can))
        self.word_of = np.full(n, -1, np.int64)
        self.word_of[self.place] = np.arange(len(ids))

    def occurrences(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(word, window) of all occurrences of the block's windows."""
        query = Keys(block.ids)
        q = block.window_at, block.window_size
        low = search(query, *q, self.keys, self.array)
        high = search(query, *q, self.keys, self.array, after_equal=True)
        slot, window = expand(low, high - low)
        return self.word_of[self.array[slot]], window

    def longest(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(benchmark word, words in common, document word) of each suffix's best match."""
        query = Keys(block.ids)
        at = block.starts
        slot = search(query, at, block.left[at], self.keys, self.array, whole=True)
        best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for neighbour in (slot - 1, slot):
            ok = np.flatnonzero((neighbour >= 0) & (neighbour < len(self.array)))
            place = self.array[neighbour[ok]]
            _, common = compare(query, at[ok], block.left[at[ok]], self.keys, place, True)
            better = common > best[ok]
            best[ok[better]], where[ok[better]] = common[better], place[better]
        good = best >= np.minimum(block.left[at], WINDOW)
        return at[good], best[good], self.word_of[where[good]]


def blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark, one bounded block after another."""
    ids, texts, size = [], [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        ids.append(item_id)
        texts.append(text)
        size += len((text or "").encode())
        if size >= block_bytes:
            yield Block(ids, texts, window)
            ids, texts, size = [], [], 0
    yield Block(ids, texts, window)


def _find(texts: pa.Array, block: Block, before: list | None) -> list[dict]:
    """For each text: number of words, hit runs of words, items found, over the blocks so far."""
    shard = Shard(texts, block)
    words = shard.words
    word, window = shard.occurrences(block)
    start, end = [word], [word + block.window_size[window]]
    text, which = unique_pairs(words.text[word], window)
    slot, of = expand(block.items_at[which], np.diff(block.items_at)[which])
    text, item = unique_pairs(text[of], block.items_of[slot])
    items: dict[int, set] = {}
    for t, i in zip(text.tolist(), item.tolist()):
        items.setdefault(t, set()).add(block.names[i])
    for t, old in enumerate(before or ()):
        if old and old["items"]:
            items.setdefault(t, set()).update(old["items"])
        for span in (old or {}).get("spans") or ():
            start.append(np.array([span["start"] + words.bounds[t]]))
            end.append(np.array([span["end"] + words.bounds[t]]))
    n = len(words.start)
    hit = covered(n, np.concatenate(start), np.concatenate(end))
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    # Runs of two texts that touch are two runs.
    run_start, run_end = edge[::2], edge[1::2]
    spans: dict[int, list] = {}
    for a, b in zip(run_start.tolist(), run_end.tolist()):
        while a < b:
            t = int(words.text[a])
            stop = min(b, int(words.bounds[t + 1]))
            first = int(words.bounds[t])
            spans.setdefault(t, []).append({"start": a - first, "end": stop - first})
            a = stop
    return [
        {
            "n_words": int(n), "spans": spans.get(t, []),
            "items": sorted(x for x in items.get(t, ()) if x is not None),
        }
        for t, n in enumerate(words.counts().tolist())
    ]


def free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def find(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned) of ``FOUND``."""
    spark = docs.sparkSession
    name = free_name(docs, "__found")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
    )
    place = docs.columns.index(text)

    def scan(of, first):
        def run(batches):
            for batch in batches:
                # Nested columns may have clashing names, so parts are cut by position.
                inner = pa.RecordBatch.from_arrays([batch.column(place)], ["text"])
                done = 0
                for part in parts(inner, "text", shard_bytes):
                    rows = batch.slice(done, part.num_rows)
                    done += part.num_rows
                    before = None if first else rows.column(rows.num_columns - 1).to_pylist()
                    found = _find(part.column(0), of.value, before)
                    columns = rows.columns if first else rows.columns[:-1]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(found, kind)], [f.name for f in schema.fields]
                    )

        return run

    out, first = docs, True
    for block in blocks(benchmark, window, block_bytes):
        if not first:
            out = cut_lineage(out)
        shared = spark.sparkContext.broadcast(block)
        out = out.mapInArrow(scan(shared, first), schema)
        first = False
    return out, name


def hit_words(found: str) -> Column:
    return F.aggregate(
        F.col(f"`{found}`.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )


def is_contaminated(found: str, share: int = SHARE) -> Column:
    hits = hit_words(found)
    return (hits > 0) & (hits * share >= F.col(f"`{found}`.n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: words, hit words, items found, verdict, and the hit runs."""
    out, name = find(docs.select("doc_id", "text"), benchmark, **options)
    items = F.col(f"{name}.items")
    return out.select(
        "doc_id", F.col(f"{name}.n_words").alias("n_words"), hit_words(name).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(name).alias("contaminated"), F.col(f"{name}.spans").alias("spans"),
        items.alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; same columns."""
    out, name = find(docs, benchmark, **options)
    return out.filter(~is_contaminated(name)).drop(name)


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The longest verbatim match of each benchmark suffix over all shards, and where.

    Only matches that hold a whole window are listed. Of equally long ones the smallest
    ``(doc_id, doc_word)`` counts.
    """
    spark = docs.sparkSession
    schema = "item_id string, item_word long, n_words long, doc_id long, doc_word long"

    def scan(of):
        def run(batches):
            for batch in batches:
                for part in parts(batch, "text", shard_bytes):
                    block, shard = of.value, Shard(part.column("text"), of.value)
                    at, size, word = shard.longest(block)
                    text = shard.words.text[word]
                    ids = part.column("doc_id").take(pa.array(text))
                    item = block.item[at]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.names[i] for i in item], pa.string()),
                            pa.array(at - block.first[item]), pa.array(size), ids.cast(pa.int64()),
                            pa.array(word - shard.words.bounds[text]),
                        ],
                        ["item_id", "item_word", "n_words", "doc_id", "doc_word"],
                    )

        return run

    found = None
    for block in blocks(benchmark, window, block_bytes):
        one = docs.select("doc_id", "text").mapInArrow(scan(spark.sparkContext.broadcast(block)), schema)
        found = one if found is None else found.unionByName(one)
    best = F.min(F.struct((-F.col("n_words")).alias("less"), "doc_id", "doc_word")).alias("best")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", (-F.col("best.less")).alias("n_words"), "best.doc_id", "best.doc_word"
    )
