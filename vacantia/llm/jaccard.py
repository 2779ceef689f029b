"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Documents are sets of word shingles (``SHINGLE`` words, lower-cased as for benchmark
windows; a text of fewer words but not none is one shingle). Documents with one set form a
class. A class's MinHash values are banded; classes that share a band are compared, some
values at a time, and dropped as soon as the posterior probability that their similarity
reaches the threshold falls below ``EPSILON``. What stays joins classes to clusters; within
each cluster every pair is then verified on its shingles, which gives links and components.

Bands of 4 out of 112 values miss a pair at similarity 0.8 with probability 4e-7; the
pruning starts from a uniform prior. A pair counts also if its classes are joined over any
other path.

Defined cases: a null text, an empty one or one without words links with nothing; rows
without an id are compared with nothing and come back alone; rows that share an id are rows
of their own, each with the class of its own text, and each counts as a row in ``n_links``.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vacantia.llm import pairs
from vacantia.llm.arrays import U64, mix, odd_constants, parts, window_hashes
from vacantia.llm.contamination import lower_words
from vacantia.session import cut_lineage

SHINGLE = 5
LEAST = (4, 5)  # similarity, as a fraction
BANDS = 28
PER_BAND = 4
EPSILON = 1e-4
STEP = 16  # values compared before the next look at the posterior
FIRST_BANDS = 2  # bands whose components later bands need not compare again
BLOCK = 2048  # rows of a bucket that meet in a task
SET_BLOCK = 256  # the same where shingles are compared
ROWS = 20_000
SET_BYTES = 32 << 20  # of shingles in a task
PART_BYTES = 1 << 20


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their bounds."""
    words = lower_words(column)
    count = words.counts()
    some = np.flatnonzero(words.left() >= k)
    text, value = words.text[some], window_hashes(words.hash, k, 1)[some]
    short = np.flatnonzero((count > 0) & (count < k))
    own = np.array(
        [np.add.reduce(mix(words.hash[a:b] * odd_constants(k, 2)[: b - a])) for a, b in
         zip(words.bounds[short].tolist(), words.bounds[short + 1].tolist())], U64,
    )
    text, value = np.r_[text, short], np.r_[value, mix(own)]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, value = text[new], value[new]
    return value, np.searchsorted(text, np.arange(len(count) + 1))


def set_hashes(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    sums = [np.r_[U64(0), np.cumsum(v)] for v in (value, mix(value))]
    first, second = ((x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in sums)
    return first, second


def minhash(value: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of each set that is not empty (zeros for the others)."""
    out = np.zeros((len(bounds) - 1, n), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        small = (value >> U64(32)).astype(np.uint32)
        other = value.astype(np.uint32)
        start = bounds[full]
        a = odd_constants(n, 3)
        for j in range(n):
            # Two multipliers on two halves; the high bits decide the minimum.
            mixed = small * np.uint32(int(a[j]) & 0xFFFFFFFF) + other * np.uint32(int(a[j]) >> 32)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            out[full, j] = np.minimum.reduceat(mixed, start)
    return out


def least_matches(n: int, step: int, least: float, epsilon: float) -> np.ndarray:
    """For each look after ``step``, ``2 step``, ... values: the fewest that must agree.

    Values are compared by one byte, so two differing ones agree with probability 1/256;
    the prior over similarities is uniform.
    """
    grid = (np.arange(4000) + 0.5) / 4000
    agree = grid + (1 - grid) / 256
    out = []
    for seen in range(step, n + 1, step):
        for m in range(seen + 1):
            log = m * np.log(agree) + (seen - m) * np.log1p(-agree)
            weight = np.exp(log - log.max())
            if weight[grid >= least].sum() >= epsilon * weight.sum():
                break
        out.append(m)
    return np.array(out)


def _signatures(k: int, bands: int, per_band: int):
    n = bands * per_band

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                value, bounds = shingles(part.column("text"), k)
                sign = minhash(value, bounds, n)
                size = np.diff(bounds)
                first, second = set_hashes(value, bounds)
                band = np.zeros((len(size), bands), U64)
                for j, c in enumerate(odd_constants(per_band, 4)):
                    band += mix(sign[:, j::per_band].astype(U64) + c) * c
                band = mix(band + odd_constants(bands, 5)).view(np.int64)
                low = (sign & np.uint32(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_hash"), pa.array(size),
                        pa.array(first), pa.array(second),
                        pa.array([x.tobytes() for x in low], pa.binary()),
                        pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32) * bands, band.ravel()),
                    ],
                    ["doc_id", "text_hash", "n", "h1", "h2", "sign", "bands"],
                )

    return run


def bytes_matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _prune(enough: np.ndarray, least: tuple[int, int]):
    """Edges between parts of a bucket with rows that stay likely to reach the threshold."""
    p, q = least

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: np.asarray(table.column(c))
        # Stars around the smallest part, whatever order the rows come in: the same links each time.
        order, start, count = pairs.runs(
            column("key"), column("low"), column("high"), then=(column("part"), column("class_id"))
        )
        n = np.asarray(table.column("n"))[order]
        sign = bytes_matrix(table.column("sign"))[order]

        def likely(a, b):
            # Sets of such different sizes cannot be that similar.
            alive = np.flatnonzero(np.minimum(n[a], n[b]) * q >= np.maximum(n[a], n[b]) * p)
            agree = np.zeros(len(alive), np.int64)
            for look, m in enumerate(enough.tolist()):
                part = slice(look * STEP, (look + 1) * STEP)
                agree += (sign[a[alive], part] == sign[b[alive], part]).sum(axis=1)
                stay = agree >= m
                alive, agree = alive[stay], agree[stay]
            out = np.zeros(len(a), bool)
            out[alive] = True
            return out

        part = np.asarray(table.column("part"))[order]
        a, b = pairs.star_links(start, count, likely, part)
        a, b = np.unique(np.stack([part[a], part[b]]), axis=1)
        return pa.table({"a": a, "b": b})

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A shingle in one set only adds to no pair.
    column = np.cumsum(times > 1) - 1
    shared = times[inverse] > 1
    row, inverse = row[shared], column[inverse[shared]]
    order = np.argsort(inverse, kind="stable")
    row, inverse = row[order], inverse[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    width = max(1024, (1 << 22) // len(sets))
    for a in range(0, int(inverse[-1]) + 1 if len(inverse) else 0, width):
        low, high = np.searchsorted(inverse, [a, a + width])
        matrix = np.zeros((len(sets), min(width, int(inverse[-1]) + 1 - a)), np.float32)
        matrix[row[low:high], inverse[low:high] - a] = 1
        out += matrix @ matrix.T
    out = np.rint(out).astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _verify(least: tuple[int, int]):
    p, q = least

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: np.asarray(table.column(c))
        order, start, count = pairs.runs(column("cluster"), column("low"), column("high"), column("class_id"))
        order = order[start]  # rows that share an id are one
        group = [column(c)[order] for c in ("cluster", "low", "high")]
        _, start, count = pairs.runs(*group)
        ids, own, weight = (column(c)[order] for c in ("class_id", "own", "weight"))
        content = table.column("shingles")
        links, root = np.zeros(len(order), np.int64), ids.copy()
        for a, n in zip(start.tolist(), count.tolist()):
            rows = slice(a, a + n)
            sets = [np.frombuffer(content[int(i)].as_py(), U64) for i in order[rows]]
            size = np.array([len(s) for s in sets])
            both = overlaps(sets)
            near = both * q >= (size[:, None] + size[None, :] - both) * p
            np.fill_diagonal(near, False)
            if group[1][a] != group[2][a]:
                near &= own[rows][:, None] != own[rows][None, :]
            links[rows] = near @ weight[rows]
            root[rows] = ids[a + pairs.local_roots(n, *np.nonzero(near))]
        return pa.table({"class_id": ids, "links": links, "root": root})

    return run


def _shingle_rows(k: int):
    names = ["class_id", "cluster", "weight"]

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                value, bounds = shingles(part.column("text"), k)
                # An id may have texts of other classes as well.
                first, second = set_hashes(value, bounds)
                own = (first == np.asarray(part.column("h1"))) & (second == np.asarray(part.column("h2")))
                own &= np.diff(bounds) == np.asarray(part.column("n"))
                rows = np.flatnonzero(own)
                data = [value[a:b].tobytes() for a, b in zip(bounds[rows].tolist(), bounds[rows + 1].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(pa.array(rows)) for c in names] + [pa.array(data, pa.binary())],
                    [*names, "shingles"],
                )

    return run


def _rows(
    docs: DataFrame, *, shingle: int = SHINGLE, least: tuple[int, int] = LEAST, bands: int = BANDS,
    per_band: int = PER_BAND, epsilon: float = EPSILON, block: int = BLOCK, set_block: int = SET_BLOCK,
) -> DataFrame:
    """``similar`` with ``text_hash`` and ``component``, which tells components of one id apart."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = cut_lineage(
        texts.filter("doc_id IS NOT NULL").mapInArrow(
            _signatures(shingle, bands, per_band),
            "doc_id long, text_hash long, n long, h1 long, h2 long, sign binary, bands array<long>",
        )
    )
    same = ["n", "h1", "h2"]
    classes = signed.filter("n > 0").groupBy(*same).agg(
        F.min("doc_id").alias("first"), F.count("*").alias("weight"),
        F.min("sign").alias("sign"), F.min("bands").alias("bands"),
    )
    classes = cut_lineage(classes.withColumn("class_id", F.col("first")))
    # Where classes have their smallest id in common, all but one take a number of their own.
    several = cut_lineage(
        classes.groupBy("first").agg(F.count("*").alias("__n"), F.min(F.struct(*same)).alias("__of"))
        .filter("__n > 1").drop("__n")
    )
    repeated = not several.isEmpty()
    if repeated:
        other = F.col("__of").isNotNull() & (F.col("__of") != F.struct(*same))
        number = F.when(other, F.xxhash64("first", *same)).otherwise(F.col("first"))
        classes = cut_lineage(classes.join(several, "first", "left").withColumn("class_id", number).drop("__of"))
    rows, shingled = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = max(1, rows * bands // ROWS)
    enough = least_matches(bands * per_band, STEP, least[0] / least[1], epsilon)
    # The first bands join most of what is alike. The others compare only what is still
    # apart, so large groups of near copies are not linked anew in every band.
    parts_ = classes.select("class_id", F.col("class_id").alias("part"))
    for begin, end in ((0, FIRST_BANDS), (FIRST_BANDS, bands)):
        some = F.explode(F.slice("bands", begin + 1, end - begin)).alias("key")
        banded = classes.join(parts_, "class_id").select("class_id", "part", some)
        met = pairs.spread(
            banded, "key", "class_id", block=block, tasks=tasks, own_pairs=False, part="part"
        )
        edges = met.join(classes.select("class_id", "n", "sign"), "class_id").groupBy("task").applyInArrow(
            _prune(enough, least), "a long, b long"
        )
        joined = pairs.components(edges)
        parts_ = cut_lineage(
            parts_.join(joined, F.col("part") == F.col("id"), "left")
            .select("class_id", F.coalesce("component", "part").alias("part"))
        )
    several = parts_.groupBy(F.col("part").alias("cluster")).agg(F.count("*").alias("size")).filter("size > 1")
    clusters = parts_.withColumnRenamed("part", "cluster").join(several.select("cluster"), "cluster")
    inside = clusters.join(classes.select("class_id", "first", "weight", *same), "class_id")
    sets = texts.select(F.col("doc_id").alias("first"), "text").join(inside, "first").mapInArrow(
        _shingle_rows(shingle), "class_id long, cluster long, weight long, shingles binary"
    )
    # Written once, as the dealing to blocks counts its groups first.
    sets = cut_lineage(sets)
    met = pairs.spread(
        sets, "cluster", "class_id", block=set_block, tasks=max(1, rows // ROWS, 8 * shingled // SET_BYTES),
        own_pairs=True, size=F.octet_length("shingles"), block_bytes=8 << 20,
    )
    verified = cut_lineage(met.groupBy("task").applyInArrow(_verify(least), "class_id long, links long, root long"))
    links = verified.groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = pairs.components(verified.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select(*same, "class_id", "first", "weight").join(links, "class_id", "left")
        .join(joined.withColumnRenamed("id", "class_id"), "class_id", "left")
        .select(
            *same, F.col("first").alias("class_id"),
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class_id").alias("component"),
        )
    )
    if repeated:
        least_id = known.groupBy("component").agg(F.min("class_id").alias("component_id"))
        known = known.join(least_id, "component")
    else:
        known = known.withColumn("component_id", F.col("component"))
    out = ["doc_id", "text_hash", "class_id", "n_links", "component", "component_id"]
    ids = signed.select("doc_id", "text_hash", *same)
    found = ids.filter("n > 0").join(known, same).select(*out)
    alone = ids.filter("n = 0").select("doc_id", "text_hash")
    alone = alone.unionAll(texts.filter("doc_id IS NULL").select("doc_id", "text_hash"))
    # Without words: no component, so that nothing is dropped for them.
    none = F.lit(None).cast("long")
    return found.unionAll(
        alone.select(
            "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
            none.alias("component"), F.col("doc_id").alias("component_id"),
        )
    )


def similar(docs: DataFrame, **options) -> DataFrame:
    """One row per document: class, links (other documents as similar), component.

    ``class_id`` is the smallest id with the same shingles, ``component_id`` the smallest
    one reachable over links. Options are the constants above, by name.
    """
    return _rows(docs, **options).select("doc_id", "class_id", "n_links", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without documents that are similar to one of smaller id, over any path.

    Of rows that share the smallest id of a component one stays, that of the smallest hash of
    the text, and one of equal texts; a row with that id and an unrelated text is another
    component. Rows without an id or without words all stay.
    """
    found = _rows(docs, **options).filter("component IS NOT NULL")
    found = cut_lineage(found.select("doc_id", "text_hash", "component", "component_id"))
    heads = found.filter("doc_id = component_id")
    more = heads.groupBy("component").agg(F.count("*").alias("__n"), F.min("text_hash").alias("__stays")).filter("__n > 1")
    more = cut_lineage(heads.join(more.drop("__n"), "component").select("doc_id", "text_hash", "__stays").distinct())
    gone = found.filter("doc_id <> component_id").select("doc_id", "text_hash")
    gone = gone.unionAll(more.filter("text_hash <> __stays").select("doc_id", "text_hash"))
    row = lambda t: (docs["doc_id"] == t["__id"]) & (F.xxhash64(docs["text"]) == t["__hash"])
    named = lambda t: t.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    gone = named(gone)
    kept = docs.join(gone, row(gone), "left_anti")
    if more.isEmpty():
        return kept
    twice = named(more.filter("text_hash = __stays"))
    order = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*docs.columns))
    once = kept.join(twice, row(twice), "left_semi").withColumn("__row", F.row_number().over(order))
    return kept.join(twice, row(twice), "left_anti").unionAll(once.filter("__row = 1").drop("__row"))
