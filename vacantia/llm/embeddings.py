"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised, so cosine and distance say the same. A table hashes a vector by
some random Gaussian projections, each shifted and cut into steps of ``WIDTH``; near
vectors share the key of some table. Rows that share a key and a label are tested by
exact cosine in double precision, which joins them to components; within each component
all pairs are then counted exactly.

The projections of a table grow with the logarithm of the number of vectors, so that one
vector meets few unrelated ones (`per_table`); the tables are as many as it takes to miss a
pair at the least cosine with probability ``MISS`` (`tables`). Even then a link counts as
soon as its vectors are joined over any other path.

Equal vectors of a label form one row with a count, so copies cost nothing. Defined cases:
vectors that are null, empty, zero, or hold a null or a non-finite component, and rows with
a null label or id, link with nothing (component: their own id); vectors of different
length link with nothing; repeated rows count as other vectors of the same id.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vacantia.llm import pairs
from vacantia.llm.arrays import U64, mix, odd_constants
from vacantia.session import cut_lineage

LEAST = 0.98
WIDTH = 2.0
MISS = 1e-5
BLOCK = 1024
ROWS = 20_000  # rows of a task


def agree(cosine: float, width: float) -> float:
    """Probability that one projection puts two unit vectors of this cosine into one step."""
    r = width / math.sqrt(max(2 - 2 * cosine, 1e-12))
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_shape(n: int, least: float, width: float, miss: float) -> tuple[int, int]:
    """Projections of a table and number of tables for ``n`` vectors."""
    per_table = max(8, math.ceil(math.log(max(n, 2)) / -math.log(agree(0.0, width))))
    return per_table, math.ceil(math.log(miss) / math.log(1 - agree(least, width) ** per_table))


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of the vectors, all of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def keys(matrix: np.ndarray, seed: int, tables: int, per_table: int, width: float) -> np.ndarray:
    """One 64-bit key per vector and table."""
    n, d = matrix.shape
    rng = np.random.default_rng([seed, d])
    lines = rng.standard_normal((d, tables * per_table))
    shift = rng.uniform(0, width, tables * per_table)
    cells = np.floor((matrix @ lines + shift) / width).astype(np.int64).view(U64)
    out = np.zeros((n, tables), U64)
    for j, c in enumerate(odd_constants(per_table, 5)):
        out += mix(cells[:, j::per_table] + c) * c
    return mix(out + odd_constants(tables, 6)).view(np.int64)


def _hash(seed: int, tables: int, per_table: int, width: float):
    def run(batches):
        for batch in batches:
            ids, label = batch.column("vec_id"), batch.column("label")
            size = np.asarray(pa.compute.list_value_length(batch.column("unit")))
            for d in np.unique(size):
                which = np.flatnonzero(size == d)
                matrix = vectors(batch.column("unit").take(pa.array(which)))
                key = keys(matrix, seed, tables, per_table, width)
                lab = np.asarray(label.take(pa.array(which)).cast(pa.int64())).view(U64)
                key = mix(key.view(U64) + mix(lab)[:, None] + U64(d)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(which)),
                        pa.ListArray.from_arrays(np.arange(len(which) + 1, dtype=np.int32) * tables, key.ravel()),
                    ],
                    ["vec_id", "keys"],
                )

    return run


def _join(least: float):
    """Edges between rows that share a key and are near."""

    def run(table: pa.Table) -> pa.Table:
        order, start, count = pairs.runs(*(np.asarray(table.column(c)) for c in ("key", "low", "high")))
        ids = np.asarray(table.column("vec_id"))[order]
        label = np.asarray(table.column("label"))[order]
        matrix = vectors(table.column("unit").take(pa.array(order)))

        def near(a, b):
            return (label[a] == label[b]) & (np.einsum("ij,ij->i", matrix[a], matrix[b]) >= least)

        a, b = pairs.star_links(start, count, near)
        return pa.table({"a": ids[a], "b": ids[b]})

    return run


def _count(least: float):
    """For each row the weight of its links within the two blocks."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: np.asarray(table.column(c))
        order, start, count = pairs.runs(column("component"), column("low"), column("high"))
        ids, own, low, weight = (column(c)[order] for c in ("vec_id", "own", "low", "weight"))
        cross = low != column("high")[order]
        matrix = vectors(table.column("unit").take(pa.array(order)))
        links = np.zeros(len(order), np.int64)
        for a, n in zip(start.tolist(), count.tolist()):
            rows = slice(a, a + n)
            near = matrix[rows] @ matrix[rows].T
            # A product of matrices may round the last digit another way than a single one.
            for i, j in zip(*np.nonzero(np.abs(near - least) < 1e-9)):
                near[i, j] = np.einsum("i,i->", matrix[a + i], matrix[a + j])
            near = near >= least
            np.fill_diagonal(near, False)
            if cross[a]:
                near &= own[rows][:, None] != own[rows][None, :]
            links[rows] = near @ weight[rows]
        return pa.table({"vec_id": ids, "links": links})

    return run


def near_duplicates(
    embeddings: DataFrame, *, least: float = LEAST, width: float = WIDTH, miss: float = MISS,
    seed: int = 11, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: links, component (smallest reachable id) and whether it is kept."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    # Scaled by the largest component first, so that no square leaves the range of doubles.
    peak = F.array_max(F.transform("vector", F.abs))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    whole = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole & (F.size("vector") > 0)
    ).withColumn("peak", peak).filter("peak > 0")
    classes = usable.groupBy("label", "vector").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.min("peak").alias("peak")
    )
    scaled = classes.select(
        "vec_id", "label", "weight", F.transform("vector", lambda x: x / F.col("peak")).alias("scaled")
    ).withColumn("norm", norm)
    units = cut_lineage(
        scaled.select("vec_id", "label", "weight", F.transform("scaled", lambda x: x / F.col("norm")).alias("unit"))
    )
    n = units.count()
    per_table, tables = table_shape(n, least, width, miss)
    tasks = max(1, n * tables // ROWS)
    keyed = units.select("vec_id", "label", "unit").mapInArrow(
        _hash(seed, tables, per_table, width), "vec_id long, keys array<long>"
    ).select("vec_id", F.explode("keys").alias("key"))
    met = pairs.spread(keyed, "key", "vec_id", block=block, tasks=tasks, own_pairs=False)
    # A task's table is one matrix, so vectors of different length go to it apart.
    length = F.size("unit")
    edges = met.join(units.select("vec_id", "label", "unit"), "vec_id").withColumn("length", length)
    edges = edges.groupBy("task", "length").applyInArrow(_join(least), "a long, b long")
    joined = cut_lineage(pairs.components(edges).select(F.col("id").alias("vec_id"), "component"))
    inside = units.join(joined, "vec_id")
    met = pairs.spread(inside, "component", "vec_id", block=block, tasks=max(1, tasks // tables), own_pairs=True)
    links = met.withColumn("length", length).groupBy("task", "length").applyInArrow(
        _count(least), "vec_id long, links long"
    )
    links = links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    known = (
        units.select("vec_id", "weight").join(joined, "vec_id", "left").join(links, "vec_id", "left")
        .withColumnRenamed("vec_id", "first")
    )
    member = usable.join(
        classes.select("label", "vector", F.col("vec_id").alias("first")), ["label", "vector"]
    ).select("vec_id", "first")
    found = member.join(known, "first").select(
        "vec_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "first").alias("component_id"),
    )
    alone = rows.select("vec_id").exceptAll(member.select("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
