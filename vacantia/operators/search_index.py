"""Stored index for faceted search: written by day, appended, searched without the texts.

Below a root, each day publishes (see `sinks.publish`, all visible together):

* ``postings``: one row per term and block of rows, with ``n``, the greatest ``tf`` and the
  least length in it, and the rows themselves (number, key, tf, length, facet values),
  by bucket of the term's hash and sorted by term; bucket ``ALL`` lists, under no term, all
  rows of each block;
* ``terms``: document frequency of each term, in the same buckets;
* ``rows``: key, length, number and facet values of each row;
* ``bitmaps``: for each facet value and block the rows that have it;
* ``totals``: number of rows and of words.

A block is about ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` of text, whichever is less, dealt by the
hash of the key, so no list and no task's memory grows with the table. A search reads the buckets of its words. It scores the blocks of the highest bounds
first, takes the score of the last row wanted as a threshold, and reads of the other blocks
only those whose bound reaches it.

A key that comes more than once in a day is one row of it; rows without a key are not
indexed. Days hold different keys.
"""

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacantia import fixed_values as V
from vacantia.functions.once import evaluate_once
from vacantia.operators.merge import first_per_key
from vacantia.operators.search import WORD_SEPARATOR, query_terms
from vacantia.sinks import publish
from vacantia.sinks.publish import Publication

BUCKETS = 64
ALL = -1
BLOCK_ROWS = 1 << 14  # on average; a bitmap holds twice as many
BLOCK_BYTES = 1 << 24  # on average, too
MOST_SLOTS = 1 << 15
BATCH_POSTINGS = 1 << 18
TASK_BLOCKS = 4
FIRST_BLOCKS = 4
K1, B = 1.2, 0.75


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _facet(name: str) -> str:
    return f"f_{name}"


def _numbered(rows: DataFrame, blocks: int, tasks: int, once: bool) -> DataFrame:
    """One row per key with ``block`` and ``slot``; all rows of a block come to one task.

    With ``once`` keys are known not to repeat, so the rows move by block alone.
    """
    if not once:
        # A key that repeats is cut to one row a task before it moves.
        rows = first_per_key(rows, ["key"], [F.col("bytes").desc(), F.col("hash")])
    placed = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).repartitionById(tasks, F.col("block"))
    # Numbered inside the block: a window of bounded size.
    placed = placed.withColumn("slot", F.expr("row_number() OVER (PARTITION BY block ORDER BY key) - 1"))
    full = F.raise_error(F.lit("a block holds more rows than a bitmap")).cast("int")
    return placed.withColumn("slot", F.when(F.col("slot") < MOST_SLOTS, F.col("slot")).otherwise(full)).drop("bytes", "hash")


def _spaced(text: Column) -> Column:
    """The lower-cased words, with one space between two of them."""
    return F.trim(F.regexp_replace(F.lower(text), WORD_SEPARATOR, " "))


def _postings(kept: list[str]) -> Callable[[pa.Table], pa.Table]:
    """Of the rows of a block, one row per term with its postings by slot, and one, without a term, of all rows."""
    def collect(rows: pa.Table) -> pa.Table:
        spaced, rows = rows.column("spaced").cast(pa.large_string()), rows.drop_columns(["spaced"])
        order = np.argsort(rows.column("slot").to_numpy())
        spaced, rows = spaced.combine_chunks().take(order), rows.take(order).combine_chunks()
        split = pc.split_pattern(pc.if_else(pc.equal(spaced, ""), None, spaced), " ")
        words = split.flatten().dictionary_encode()
        length = np.diff(split.offsets.to_numpy()).astype(np.int32)
        # A word and its row as one number: sorted, the places of a word in a row lie together.
        placed = words.indices.to_numpy().astype(np.int64) * MOST_SLOTS + np.repeat(np.arange(len(length)), length)
        placed.sort()
        first = np.flatnonzero(np.diff(placed, prepend=-1))
        tf = np.diff(first, append=len(placed)).astype(np.int32)
        term, row = np.divmod(placed[first], MOST_SLOTS)
        start = np.flatnonzero(np.diff(term, prepend=-1))
        # The rows themselves follow the last term.
        start, row, tf = np.r_[start, len(row)], np.r_[row, np.arange(len(length))], np.r_[tf, np.zeros_like(length)]
        terms = pa.concat_arrays([words.dictionary.cast(pa.string()), pa.nulls(1, pa.string())])
        n, max_tf, min_len = np.diff(start, append=len(row)), np.maximum.reduceat(tf, start), np.minimum.reduceat(length[row], start)
        # In batches: what rows hold is repeated in their postings.
        cut = np.unique(np.r_[np.searchsorted(start, np.arange(0, len(row), BATCH_POSTINGS)), len(start)])
        batches = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            some = slice(start[a], start[a] + n[a:b].sum())
            own = rows.take(row[some]).combine_chunks()
            entries = {c: own.column(c).combine_chunks() for c in ("slot", "key", *kept)}
            entries = {"slot": entries.pop("slot"), "key": entries.pop("key"), "tf": pa.array(tf[some]), "len": pa.array(length[row[some]]), **entries}
            postings = pa.StructArray.from_arrays(list(entries.values()), names=list(entries))
            batches.append(pa.record_batch({
                "term": terms[a:b], "block": rows.column("block").combine_chunks().take(np.zeros(b - a, np.int64)),
                "n": n[a:b], "max_tf": max_tf[a:b], "min_len": min_len[a:b],
                "postings": pa.ListArray.from_arrays((np.r_[start[a:b], some.stop] - some.start).astype(np.int32), postings),
            }))
        return pa.Table.from_batches(batches)

    return collect


def write_day(
    df: DataFrame, text: Column, root: str, day: str, *, key: str, facets: dict[str, str], block_rows: int = BLOCK_ROWS
) -> None:
    """Index the rows of one day; a repeated day replaces its own index.

    The texts move once, as words, to the task of their block (twice where keys repeat); words
    are counted and postings collected there, block by block, so no posting is shuffled.
    """
    spark = df.sparkSession
    names = [_facet(f) for f in facets]
    body = F.coalesce(text, F.lit(""))
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), body.alias("text"), *[F.col(c).cast("string").alias(_facet(f)) for f, c in facets.items()]
    ).withColumns({"bytes": F.octet_length("text"), "hash": F.xxhash64("text", *names)})
    run = Publication(spark, root, day, "day")
    keyed, different, size = rows.agg(F.count("*"), F.count_distinct("key"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    blocks = max(1, -(-keyed // block_rows), -(-size // BLOCK_BYTES))
    # Each task writes a file per bucket: beyond the session's parallelism a task takes several blocks.
    tasks = min(blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks // TASK_BLOCKS))
    words = _numbered(evaluate_once(rows, spaced=_spaced(F.col("text"))).drop("text"), blocks, tasks, different == keyed)
    # Columns that are never null come back from a task as any other.
    posting = T.StructType([
        T.StructField("slot", T.IntegerType()), T.StructField("key", words.schema["key"].dataType), T.StructField("tf", T.IntegerType()),
        T.StructField("len", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in names],
    ])
    schema = T.StructType([
        T.StructField("term", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("max_tf", T.IntegerType()), T.StructField("min_len", T.IntegerType()), T.StructField("postings", T.ArrayType(posting)),
    ])
    collected = words.groupBy("block").applyInArrow(_postings(names), schema)
    bucket = F.when(F.col("term").isNull(), ALL).otherwise(_bucket(F.col("term")))
    postings = collected.select("term", "block", bucket.alias("bucket"), "n", "max_tf", "min_len", "postings")
    path = run.folder("postings")
    postings.sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(path)
    written = spark.read.schema(postings.schema).parquet(path)
    listed = written.filter(F.col("bucket") == ALL).select("block", F.inline("postings"))
    stored = spark.read.parquet(run.write("rows", listed.select("key", "len", *names, "block", "slot")))
    run.write("totals", stored.agg(F.count("*").alias("n"), F.coalesce(F.sum("len"), F.lit(0)).alias("words")))
    frequencies = written.filter(F.col("bucket") != ALL).groupBy("bucket", "term").agg(F.sum("n").alias("n"))
    frequencies.repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(
        run.folder("terms"))
    entries = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(_facet(f)).alias("value")) for f in facets])
    maps = (
        stored.select("block", "slot", F.explode(entries).alias("e")).select("block", "slot", "e.*").filter("value IS NOT NULL")
        .groupBy("facet", "value", "block")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"), F.count("*").alias("n"))
    ) if facets else spark.createDataFrame([], "facet string, value string, block int, bits binary, n long")
    run.write("bitmaps", maps.repartitionByRange("facet", "value", "block").sortWithinPartitions("facet", "value", "block"))
    run.commit()


def _read(spark: SparkSession, root: str, table: str) -> DataFrame:
    out = publish.read(spark, root, table, "day")
    if out is None:
        raise ValueError(f"no index at {root}")
    return out.withColumn("day", F.col("day").cast("string"))


def restrictions(spark: SparkSession, root: str, selected: dict[str, list[str]]) -> dict[str, list[str]]:
    """The facets that restrict: those with values chosen, but not every existing one."""
    chosen = {f: list(dict.fromkeys(v)) for f, v in selected.items() if v}
    if not chosen:
        return {}
    existing = _read(spark, root, "bitmaps").filter(F.col("facet").isin(list(chosen))).groupBy("facet").agg(
        F.count_distinct("value").alias("n")
    )
    number = dict(map(tuple, existing.collect()))  # one row per facet chosen
    return {f: v for f, v in chosen.items() if len(v) < number.get(f, 0)}


def _allowed(restricted: dict[str, list[str]]) -> Column:
    out = F.lit(True)
    for facet, values in restricted.items():
        out = out & F.coalesce(F.col(_facet(facet)).isin(values), F.lit(False))
    return out


def _share(idf: Column, tf: Column, length: Column, mean: float) -> Column:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(mean)))


def search(
    spark: SparkSession,
    root: str,
    query: str,
    *,
    facets: list[str],
    selected: dict[str, list[str]] | None = None,
    page: int | None = 1,
    page_size: int = V.SEARCH_PAGE_SIZE,
    first_blocks: int = FIRST_BLOCKS,
) -> DataFrame:
    """``key``, facet values and ``score`` of the rows that hold every word, as `search.search` ranks.

    OR inside a facet, AND across. An empty query matches everything, in key order.
    """
    restricted = restrictions(spark, root, selected or {})
    names = [_facet(f) for f in facets]
    shown = [F.col(_facet(f)).alias(f) for f in facets]
    terms = query_terms(query)
    if not terms:
        rows = _read(spark, root, "rows").filter(_allowed(restricted)).select("key", *shown, F.lit(0.0).alias("score"))
        return rows if page is None else rows.orderBy("key").offset((page - 1) * page_size).limit(page_size)
    buckets = list(spark.range(1).select(*[_bucket(F.lit(t)) for t in terms]).first())
    wanted = F.col("bucket").isin(buckets) & F.col("term").isin(terms)
    totals = _read(spark, root, "totals").agg(F.sum("n"), F.sum("words")).first()
    n, mean = totals[0], totals[1] / totals[0] if totals[0] else 0.0
    found = publish.read(spark, root, "terms", "day")
    found = [] if found is None else found.filter(wanted).groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = dict(map(tuple, found))  # at most one row a word of the query
    if len(df) < len(terms):
        return _read(spark, root, "rows").filter(F.lit(False)).select("key", *shown, F.lit(0.0).alias("score"))
    postings = _read(spark, root, "postings").filter(wanted)
    weight = {t: math.log(1.0 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in terms}
    idf = F.coalesce(*[F.when(F.col("term") == t, F.lit(w)) for t, w in weight.items()])

    def scored(rows: DataFrame) -> DataFrame:
        flat = rows.select("day", "block", "term", F.inline("postings")).filter(_allowed(restricted))
        by_row = flat.groupBy("day", "block", "slot").agg(
            *[F.max(F.when(F.col("term") == t, F.col("tf"))).alias(f"tf{i}") for i, t in enumerate(terms)],
            *[F.any_value(c).alias(c) for c in ("key", "len", *names)],
        )
        score = F.lit(0.0)
        for i, t in enumerate(terms):
            by_row = by_row.filter(F.col(f"tf{i}").isNotNull())
            score = score + _share(F.lit(weight[t]), F.col(f"tf{i}").cast("double"), F.col("len"), mean)
        return by_row.select("key", *shown, score.alias("score"))

    if page is None:
        return scored(postings)
    order, last = [F.round("score", 9).desc(), F.col("key")], page * page_size
    # What a block can reach at most; only headers are read for it.
    bound = F.sum(_share(idf, F.col("max_tf").cast("double"), F.col("min_len"), mean))
    heads = postings.groupBy("day", "block").agg(bound.alias("bound"), F.count("*").alias("terms")).filter(F.col("terms") == len(terms))
    best = heads.orderBy(F.col("bound").desc(), "day", "block").limit(first_blocks).collect()
    chosen = F.lit(False)
    for r in best:
        chosen = chosen | ((F.col("day") == r["day"]) & (F.col("block") == r["block"]))
    if len(best) < first_blocks:  # that is all of them
        return scored(postings.filter(chosen)).orderBy(*order).offset(last - page_size).limit(page_size)
    top = scored(postings.filter(chosen)).orderBy(*order).limit(last).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    if top["n"] == last:
        able = heads.filter(F.round("bound", 9) >= F.round(F.lit(top["least"]), 9)).select("day", "block")
        postings = postings.join(able, ["day", "block"], "left_semi")
    return scored(postings).orderBy(*order).offset(last - page_size).limit(page_size)


def facet_counts(spark: SparkSession, root: str, selected: dict[str, list[str]] | None = None) -> DataFrame:
    """``(facet, value, n)`` of the rows of a selection, from the bitmaps alone.

    Null and empty values are skipped, and values that no row of the selection has.
    """
    maps = _read(spark, root, "bitmaps").filter("value <> ''")
    restricted = restrictions(spark, root, selected or {})
    if not restricted:
        return maps.groupBy("facet", "value").agg(F.sum("n").alias("n"))
    some = F.lit(False)
    for facet, values in restricted.items():
        some = some | ((F.col("facet") == facet) & F.col("value").isin(values))
    # OR inside a facet, AND across those that restrict; a block without one of them has no rows.
    either = _read(spark, root, "bitmaps").filter(some).groupBy("day", "block", "facet").agg(F.bitmap_or_agg("bits").alias("bits"))
    chosen = either.groupBy("day", "block").agg(F.bitmap_and_agg("bits").alias("chosen"), F.count("*").alias("facets")).filter(
        F.col("facets") == len(restricted)
    )
    both = maps.join(chosen, ["day", "block"]).select("facet", "value", "day", "block", F.explode(F.array("bits", "chosen")).alias("bits"))
    return (
        both.groupBy("facet", "value", "day", "block").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
        .groupBy("facet", "value").agg(F.sum("n").alias("n")).filter("n > 0")
    )
