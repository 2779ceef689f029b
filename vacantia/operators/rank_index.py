"""Stored ranking: a table written in order once, of which a page reads one or two folders.

``write`` sorts by ranges and writes each range as a folder with the number of each row in it;
how many rows lie before a folder, and where each group starts, is published with it. A page
or a group's page is then a range of ranks: the folders that hold it are looked up in a table
of one row per range, and nothing is sorted, numbered or checkpointed at query time. A ranking
without rows has no folders, and reading it says so.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vacantia import fixed_values as V
from vacantia.sinks import publish
from vacantia.sinks.publish import Publication

_ROW = (1 << 33) - 1


def write(
    df: DataFrame, order: list[Column], root: str, version: str, *, group: str | None = None, ranges: int | None = None
) -> None:
    """Publish ``df`` ranked by a total ``order``; with ``group``, by group and then by it.

    A hot group is many ranges, since the order inside it is part of the sort.
    """
    run = Publication(df.sparkSession, root, version, "version")
    by = [*([F.col(group).asc_nulls_first()] if group else []), *order]
    ordered = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by) if ranges else df.orderBy(*by)
    placed = ordered.withColumn("__id", F.monotonically_increasing_id()).withColumns(
        {"__part": F.shiftright("__id", 33).cast("int"), "__row": F.col("__id").bitwiseAND(F.lit(_ROW))}
    ).drop("__id")
    path = run.folder("ranked")
    placed.write.partitionBy("__part").parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    # One row per range, bounded by the number of partitions of the sort.
    sizes = stored.groupBy("__part").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = run.write("parts", sizes.withColumn("before", upto - F.col("n")))
    if group:
        rank = _ranked(stored, run.spark.read.parquet(parts), "rank")
        run.write("groups", rank.groupBy(group).agg(F.min("rank").alias("first"), F.count("*").alias("n")))
    run.commit()


def _ranked(stored: DataFrame, parts: DataFrame, name: str) -> DataFrame:
    both = stored.join(F.broadcast(parts.select("__part", "before")), "__part")
    return both.withColumn(name, (F.col("before") + F.col("__row") + 1).cast("bigint")).drop("before", "__part", "__row")


def _table(spark: SparkSession, root: str, version: str, table: str, schema=None) -> DataFrame:
    out = publish.read(spark, root, table, "version", [version], schema)
    if out is None:
        raise ValueError(f"no ranking {version} at {root}")
    return out.drop("version")


def ranks(spark: SparkSession, root: str, version: str, name: str = "global_rank") -> DataFrame:
    """All rows with their rank."""
    return _ranked(_table(spark, root, version, "ranked"), _table(spark, root, version, "parts"), name)


def group_positions(spark: SparkSession, root: str, version: str, group: str, name: str = "position") -> DataFrame:
    """All rows with their position in their group."""
    groups = _table(spark, root, version, "groups").select(F.col(group).alias("__group"), "first")
    rows = ranks(spark, root, version, "__rank")
    return rows.join(groups, F.col(group).eqNullSafe(F.col("__group"))).withColumn(
        name, F.col("__rank") - F.col("first") + 1
    ).drop("__rank", "__group", "first")


def rows_between(spark: SparkSession, root: str, version: str, low: int, high: int, name: str = "global_rank") -> DataFrame:
    """Rows of the ranks ``low`` to ``high``, in order; only their folders are read."""
    parts = _table(spark, root, version, "parts")
    here = (F.col("before") < high) & (F.col("before") + F.col("n") >= low)
    found = parts.filter(here).collect()  # the folders that meet the range
    inside = F.lit(False)
    for r in found:
        inside = inside | ((F.col("__part") == r["__part"]) & F.col("__row").between(low - 1 - r["before"], high - 1 - r["before"]))
    stored = _table(spark, root, version, "ranked").filter(F.col("__part").isin([r["__part"] for r in found])).filter(inside)
    before = F.coalesce(*[F.when(F.col("__part") == r["__part"], F.lit(r["before"])) for r in found], F.lit(0))
    return stored.withColumn(name, (before + F.col("__row") + 1).cast("bigint")).drop("__part", "__row").orderBy(name)


def page(spark: SparkSession, root: str, version: str, number: int, page_size: int = V.LISTING_PAGE_SIZE) -> DataFrame:
    """Page ``number``, from 1."""
    return rows_between(spark, root, version, (number - 1) * page_size + 1, number * page_size)


def group_page(
    spark: SparkSession, root: str, version: str, group: str, value: str | None, number: int = 1, page_size: int = V.LISTING_PAGE_SIZE
) -> DataFrame:
    """A page of one group's rows with their position in it; no rows for an unknown group."""
    row = _table(spark, root, version, "groups").filter(F.col(group).eqNullSafe(F.lit(value))).first()
    first, n = (row["first"], row["n"]) if row else (1, 0)
    low = first + (number - 1) * page_size
    rows = rows_between(spark, root, version, low, min(low + page_size, first + n) - 1, "__rank")
    return rows.withColumn("position", F.col("__rank") - first + 1).drop("__rank")
