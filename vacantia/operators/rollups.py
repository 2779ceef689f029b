"""Counts over time, kept up to date from day to day instead of recounted.

Each snapshot date has a table of counts by company and hour of posting. The next day's is
that of the day before, plus the rows of the buckets that changed, minus what the same buckets
held before; other buckets are not opened (see `changes.changed_buckets`). Counts of weeks,
companies and recent days are sums over this table.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacantia.operators import changes
from vacantia.sinks import publish
from vacantia.sinks.publish import Publication
from vacantia.sources import snapshots

GRAIN = "hour"
COUNTS = T.StructType([
    T.StructField("company_slug", T.StringType()), T.StructField("posted", T.TimestampType()), T.StructField("n", T.LongType()),
])


def _counted(jobs: DataFrame, sign: int) -> DataFrame:
    return jobs.groupBy("company_slug", F.date_trunc(GRAIN, "posted_at").alias("posted")).agg((F.count("*") * sign).alias("n"))


def update(spark: SparkSession, root: str, date: str) -> None:
    """Publish the counts of a written snapshot, from those of the date before it where there are any."""
    before = [d for d in snapshots.dates(spark, root, "rollup") if d < date][-1:]
    differ = None
    if before:
        differ = changes.changed_buckets(*(snapshots.read_digests(spark, root, d) for d in (date, before[0])))
    if differ is None:
        total = _counted(snapshots.read_jobs(spark, root, [date]), 1)
    else:
        new, old = (snapshots.read_buckets(spark, root, d, *differ) for d in (date, before[0]))
        parts = counts(spark, root, before[0]).unionByName(_counted(new, 1)).unionByName(_counted(old, -1))
        total = parts.groupBy("company_slug", "posted").agg(F.sum("n").alias("n")).filter("n <> 0")
    run = Publication(spark, root, date)
    run.write("rollup", total)
    run.commit()


def counts(spark: SparkSession, root: str, date: str) -> DataFrame:
    """``company_slug, posted, n``: postings by hour; undated ones under a null hour."""
    folder = T.StructType([*COUNTS.fields, T.StructField("snapshot_date", T.DateType()), T.StructField("run", T.StringType())])
    stored = publish.read(spark, root, "rollup", versions=[date], schema=folder)
    if stored is None:
        raise ValueError(f"no counts of {date} at {root}")
    return stored.select(*COUNTS.names)


def company_counts(spark: SparkSession, root: str, date: str) -> DataFrame:
    return counts(spark, root, date).groupBy("company_slug").agg(F.sum("n").alias("n"))


def weekly_velocity(spark: SparkSession, root: str, date: str) -> DataFrame:
    """As `changes.weekly_velocity` of the snapshot, from its counts."""
    weeks = (
        counts(spark, root, date).filter("posted IS NOT NULL")
        .groupBy("company_slug", F.date_trunc("week", "posted").cast("date").alias("period")).agg(F.sum("n").alias("n"))
    )
    return changes.velocity(weeks, "company_slug")


def recent_counts(spark: SparkSession, root: str, date: str, since: Column) -> DataFrame:
    """Postings by company later than ``since``: whole hours from the counts, the hour of ``since`` from the rows."""
    hour = F.date_trunc(GRAIN, since)
    later = counts(spark, root, date).filter(F.col("posted") > hour).select("company_slug", "n")
    edge = snapshots.read_jobs(spark, root, [date]).filter(
        (F.col("posted_at") > since) & (F.col("posted_at") < hour + F.expr(f"interval 1 {GRAIN}"))
    )
    rows = later.unionByName(edge.groupBy("company_slug").agg(F.count("*").alias("n")))
    return rows.groupBy("company_slug").agg(F.sum("n").alias("n"))
