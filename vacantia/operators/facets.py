"""Facet counts, options and source statistics."""

from pyspark.sql import Column, DataFrame, functions as F

from vacantia import fixed_values as V
from vacantia.functions.classify import source_class


def facet_counts(rows: DataFrame, facets: dict[str, str]) -> DataFrame:
    """Long table ``(facet, value, n)`` of independent counts; null and empty are skipped.

    One pass: grouping sets share a scan and aggregate before the shuffle.
    """
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("facet"), F.col(c).cast("string").alias("value"))
            for f, c in facets.items()
        ]
    )
    return (
        rows.select(F.explode(entries).alias("e"))
        .select("e.facet", "e.value")
        .filter(F.coalesce("value", F.lit("")) != "")
        .groupBy("facet", "value")
        .agg(F.count("*").alias("n"))
    )


def where_options(counts: DataFrame, limit: int = 25) -> DataFrame:
    """Most frequent ``where`` values without the catch-all bucket."""
    return (
        counts.filter((F.col("facet") == "where") & (F.col("value") != V.WHERE_OTHER) & (F.col("n") > 0))
        .orderBy(F.col("n").desc(), F.col("value"))
        .limit(limit)
    )


def role_options(counts: DataFrame) -> DataFrame:
    """Role values that have a label, most frequent first."""
    return counts.filter(
        (F.col("facet") == "role") & F.col("value").isin(list(V.ROLE_LABELS)) & (F.col("n") > 0)
    ).orderBy(F.col("n").desc(), F.col("value"))


def pinned_order(value: Column) -> list[Column]:
    """Search panel order of ``where``: Remote, France, then alphabetical."""
    return [F.when(value == "Remote", 0).when(value == "France", 1).otherwise(2), value]


def grouped_order(value: Column, count: Column, prefix: str) -> list[Column]:
    """Chip order: values with the prefix keep count order on top, the rest A to Z."""
    first = value.startswith(prefix)
    return [
        F.when(first, 0).otherwise(1),
        F.when(first, -count).otherwise(F.lit(0)),
        value,
    ]


def counts_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def source_split(jobs: DataFrame) -> DataFrame:
    """Per class: rows and distinct sources."""
    per_source = counts_by(jobs, "source")
    return (
        per_source.groupBy(source_class(F.col("source")).alias("source_class"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("n_sources"))
    )
