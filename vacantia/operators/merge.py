"""Dedupe, merge and overlay of keyed tables.

Per-key "first" and "last" are ``row_number() = 1`` filters: Spark plans a
``WindowGroupLimit`` in front of the shuffle, so at most one row per key and map
task moves, however hot the key.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

_RN = "__rn"


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given (total) order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def last_per_key(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The row of every key with the highest ingest sequence."""
    return first_per_key(df, keys, [F.col(sequence).desc()])


def one_per_id(
    df: DataFrame, columns: list[str], *, key: str = "id", sequence: str | None = None
) -> DataFrame:
    """One row per key with the given columns: the last by ``sequence`` and then by content.

    Rows that agree in all of them are interchangeable, so the result does not depend on
    partitioning even where no sequence is stored.
    """
    total = [F.to_json(F.struct(*columns)).desc()]
    order = [F.col(sequence).desc_nulls_last(), *total] if sequence in df.columns else total
    return first_per_key(df, [key], order).select(key, *[c for c in columns if c != key])


def dedupe_by_source_priority(
    jobs: DataFrame, *, key: str = "url", rank: str = "source_rank"
) -> DataFrame:
    """Drop rows whose key a better-ranked source also has.

    Rows sharing the best rank all stay, duplicates inside one source included.
    Only keys that two ranks really share enter the join, after map-side
    aggregation; the row side streams through once. The null-safe condition gives
    the join a shuffle of its own on both sides (it would otherwise reuse the
    aggregate's), which is what lets AQE split the rows of a hot key over many tasks.
    """
    contested = (
        jobs.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.min(rank).alias("__best"), F.max(rank).alias("__worst"))
        .filter(F.col("__best") < F.col("__worst"))
        .select("__key", "__best")
    )
    return (
        jobs.join(contested, F.col(key).eqNullSafe(F.col("__key")), "left")
        .filter(F.col("__best").isNull() | (F.col(rank) == F.col("__best")))
        .select(*jobs.columns)
    )


def merge_dimension(
    curated: DataFrame,
    discovered: DataFrame,
    *,
    key: str = "slug",
    source_rank: str = "source_rank",
    sequence: str = "ingest_seq",
) -> DataFrame:
    """Curated rows, plus discovered rows for keys the curated side lacks.

    Among discovered rows the last source wins a key, and inside that source the
    first row. ``curated`` has one row per key.
    """
    winners = first_per_key(discovered, [key], [F.col(source_rank).desc(), F.col(sequence)])
    fresh = winners.join(curated.select(key), key, "left_anti")
    columns = [c for c in curated.columns if c not in (source_rank, sequence)]
    return curated.select(*columns).unionByName(
        fresh.drop(source_rank, sequence), allowMissingColumns=True
    ).select(*columns)


def preserve_columns(
    rebuilt: DataFrame, previous: DataFrame, columns: list[str], *, key: str = "slug"
) -> DataFrame:
    """Take ``columns`` from the previous table for keys it has, else keep the rebuilt ones.

    A previous row wins even where its value is null.
    """
    old = previous.select(
        key, F.lit(True).alias("__had"), *[F.col(c).alias(f"__old_{c}") for c in columns]
    )
    joined = rebuilt.join(old, key, "left")
    return joined.select(
        *[
            F.when(F.col("__had"), F.col(f"__old_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in rebuilt.columns
        ]
    )


def without_existing(candidates: DataFrame, existing: DataFrame, key: str = "slug") -> DataFrame:
    """Candidates whose key is not known yet."""
    return candidates.join(existing.select(key), key, "left_anti")


def carry_tags_forward(
    jobs: DataFrame, prior: DataFrame, *, sequence: str | None = "ingest_seq"
) -> DataFrame:
    """Fill role_family and seniority from the prior snapshot by id.

    Only rows with neither tag take part, and they take the pair as a whole. Of
    several tagged prior rows with one id the last counts, by ``sequence`` where the
    snapshot has it; repeated ids never multiply rows.
    """
    tagged = prior.filter(
        (F.coalesce("role_family", F.lit("")) != "") | (F.coalesce("seniority", F.lit("")) != "")
    )
    old = one_per_id(tagged, ["role_family", "seniority"], sequence=sequence).select(
        "id",
        F.col("role_family").alias("__role"),
        F.col("seniority").alias("__seniority"),
    )
    take = F.col("role_family").isNull() & F.col("seniority").isNull()
    return (
        jobs.join(old, "id", "left")
        .withColumns(
            {
                "role_family": F.when(take, F.col("__role")).otherwise(F.col("role_family")),
                "seniority": F.when(take, F.col("__seniority")).otherwise(F.col("seniority")),
            }
        )
        .select(*jobs.columns)
    )


def untagged(jobs: DataFrame, *, retag_all: bool = False, limit: int | None = None) -> DataFrame:
    """Rows the tagger still has to see, in id order when limited."""
    rows = jobs if retag_all else jobs.filter(
        F.col("role_family").isNull() & F.col("seniority").isNull()
    )
    return rows if limit is None else rows.orderBy("id").limit(limit)


def overlay(
    base: DataFrame, updates: DataFrame, columns: list[str], *, key: str = "id",
    sequence: str | None = "ingest_seq",
) -> DataFrame:
    """Replace ``columns`` of the rows that have an update.

    Of several updates of a key the last counts, by ``sequence`` where they have it.
    """
    new = one_per_id(updates, columns, key=key, sequence=sequence).select(
        key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = base.join(new, key, "left")
    return joined.select(
        *[
            F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in base.columns
        ]
    )
