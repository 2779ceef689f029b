"""Orderings, top-k, global ranks, samples.

Nothing here ranks an unbounded group inside one task. A filter on a small
``row_number`` becomes ``WindowGroupLimit``; a full ranking goes through a range
sort (`positions`).
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia import fixed_values as V
from vacantia.session import cut_lineage


def recency(posted: str = "posted_at", *ties: str) -> list[Column]:
    """Newest first, undated last; ties by company, then by the given unique columns."""
    return [
        F.col(posted).desc_nulls_last(), F.col("company_slug"), *[F.col(t) for t in ties]
    ]


def positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Exact 1-based global position of every row, without a single-task sort.

    Range sort, reliable checkpoint (so partition numbers cannot move when a lost
    executor is replaced), row index inside the partition plus the sizes of the
    partitions before it. ``order`` must be total, which also spreads a hot value
    over many ranges.
    """
    ordered = cut_lineage(df.orderBy(*order))
    numbered = ordered.withColumn("__mid", F.monotonically_increasing_id())
    part = F.shiftright("__mid", 33)
    within = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the sorted table, so the broadcast is bounded by the
    # partition count, whatever the table holds.
    sizes = numbered.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select(
        "__part",
        (
            F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0))
            - F.col("__n")
        ).alias("__before"),
    )
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(before), "__part")
        .withColumn(name, (F.col("__before") + within + 1).cast("bigint"))
        .select(*df.columns, name)
    )


def positions_within(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "position"
) -> DataFrame:
    """Exact 1-based position inside each group; a group may span many tasks."""
    spread = positions(df, [*[F.col(k) for k in keys], *order], "__global")
    starts = spread.groupBy(*keys).agg(F.min("__global").alias("__start"))
    starts = starts.select("__start", *[F.col(k).alias(f"__key_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    return spread.join(starts, same, "left").select(
        *df.columns, (F.col("__global") - F.col("__start") + 1).alias(name)
    )


def pages(df: DataFrame, order: list[Column], page_size: int = V.LISTING_PAGE_SIZE) -> DataFrame:
    """Global rank and page number of every row."""
    ranked = positions(df, order, "global_rank")
    return ranked.withColumn("page", F.ceil(F.col("global_rank") / page_size).cast("bigint"))


def front_page(
    jobs: DataFrame,
    order: list[Column],
    *,
    per_company: int = V.FRONT_PAGE_COMPANY_CAP,
    size: int = V.LISTING_PAGE_SIZE,
) -> DataFrame:
    """The newest ``size`` rows with at most ``per_company`` of each company.

    Same rows as a greedy walk in recency order: a row is taken exactly when it is
    among its company's first ``per_company``.
    """
    w = Window.partitionBy("company_slug").orderBy(*order)
    return (
        jobs.withColumn("company_rank", F.row_number().over(w))
        .filter(F.col("company_rank") <= per_company)
        .orderBy(*order)
        .limit(size)
    )


def newest(df: DataFrame, when: Column, tie: str, n: int) -> DataFrame:
    return df.orderBy(when.desc(), F.col(tie)).limit(n)


def leaderboard(
    counts: DataFrame, n: int, *, key: str = "company_slug", count: str = "n", width: int = 200
) -> DataFrame:
    """Top ``n`` of a counts table with padded rank and relative bar width."""
    top = counts.orderBy(F.col(count).desc(), F.col(key)).limit(n)
    # At most n rows reach these windows.
    order = Window.orderBy(F.col(count).desc(), F.col(key))
    best = F.greatest(F.max(count).over(Window.partitionBy()), F.lit(1))
    rank = F.row_number().over(order)
    bar = F.greatest(F.lit(2), F.floor(F.col(count) / best * width + 0.5)).cast("bigint")
    return top.select(
        "*",
        F.when(rank < 10, F.lpad(rank.cast("string"), 2, "0"))
        .otherwise(rank.cast("string"))
        .alias("rank"),
        bar.alias("bar"),
    )


def company_ranking(companies: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every company with its open count, most first, then by name."""
    counts = jobs.groupBy(F.col("company_slug").alias("slug")).agg(F.count("*").alias("n"))
    return (
        companies.join(counts, "slug", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .orderBy(F.col("n").desc(), F.col("name"), F.col("slug"))
    )


def stratified_sample(
    df: DataFrame,
    n: int,
    *,
    stratum: str = "source",
    size: Column | None = None,
    key: str = "id",
    distinct: bool = True,
) -> DataFrame:
    """About ``n`` rows over all strata: half longest, half shortest, padded, cut to ``n``.

    With ``distinct=False`` a row that is in both halves of a small stratum comes
    twice and the padding does not count it twice. ``key`` is unique. Ranks come from one
    range sort of stratum, size and key alone, so neither a large stratum nor a large
    ``n`` meets in one task; only the chosen keys are joined to their rows.
    """
    size = F.length(F.coalesce("description_md", F.lit(""))) if size is None else size
    base = df.select(
        F.coalesce(F.col(stratum).cast("string"), F.lit("unknown")).alias("__stratum"),
        size.alias("__size"), F.col(key).alias("__id"),
    )
    order = [F.col("__size").desc(), F.col("__id")]
    ranked = positions_within(base, ["__stratum"], order, "__rn")
    # One row per stratum.
    totals = ranked.groupBy("__stratum").agg(F.count("*").alias("__total"))
    target = F.greatest(F.lit(1), F.floor(F.lit(n) / F.greatest(totals.agg(F.count("*")).scalar(), F.lit(1))))
    half = F.greatest(F.lit(1), F.floor(target / 2)).cast("long")
    at = ranked.join(totals, "__stratum").withColumn("__half", half)
    in_head = F.col("__rn") <= F.col("__half")
    in_tail = (F.col("__total") > F.col("__half")) & (F.col("__rn") > F.col("__total") - F.col("__half"))

    def part(rows: DataFrame, phase: int, seg: int) -> DataFrame:
        return rows.select("__id", "__stratum", "__rn", F.lit(phase).alias("__phase"), F.lit(seg).alias("__seg"))

    chosen = (
        part(at.filter(in_head), 0, 0)
        .unionAll(part(at.filter(in_tail & ~in_head if distinct else in_tail), 0, 1))
        .unionAll(part(at.filter(~in_head & ~in_tail), 1, 0))
        .orderBy("__phase", "__stratum", "__seg", "__rn")
        .limit(n)
    )
    return df.join(chosen, F.col(key) == F.col("__id")).orderBy(
        "__phase", "__stratum", "__seg", "__rn"
    ).select(*[df[c] for c in df.columns])
