"""Run logs, coverage and staleness."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia import fixed_values as V


def success_summary(run_log: DataFrame) -> DataFrame:
    """One row: results, successes, rate (1.0 without results), and the under-half gate."""
    ok = F.count_if("success")
    total = F.count("*")
    rate = F.coalesce(F.try_divide(ok.cast("double"), total.cast("double")), F.lit(1.0))
    return run_log.agg(
        total.alias("total"), ok.alias("ok"), rate.alias("success_rate"),
        (rate < 0.5).alias("below_half"),
    )


def source_log(kept: DataFrame, attempts: DataFrame) -> DataFrame:
    """Attempts with the number of rows each source contributed after dedupe."""
    counts = kept.groupBy("source").agg(F.count("*").cast("int").alias("job_count"))
    return attempts.join(counts, attempts["extractor"] == counts["source"], "left").select(
        "extractor", "company_slug", "success",
        F.coalesce("job_count", F.lit(0)).alias("job_count"), "duration_ms", "error",
    )


def flatten_runs(metadata: DataFrame, snapshot_date: Column) -> DataFrame:
    """Run-metadata documents to one row per extractor result."""
    return metadata.select(
        snapshot_date.alias("snapshot_date"), F.explode("extractor_results").alias("r")
    ).select("snapshot_date", "r.*")


def stale_entities(
    run_log: DataFrame,
    runs: int,
    *,
    run: str = "snapshot_date",
    keys: tuple[str, ...] = ("company_slug",),
    count: str = "job_count",
) -> DataFrame:
    """Entities seen at least ``runs`` times in the last ``runs`` runs, always with nothing."""
    recent = run_log.select(run).distinct().orderBy(F.col(run).desc()).limit(runs)
    return (
        run_log.join(recent, run, "left_semi")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("observations"),
            F.max(F.coalesce(F.col(count), F.lit(0))).alias("__most"),
        )
        .filter((F.col("observations") >= runs) & (F.col("__most") == 0))
        .drop("__most")
    )


def coverage(
    results: DataFrame,
    fields: list[str],
    *,
    by: list[str],
    stack: str | None = None,
    tokens: list[str] = (),
) -> DataFrame:
    """Share of rows with a usable value per group, mean list size, token totals."""
    def share(c: str) -> Column:
        filled = F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
        return F.avg(filled.cast("double")).alias(f"{c}_coverage")

    extra = [F.avg(F.size(F.coalesce(F.col(stack), F.array().cast("array<string>")))).alias("avg_stack")] if stack else []
    return results.groupBy(*by).agg(
        F.count("*").alias("n"),
        *[share(c) for c in fields],
        *extra,
        *[F.sum(t).alias(t) for t in tokens],
    )


def best_provider(probes: DataFrame) -> DataFrame:
    """Draft seed rows from probe hits ``(slug, provider, job_count)``.

    The provider with most jobs wins, by name among equals. A slug has at most one
    row per provider, so the list behind the note is bounded by the provider count.
    """
    hits = probes.filter(F.col("job_count") > 0)
    seen = F.sort_array(F.collect_list(F.struct("provider", "job_count")))
    listed = F.array_join(
        F.transform(
            seen,
            lambda h: F.concat(
                F.lit("'"), h["provider"], F.lit("': "), h["job_count"].cast("string")
            ),
        ),
        ", ",
    )
    total = F.sum("job_count")
    return hits.groupBy("slug").agg(
        F.min_by("provider", F.struct(-F.col("job_count"), "provider")).alias("ats_provider"),
        total.alias("total_jobs"),
        F.concat(
            F.lit("draft: probe found {"), listed, F.lit("} ("), total.cast("string"),
            F.lit(" jobs across providers)"),
        ).alias("notes"),
    ).select(
        "slug",
        F.initcap(F.replace(F.col("slug"), F.lit("-"), F.lit(" "))).alias("name"),
        F.lit("XX").alias("country"),
        "ats_provider",
        F.col("slug").alias("ats_handle"),
        "total_jobs",
        "notes",
    )


def distinct_orgs(model_ids: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct owner part of ``owner/name`` identifiers."""
    owner = F.substring_index(F.col(column), "/", 1)
    orgs = model_ids.filter(F.contains(F.col(column), F.lit("/"))).select(owner.alias("org"))
    distinct = orgs.filter(F.col("org") != "").distinct()
    return distinct if limit is None else distinct.orderBy("org").limit(limit)


def organisation_owners(repos: DataFrame) -> DataFrame:
    """Distinct repository owners that are organisations and not blocklisted."""
    return repos.filter(
        (F.col("owner_type") == "Organization")
        & ~F.lower("owner").isin(V.REPO_OWNER_BLOCKLIST)
    ).select("owner").distinct()


def latest_runs(run_log: DataFrame, run: str = "snapshot_date") -> DataFrame:
    """Every entity's newest log row."""
    w = Window.partitionBy("extractor", "company_slug").orderBy(F.col(run).desc())
    return run_log.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
