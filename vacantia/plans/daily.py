"""The three batch jobs: build a snapshot, diff two snapshots, overlay tags."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia import fixed_values as V, schemas
from vacantia.functions import classify as C
from vacantia.functions import tagging
from vacantia.functions.text import strip_boilerplate
from vacantia.operators import changes, merge, quality
from vacantia.sinks import writers
from vacantia.sources import payloads as P, routes, snapshots

AGGREGATOR_SLUG = "(aggregator)"


def source_rank(source: Column) -> Column:
    """0 for every single-company source, then the aggregators in their order."""
    chain = F.when(source == V.AGGREGATOR_SOURCES[0], 1)
    for i, name in enumerate(V.AGGREGATOR_SOURCES[1:], start=2):
        chain = chain.when(source == name, i)
    return chain.otherwise(0)


@dataclass
class Run:
    jobs: DataFrame
    dropped: DataFrame
    companies: DataFrame
    run_log: DataFrame
    header: DataFrame


def collect(payloads: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Postings of the landed sources with their priority, repeats inside one removed.

    Write the result before building on it: everything downstream reads it more
    than once, and parsing is the expensive part.
    """
    found = P.read_all(payloads, sources)
    return found.withColumn("source_rank", source_rank(F.col("source")))


def deduped(postings: DataFrame) -> DataFrame:
    """Postings whose URL no better source has, with ``kept`` by the title and place rules.

    Write it before building on it: jobs, log and header all read it.
    """
    keep = C.keep_job(F.col("title"), F.col("remote_policy"), F.col("location"))
    return merge.dedupe_by_source_priority(postings).withColumn("kept", keep)


def build_snapshot(
    curated: DataFrame,
    postings: DataFrame,
    prior_jobs: DataFrame | None = None,
    *,
    run_at: Column | None = None,
    version: str = "1",
    attempts: DataFrame | None = None,
    sources: list[str] | None = None,
    unique: DataFrame | None = None,
) -> Run:
    """Collected postings and seed to kept jobs, merged companies and the run log. Lazy.

    ``attempts`` are those of `payloads.attempts`; ``sources`` those of the run, by default
    all; ``unique`` is `deduped` of the postings, where it is written already.
    """
    unique = deduped(postings) if unique is None else unique
    # Companies come from all that was found: only their postings lose to better sources.
    firms = P.companies_of(
        postings.filter(F.col("source").isin(V.AGGREGATOR_SOURCES))
    ).withColumns(
        {
            "source_rank": source_rank(F.col("source")),
            "ingest_seq": F.struct("page", "item", "slug"),
        }
    )
    companies = merge.merge_dimension(
        schemas.conform(curated, schemas.COMPANIES),
        firms.drop("source", "page", "item"),
    )
    kept, dropped = (
        schemas.conform(unique.filter(rows), schemas.JOBS) for rows in (F.col("kept"), ~F.col("kept"))
    )
    log = run_log(curated, unique, attempts, sources)
    header = run_header(kept, companies, run_at, version)
    if prior_jobs is not None:
        kept = merge.carry_tags_forward(kept, prior_jobs)
    return Run(kept, dropped, companies, log, header)


def run_log(
    curated: DataFrame, unique: DataFrame, attempts: DataFrame | None = None,
    sources: list[str] | None = None,
) -> DataFrame:
    """One row per routed company and per aggregator of the run, with its rows after dedupe.

    An error of the route, of the fetch or of the payload makes a row a failure.
    """
    routed = routes.resolve_routes(curated)
    if attempts is None:
        attempts = curated.sparkSession.createDataFrame(
            [], "source string, company_slug string, error string, duration_ms int"
        )
    own = attempts.select(
        F.col("source").alias("route"), F.col("company_slug").alias("slug"),
        F.col("error").alias("failed"), "duration_ms",
    )
    per_company = unique.groupBy(
        F.col("company_slug").alias("slug"), F.col("source").alias("route")
    ).agg(F.count("*").alias("n"))
    error = F.coalesce("error", "failed")
    boards = routed.join(per_company, ["slug", "route"], "left").join(own, ["slug", "route"], "left").select(
        F.col("route").alias("extractor"), F.col("slug").alias("company_slug"),
        error.isNull().alias("success"),
        F.coalesce("n", F.lit(0)).cast("int").alias("job_count"),
        F.coalesce("duration_ms", F.lit(0)).cast("int").alias("duration_ms"), error.alias("error"),
    )
    feeds = curated.sparkSession.createDataFrame(
        [(s, AGGREGATOR_SLUG) for s in V.AGGREGATOR_SOURCES if sources is None or s in sources],
        "extractor string, company_slug string",
    )
    of_feed = own.groupBy(F.col("route").alias("extractor")).agg(
        F.max("failed").alias("error"), F.sum("duration_ms").cast("int").alias("duration_ms")
    )
    tried = feeds.join(of_feed, "extractor", "left").select(
        "extractor", "company_slug", F.col("error").isNull().alias("success"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"), "error",
    )
    return boards.unionByName(quality.source_log(unique, tried))


def run_header(
    kept: DataFrame, companies: DataFrame, run_at: Column | None, version: str
) -> DataFrame:
    firms = companies.agg(F.count("*").cast("int"))
    return kept.agg(F.count("*").cast("int").alias("job_count")).select(
        F.date_trunc("second", run_at if run_at is not None else F.now()).alias("run_at"),
        F.lit(version).alias("pipeline_version"),
        firms.scalar().alias("company_count"),
        "job_count",
    )


def run(
    spark: SparkSession,
    curated: DataFrame,
    payloads: DataFrame,
    root: str,
    date: str,
    sources: list[str] | None = None,
    landing: DataFrame | None = None,
) -> None:
    """Build and write the snapshot of ``date``, carrying tags from the latest one.

    Parsed postings are staged once, and so are the deduped ones with their verdicts.
    ``landing`` tells how the fetches went (see `payloads.attempts`).
    """
    staged = f"{root}/postings/run_date={date}"
    collect(payloads, sources).write.mode("overwrite").parquet(staged)
    found = spark.read.parquet(staged)
    # Deduped once: the exchange on url happens here and nowhere else.
    once = f"{root}/unique/run_date={date}"
    deduped(found).write.mode("overwrite").parquet(once)
    before = [d for d in snapshots.dates(spark, root) if d < date]
    prior = snapshots.read_jobs(spark, root, before[-1:])
    out = build_snapshot(
        curated, found, prior.drop("snapshot_date"), attempts=P.attempts(payloads, landing),
        sources=sources, unique=spark.read.parquet(once),
    )
    writers.write_run(out.jobs, out.companies, out.header, out.run_log, root, date)


def diff(spark: SparkSession, root: str, today: str, yesterday: str) -> DataFrame:
    """Write the change log of two dates and return it as read back from storage.

    Buckets whose digests agree are not opened. The log is written once; feed, summary and
    alert all read the written table instead of joining the snapshots again.
    """
    digests = [snapshots.read_digests(spark, root, d) for d in (today, yesterday)]
    differ = changes.changed_buckets(*digests)
    if differ is None:
        stored = snapshots.read_jobs(spark, root, [today, yesterday])
        now, before = snapshots.on_date(stored, today), snapshots.on_date(stored, yesterday)
        changes.refuse_if_broken(now, before)
    else:
        now, before = (snapshots.read_buckets(spark, root, d, *differ) for d in (today, yesterday))
    path = f"{root}/changes/diff_date={today}"
    changes.change_events(now, before).write.mode("overwrite").parquet(path)
    events = spark.read.parquet(path)
    writers.write_change_log(events, f"{root}/diffs/{today}")
    return events


def new_postings(jobs: DataFrame, events: DataFrame) -> DataFrame:
    """Full rows of the newly seen ids, for the feed."""
    ids = events.filter(F.col("event") == "new").select("id")
    return jobs.join(ids, "id", "left_semi")


def tag_requests(
    jobs: DataFrame,
    answered: DataFrame | None = None,
    *,
    variant: str = tagging.DEFAULT_VARIANT,
    retag_all: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Messages still to send: untagged, titled, and not answered before."""
    rows = merge.untagged(jobs, retag_all=retag_all).filter(
        F.trim(F.coalesce("title", F.lit(""))) != ""
    )
    if answered is not None:
        rows = rows.join(answered.select("id"), "id", "left_anti")
    if limit is not None:
        rows = rows.orderBy("id").limit(limit)
    body = strip_boilerplate(F.col("description_md"))
    return rows.select("id", tagging.messages(variant, F.col("title"), body).alias("messages"))


_TAG_COLUMNS = [
    "seniority", "role_family", "remote_policy", "visa_sponsorship", "stack", "languages",
    "salary_min", "salary_max", "salary_currency", "salary_period",
]


def apply_answers(jobs: DataFrame, answers: DataFrame) -> DataFrame:
    """Overlay normalised answers ``(id, body)`` on the snapshot rows.

    An id counts with one answer and one text, however often either table holds it.
    """
    texts = merge.one_per_id(jobs, ["description_md"], sequence="ingest_seq")
    source = texts.select("id", strip_boilerplate(F.col("description_md")).alias("__text"))
    parsed = merge.one_per_id(answers, ["body"]).join(source, "id").withColumn("__a", tagging.parse_answer(F.col("body")))
    fields = tagging.normalised_answer(F.col("__a"), F.col("__text"))
    clean = parsed.filter(F.col("__a").isNotNull()).select(
        "id", *[c.alias(n) for n, c in fields.items()]
    )
    flat = clean.select(
        "id", *[c for c in _TAG_COLUMNS if not c.startswith("salary_")],
        *[F.col(f"salary.{p}").alias(f"salary_{p}") for p in ("min", "max", "currency", "period")],
    )
    return merge.overlay(jobs, flat, _TAG_COLUMNS)
