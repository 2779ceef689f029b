"""Snapshot, change log, feed and read-model outputs."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia import fixed_values as V, schemas
from vacantia.functions.ids import job_path
from vacantia.functions.text import head, or_else
from vacantia.functions.times import rfc822_text
from vacantia.operators.changes import bucket_digests
from vacantia.operators.ranking import newest
from vacantia.sinks.publish import Publication


def job_rows(jobs: DataFrame) -> DataFrame:
    """Storage form: a nested ``salary`` struct becomes four columns."""
    if "salary" in jobs.columns:
        jobs = jobs.withColumns(
            {f"salary_{p}": F.col(f"salary.{p}") for p in ("min", "max", "currency", "period")}
        )
    return schemas.conform(jobs, schemas.JOBS)


def company_rows(companies: DataFrame) -> DataFrame:
    """Storage form: a nested ``ats`` struct becomes two columns."""
    if "ats" in companies.columns:
        companies = companies.withColumns(
            {f"ats_{p}": F.col(f"ats.{p}") for p in ("provider", "handle")}
        )
    return schemas.conform(companies, schemas.COMPANIES)


#: Folders of a snapshot of jobs, by hash of the id. Any power of two, also another one the
#: next day; some million rows a folder are a good size.
BUCKETS = 16


def write_snapshot(jobs: DataFrame, companies: DataFrame, root: str, date: str, buckets: int = BUCKETS) -> None:
    """Write both tables under their date and publish them together.

    Another date is never touched. The newest published date is the latest snapshot, so no
    copy is kept.
    """
    run = Publication(jobs.sparkSession, root, date)
    _write_tables(run, jobs, companies, buckets)
    run.commit()


def _write_tables(run: Publication, jobs: DataFrame, companies: DataFrame, buckets: int) -> None:
    """Jobs in buckets of their ids, a digest of what a diff compares in each, and companies."""
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    rows = job_rows(jobs)
    bucket = F.pmod(F.hash("id"), F.lit(buckets)).cast("int")
    path = run.write("jobs", rows.withColumn("bucket", bucket), by="bucket")
    stored = run.spark.read.schema(rows.schema.add("bucket", T.IntegerType())).parquet(path)
    run.write("digests", bucket_digests(stored).withColumn("buckets", F.lit(buckets)))
    run.write("companies", company_rows(companies))


def write_run(
    jobs: DataFrame, companies: DataFrame, header: DataFrame, run_log: DataFrame, root: str, date: str
) -> None:
    """The whole result of a day: both tables, run log and metadata, published together."""
    run = Publication(jobs.sparkSession, root, date)
    _write_tables(run, jobs, companies, BUCKETS)
    _write_metadata(run, header, run_log, 1000)
    run.commit()


def write_run_metadata(
    header: DataFrame, run_log: DataFrame, root: str, date: str, per_document: int = 1000
) -> None:
    """Metadata documents, and the extractor results as a table, published together."""
    run = Publication(run_log.sparkSession, root, date)
    _write_metadata(run, header, run_log, per_document)
    run.commit()


def _write_metadata(run: Publication, header: DataFrame, run_log: DataFrame, per_document: int) -> None:
    """Each document holds the header and about ``per_document`` results, in a file of its own.

    So none grows with the number of companies; `snapshots.read_run_log` reads them back.
    """
    rows = run.spark.read.schema(schemas.RESULT).parquet(run.write("run_log", run_log))
    documents = max(1, -(-rows.count() // per_document))
    part = F.pmod(F.xxhash64("extractor", "company_slug"), F.lit(documents)).cast("int")
    results = rows.groupBy(part.alias("part")).agg(
        F.collect_list(F.struct(*schemas.RESULT.names)).alias("extractor_results")
    )
    known = header.first().asDict()
    kinds = {f.name: f.dataType for f in header.schema}
    results.select(
        "part", *[F.lit(v).cast(kinds[k]).alias(k) for k, v in known.items()], "extractor_results"
    ).repartition("part").write.partitionBy("part").json(run.folder("metadata"))


def change_log_rows(events: DataFrame) -> DataFrame:
    """JSON lines: summary keys for new rows, the id for removed ones, field changes."""
    new = F.to_json(
        F.struct(
            "event", "id", "company_slug", "title", "url", "location", "source", "posted_at"
        ),
        {"ignoreNullFields": "false"},
    )
    removed = F.to_json(F.struct("event", "id"))
    changed = F.to_json(
        F.struct("event", F.col("id").alias("job_id"), "field", "old", "new"),
        {"ignoreNullFields": "false"},
    )
    line = (
        F.when(F.col("event") == "new", new)
        .when(F.col("event") == "removed", removed)
        .otherwise(changed)
    )
    return events.select(line.alias("value"))


def write_change_log(events: DataFrame, path: str) -> None:
    change_log_rows(events).write.mode("overwrite").text(path)


def feed_items(
    new_jobs: DataFrame, n: int = V.FEED_ITEMS, text_limit: int | None = None
) -> DataFrame:
    """The ``n`` newest new postings as feed fields, newest first.

    ``text_limit`` characters of the description are shown, by default all.
    """
    when = F.coalesce("posted_at", "scraped_at")
    top = newest(new_jobs, when, "id", n)
    body = F.concat(
        F.lit("<b>"), F.col("company_slug"), F.lit("</b> · "),
        or_else(F.col("location"), F.lit("—")), F.lit("\n\n"),
        head(F.coalesce("description_md", F.lit("")), text_limit),
    )
    return top.select(
        F.concat("title", F.lit(" — "), F.col("company_slug")).alias("title"),
        F.col("url").alias("link"),
        F.col("id").alias("guid"),
        when.alias("published"),
        rfc822_text(when).alias("pubDate"),
        body.alias("description"),
    )


def _escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def feed_document(
    items: DataFrame, *, title: str, link: str, description: str, built_at: Column
) -> DataFrame:
    """One-row RSS 2.0 document of already limited feed items."""
    def tag(name: str, value: Column, attributes: str = "") -> Column:
        return F.concat(F.lit(f"<{name}{attributes}>"), _escape(value), F.lit(f"</{name}>"))

    item = F.concat(
        F.lit("<item>"), tag("title", F.col("title")), tag("link", F.col("link")),
        tag("guid", F.col("guid"), ' isPermaLink="false"'), tag("pubDate", F.col("pubDate")),
        tag("description", F.col("description")), F.lit("</item>"),
    )
    # At most the feed's item limit reaches this aggregate.
    ordered = F.sort_array(
        F.collect_list(F.struct((-F.unix_micros("published")).alias("k"), "guid", item.alias("x")))
    )
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel>'),
        tag("title", F.lit(title)), tag("link", F.lit(link)),
        tag("description", F.lit(description)), tag("lastBuildDate", rfc822_text(built_at)),
        tag("language", F.lit("en")),
    )
    return items.agg(ordered.alias("o")).select(
        F.concat(
            head, F.array_join(F.transform("o", lambda r: r["x"]), ""),
            F.lit("</channel></rss>"),
        ).alias("xml")
    )


def descriptions(jobs: DataFrame) -> DataFrame:
    """Side table of the heavy column, for rows that have one."""
    return jobs.filter(F.length("description_md") > 0).select("id", "description_md")


def posting_json(site: str) -> Column:
    """JobPosting structured data of a read-model row; absent keys are omitted.

    Expects ``company_name``, ``career_url`` and ``description_html`` beside the jobs
    columns.
    """
    place = F.struct(
        F.lit("Place").alias("@type"),
        F.struct(
            F.lit("PostalAddress").alias("@type"), F.col("location").alias("addressLocality")
        ).alias("address"),
    )
    return F.to_json(
        F.struct(
            F.lit("https://schema.org").alias("@context"),
            F.lit("JobPosting").alias("@type"),
            F.col("title").alias("title"),
            F.coalesce(F.nullif("description_html", F.lit("")), "title").alias("description"),
            F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datePosted"),
            F.struct(
                F.lit("Organization").alias("@type"), F.col("company_name").alias("name"),
                or_else(F.col("career_url")).alias("sameAs"),
            ).alias("hiringOrganization"),
            F.when(F.coalesce("location", F.lit("")) != "", place).alias("jobLocation"),
            F.when(
                F.col("remote_policy") == "remote-eu",
                F.struct(F.lit("Country").alias("@type"), F.lit("Europe").alias("name")),
            ).alias("applicantLocationRequirements"),
            F.when(F.col("remote_policy").startswith("remote"), F.lit("TELECOMMUTE")).alias(
                "jobLocationType"
            ),
            F.concat(
                F.lit(site.rstrip("/") + "/jobs/"),
                job_path(F.col("company_slug"), F.col("title"), F.col("id")),
                F.lit("/"),
            ).alias("url"),
            F.lit(False).alias("directApply"),
        )
    )
