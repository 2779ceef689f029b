"""Which companies and jobs each surface shows."""

from pyspark.sql import DataFrame, functions as F

from vacantia.functions import classify as C
from vacantia.functions.times import posted_within


def _named(slug):
    return ~F.coalesce(slug, F.lit("")).startswith("via-") & (
        F.coalesce("name", F.lit("")) != ""
    )


def public_companies(companies: DataFrame) -> DataFrame:
    slug = F.col("slug")
    return companies.filter(
        _named(slug) & (F.col("name") != slug) & ~C.lane_company(F.col("industry_tags"))
    )


def lane_companies(companies: DataFrame) -> DataFrame:
    return companies.filter(_named(F.col("slug")) & C.lane_company(F.col("industry_tags")))


def _of(jobs: DataFrame, companies: DataFrame, columns: list[str]) -> DataFrame:
    side = companies.select(
        F.col("slug").alias("company_slug"), *[F.col(c).alias(f"company_{c}") for c in columns]
    )
    return jobs.filter(F.coalesce("company_slug", F.lit("")) != "").join(side, "company_slug")


def public_jobs(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs of public companies, with the company's name and country."""
    return _of(jobs, public_companies(companies), ["name", "country"])


def lane_jobs(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs of the industry-lane companies the public surfaces hide."""
    return _of(jobs, lane_companies(companies), ["name", "country"])


def all_page_jobs(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Every job that gets a page: public and lane, marked."""
    return public_jobs(jobs, companies).withColumn("is_lane", F.lit(False)).unionByName(
        lane_jobs(jobs, companies).withColumn("is_lane", F.lit(True))
    )


def curated_lane(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Lane jobs in France or remote, with a buying or product title, newest first."""
    return (
        lane_jobs(jobs, companies)
        .filter(
            ~C.excluded_company(F.col("company_slug"))
            & C.france_or_remote(
                F.col("remote_policy"), F.col("location"), F.col("company_country")
            )
            & C.lane_title(F.col("title"))
        )
        .orderBy(F.col("posted_at").desc_nulls_last(), F.col("id"))
    )


def header_counts(jobs: DataFrame, companies: DataFrame, now) -> DataFrame:
    """Status strip: public jobs, public companies, new today."""
    shown = public_jobs(jobs, companies)
    firms = public_companies(companies).agg(F.count("*"))
    return shown.agg(
        F.count("*").alias("job_count"),
        F.count_if(posted_within(F.col("posted_at"), now, 1)).alias("new_today"),
    ).withColumn("company_count", firms.scalar())


def lane_coverage(companies: DataFrame) -> DataFrame:
    """How many companies carry a lane industry tag."""
    return lane_companies(companies).agg(F.count("*").alias("lane_companies"))
