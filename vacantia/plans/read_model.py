"""The enriched read model every listing, facet and search starts from."""

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions import classify as C
from vacantia.functions.money import salary_label
from vacantia.functions.text import join_present, or_else
from vacantia.functions.times import age_label, is_new

_LITE = [
    "id", "company_slug", "title", "url", "location", "source", "posted_at", "remote_policy",
    "seniority", "role_family", "employment_type", "salary_min", "salary_max",
    "salary_currency", "salary_period", "has_description",
]


def lite(jobs: DataFrame) -> DataFrame:
    """Listing rows: no description, upstream tags first, title rules as fallback."""
    title, location = F.col("title"), F.col("location")
    return jobs.withColumns(
        {
            "remote_policy": or_else(F.col("remote_policy"), C.remote_of_text(title, location)),
            "role_family": or_else(F.col("role_family"), C.role_of_title(title)),
            "employment_type": C.employment_type(title),
            "has_description": F.coalesce(F.length("description_md") > 50, F.lit(False)),
        }
    ).select(*_LITE)


def with_where(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Raw jobs with the company's country and the ``where`` bucket.

    The bucket uses the stored remote policy, as the facet counts do. No join hint:
    Spark broadcasts the companies while they are small and shuffles beyond that.
    """
    side = companies.select(
        F.col("slug").alias("company_slug"), F.col("country").alias("company_country")
    )
    return jobs.join(side, "company_slug", "left").withColumn(
        "where",
        C.where_bucket(F.col("remote_policy"), F.col("location"), F.col("company_country")),
    )


def meta_line(now: Column) -> Column:
    """NEW or age, remote label and salary, joined by a middle dot."""
    salary = salary_label(
        F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"),
        F.col("salary_period"),
    )
    posted = F.col("posted_at")
    return join_present(
        " · ",
        F.when(is_new(posted, now), "NEW").otherwise(age_label(posted, now)),
        C.remote_label(F.col("remote_policy")),
        salary,
    )


def search_text() -> Column:
    """Searchable body of a read-model row: the title and its synonyms."""
    return F.concat_ws(
        " ", "title", C.search_synonyms(F.col("role_family"), F.col("seniority"))
    )
