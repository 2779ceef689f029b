"""Which reader a company's postings come from, and the requests to land."""

from pyspark.sql import DataFrame, functions as F

from vacantia import fixed_values as V
from vacantia.functions.text import or_else
from vacantia.functions.urls import country_requests


def resolve_routes(companies: DataFrame) -> DataFrame:
    """``slug, route, handle, error``: board, else careers page, else an error row.

    A provider without a reader is an error row too.
    """
    board = F.col("ats_provider").isNotNull()
    page = or_else(F.col("career_url"))
    route = F.when(board, F.col("ats_provider")).when(page.isNotNull(), "custom_page").otherwise("none")
    routed = companies.select(
        "slug", route.alias("route"), F.when(board, F.col("ats_handle")).otherwise(page).alias("handle")
    )
    return routed.withColumn(
        "error",
        F.when(F.col("route") == "none", "No ATS handle or career_url").when(
            ~F.col("route").isin(V.BOARD_SOURCES),
            F.concat(F.lit("Unsupported provider: "), F.col("route")),
        ),
    )


def requests(routes: DataFrame) -> DataFrame:
    """One row per request to land; a country list in a handle fans out."""
    good = routes.filter(F.col("error").isNull())
    return good.select("slug", "route", F.posexplode(country_requests(F.col("handle"))).alias("n", "url"))
