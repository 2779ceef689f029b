"""Row validation: the names of the rules a row breaks."""

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V
from vacantia.functions.ids import is_slug


def _broken(rules: dict[str, Column]) -> Column:
    """Array of rule names; a rule whose check is null counts as broken."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    )


def _known(col: Column, allowed: list[str]) -> Column:
    return col.isNull() | col.isin(allowed)


def _all_known(col: Column, allowed: list[str]) -> Column:
    return col.isNull() | (F.size(F.array_except(col, F.array(*[F.lit(a) for a in allowed]))) == 0)


def company_violations() -> Column:
    """Over the columns of the companies table."""
    c = F.col
    has_board = c("ats_provider").isNotNull() & c("ats_handle").isNotNull()
    half_board = c("ats_provider").isNotNull() != c("ats_handle").isNotNull()
    return _broken(
        {
            "slug": is_slug(c("slug")) & F.length(c("slug")).between(1, 64),
            "name": c("name").isNotNull(),
            "country": F.length(c("country")) == 2,
            "categories": _all_known(c("categories"), V.CATEGORIES),
            "industry_tags": _all_known(c("industry_tags"), V.LANE_INDUSTRIES),
            "ats": ~half_board
            & _known(c("ats_provider"), V.PROVIDERS)
            & (c("ats_handle").isNull() | F.length(c("ats_handle")).between(1, 512)),
            "funding_stage": _known(c("funding_stage"), V.FUNDING_STAGES),
            "size_bucket": _known(c("size_bucket"), V.SIZE_BUCKETS),
            "source": has_board | c("career_url").isNotNull(),
        }
    )


def job_violations() -> Column:
    """Over the columns of the jobs table."""
    c = F.col
    no_band = c("salary_currency").isNull() & c("salary_min").isNull() & c("salary_max").isNull()
    band_ok = (
        (F.length(c("salary_currency")) == 3)
        & (c("salary_min").isNotNull() | c("salary_max").isNotNull())
        & F.coalesce(c("salary_min") <= c("salary_max"), F.lit(True))
    )
    return _broken(
        {
            "id": c("id").isNotNull(),
            "company_slug": c("company_slug").isNotNull(),
            "title": c("title").isNotNull(),
            "url": c("url").isNotNull(),
            "remote_policy": _known(c("remote_policy"), V.REMOTE_POLICIES),
            "seniority": _known(c("seniority"), V.SENIORITIES),
            "role_family": _known(c("role_family"), V.ROLE_FAMILIES),
            "salary": no_band | F.coalesce(band_ok, F.lit(False)),
            "salary_period": _known(c("salary_period"), V.SALARY_PERIODS),
            "source": c("source").isNotNull(),
        }
    )
