"""URL columns: resolution, domains, board detection, query parameters."""

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V
from vacantia.functions.regexes import contains_any

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, _AUTHORITY, 1)


def host(url: Column) -> Column:
    """Lower-cased host name without user and port; empty when there is none."""
    bare = F.regexp_replace(authority(url), r"^.*@", "")
    return F.lower(F.regexp_replace(bare, r":\d*$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def path_parts(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda p: p != "")


def first_part(url: Column) -> Column:
    """First non-empty path segment, empty when there is none."""
    return F.regexp_extract(path(url), r"^/*([^/]+)", 1)


def site_root(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), authority(url))


def absolute_url(url: Column, base: Column) -> Column:
    return resolve(url, site_root(base))


def resolve(url: Column, root: Column) -> Column:
    """Absolute form of a link found on a page of the site ``root``."""
    return (
        F.when(url.startswith("http://") | url.startswith("https://"), url)
        .when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(root, url))
        .otherwise(F.concat(root, F.lit("/"), url))
    )


def registrable_domain(url: Column) -> Column:
    """Last two host labels (deliberately naive about ``co.uk``)."""
    return F.substring_index(host(url), ".", -2)


def plausible_job_url(url: Column, source_domain: Column) -> Column:
    """Absolute, and on the source's own domain or naming a known board host."""
    on_board = contains_any(url, V.KNOWN_BOARD_HOSTS)
    absolute = url.startswith("http://") | url.startswith("https://")
    return F.coalesce(
        absolute & ((registrable_domain(url) == source_domain) | on_board), F.lit(False)
    )


def board_of(url: Column) -> Column:
    """``struct<provider, handle>`` when the URL is a known board, else null."""
    name, first = host(url), first_part(url)

    def under(domain: str, main: str) -> Column:
        return F.endswith(name, F.lit("." + domain)) & (name != main)

    def without(domain: str) -> Column:
        return F.replace(name, F.lit("." + domain), F.lit(""))

    def found(provider: str, handle: Column) -> Column:
        return F.struct(F.lit(provider).alias("provider"), handle.alias("handle"))

    has_part = first != ""
    return (
        F.when(F.contains(name, F.lit("greenhouse.io")) & has_part, found("greenhouse", first))
        .when((name == "jobs.lever.co") & has_part, found("lever", first))
        .when(under("ashbyhq.com", "jobs.ashbyhq.com"), found("ashby", without("ashbyhq.com")))
        .when(F.contains(name, F.lit("ashbyhq.com")) & has_part, found("ashby", first))
        .when(
            under("workable.com", "apply.workable.com"),
            found("workable", without("workable.com")),
        )
        .when(F.contains(name, F.lit("workable.com")) & has_part, found("workable", first))
        .when(
            F.contains(name, F.lit("smartrecruiters.com")) & has_part,
            found("smartrecruiters", first),
        )
        .when(
            F.endswith(name, F.lit(".recruitee.com")),
            found("recruitee", without("recruitee.com")),
        )
        .when(
            name.rlike(r"\.jobs\.personio\.(com|de)$"),
            found("personio", F.regexp_replace(name, r"\.jobs\.personio\.(com|de)$", "")),
        )
        .when(
            F.contains(name, F.lit("myworkdayjobs.com"))
            & F.contains(path(url), F.lit("/wday/cxs/"))
            & F.endswith(path(url), F.lit("/jobs")),
            found("workday", url),
        )
    )


def workday_site(final_url: Column, body: Column) -> Column:
    """``struct<tenant, cluster, site>`` from a landed URL and page body, else null."""
    host_rule = "(?i)" + V.WORKDAY_HOST
    in_url = final_url.rlike(host_rule)

    def part(group: int) -> Column:
        return F.lower(
            F.when(in_url, F.regexp_extract(final_url, host_rule, group)).otherwise(
                F.regexp_extract(body, host_rule, group)
            )
        )

    tenant, cluster = part(1), part(2)
    site_rule = "(?i)" + V.WORKDAY_SITE
    named_tenant = F.lower(F.regexp_extract(body, site_rule, 1))
    parts = path_parts(final_url)
    localised = F.coalesce(
        F.try_element_at(parts, F.lit(1)).rlike("^[a-z]{2}(-[A-Z]{2})?$"), F.lit(False)
    )
    from_path = F.try_element_at(parts, F.when(localised, 2).otherwise(1))
    site = F.when(
        (named_tenant != "") & (named_tenant == tenant), F.regexp_extract(body, site_rule, 2)
    ).otherwise(from_path)
    return F.when(
        (tenant != "") & site.isNotNull(),
        F.struct(tenant.alias("tenant"), cluster.alias("cluster"), site.alias("site")),
    )


def workday_base(api_url: Column) -> Column:
    """Public site root behind a ``/wday/cxs/<tenant>/<site>/jobs`` endpoint."""
    parts = path_parts(api_url)
    is_api = (
        (F.size(parts) >= 5)
        & (F.try_element_at(parts, F.lit(1)) == "wday")
        & (F.try_element_at(parts, F.lit(2)) == "cxs")
    )
    return F.when(
        is_api, F.concat(site_root(api_url), F.lit("/"), F.try_element_at(parts, F.lit(4)))
    ).otherwise(site_root(api_url))


def workday_job_url(base: Column, external_path: Column) -> Column:
    root = F.rtrim(base, F.lit("/"))
    return (
        F.when(F.coalesce(external_path, F.lit("")) == "", "")
        .when(external_path.startswith("http"), external_path)
        .when(external_path.startswith("/"), F.concat(root, external_path))
        .otherwise(F.concat(root, F.lit("/"), external_path))
    )


def country_requests(handle: Column, key: str = "_phenom_countries") -> Column:
    """Request URLs of a handle whose query lists countries: one per country.

    The list parameter itself is removed; without one there is a single request.
    """
    query = F.regexp_extract(handle, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    listed = F.filter(pairs, lambda p: p.startswith(key + "="))
    names = F.filter(
        F.transform(
            F.split(
                F.try_url_decode(F.substr(F.try_element_at(listed, F.lit(-1)), F.lit(len(key) + 2))),
                ",",
            ),
            lambda c: F.trim(c),
        ),
        lambda c: c != "",
    )
    kept = F.array_join(F.filter(pairs, lambda p: ~p.startswith(key + "=")), "&")
    clean = F.concat(
        F.regexp_extract(handle, r"^([^?#]*)", 1), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
        F.regexp_extract(handle, r"(#.*)$", 1),
    )
    glue = F.when(F.contains(clean, F.lit("?")), "&").otherwise("?")
    fanned = F.transform(
        names,
        lambda c: F.concat(clean, glue, F.lit("country="), F.replace(c, F.lit(" "), F.lit("%20"))),
    )
    return F.when(F.coalesce(F.size(names), F.lit(0)) > 0, fanned).otherwise(F.array(clean))
