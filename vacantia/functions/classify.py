"""Ordered-rule classifiers and row predicates."""

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V
from vacantia.functions.regexes import (
    contains_any, first_rule, has, is_ascii, plain_regex, unicode_regex,
)
from vacantia.functions.text import or_else, strip


def lookup(table: dict[str, str], key: Column) -> Column:
    literal = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(literal, F.coalesce(key, F.lit("")))


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


# --- location and keep rule ---------------------------------------------------


def non_eu_location(location: Column) -> Column:
    """Clearly names a place outside Europe and nothing European or worldwide."""
    text = F.coalesce(location, F.lit(""))
    return (
        F.when(strip(text) == "", False)
        .when(has(text, V.EU_OR_GLOBAL_PLACES), False)
        .otherwise(has(text, V.NON_EU_PLACES) | has(text, V.US_STATE_SUFFIX))
    )


def off_scope_title(title: Column) -> Column:
    return has(title, V.OFF_SCOPE_TITLE)


def keep_job(title: Column, remote_policy: Column, location: Column) -> Column:
    """The cheap title test first, then the remote override, then the location."""
    reachable = F.coalesce(remote_policy.isin("remote-global", "remote-eu"), F.lit(False))
    return (
        F.when(off_scope_title(title), False)
        .when(reachable, True)
        .otherwise(~non_eu_location(location))
    )


def eu_signal(location: Column) -> Column:
    """No restriction declared, or any of the EU words as a plain substring."""
    low = F.lower(F.coalesce(location, F.lit("")))
    return (low == "") | contains_any(low, V.EU_SIGNAL_WORDS)


def eu_country_named(location: Column) -> Column:
    """The EU country named in a location, capitalised; empty without one."""
    found = F.when(
        is_ascii(location), F.regexp_extract(location, plain_regex(V.EU_COUNTRY_TEXT), 1)
    ).otherwise(F.regexp_extract(location, unicode_regex(V.EU_COUNTRY_TEXT), 1))
    return F.initcap(found)


def eu_or_remote(location: Column, named: Column | None = None) -> Column:
    """``struct<keep, country, remote_policy>``: worldwide > remote EU > EU country.

    ``named`` is `eu_country_named` where the caller has evaluated it; it is used several
    times here.
    """
    def verdict(keep: bool, country: Column, policy: str | None) -> Column:
        return F.struct(
            F.lit(keep).alias("keep"),
            country.cast("string").alias("country"),
            F.lit(policy).cast("string").alias("remote_policy"),
        )

    country = eu_country_named(location) if named is None else named
    code = F.coalesce(lookup(V.EU_COUNTRY_CODES, country), F.lit("XX"))
    return (
        F.when(F.coalesce(location, F.lit("")) == "", verdict(False, F.lit(None), None))
        .when(
            has(location, V.REMOTE_GLOBAL_TEXT),
            verdict(True, F.lit("XX"), "remote-global"),
        )
        .when(
            has(location, V.REMOTE_EU_TEXT),
            verdict(True, F.lit("XX"), "remote-eu"),
        )
        .when(country == "", verdict(False, F.lit(None), None))
        .otherwise(verdict(True, code, None))
    )


def eu_company(*texts: Column) -> Column:
    """Any European place word in the joined text fields (arrays are joined too)."""
    return contains_any(F.lower(F.concat_ws(" ", *texts)), V.EU_COMPANY_WORDS)


def country_of_text(text: Column) -> Column:
    """Code of the first table entry found as a case-sensitive substring, else ``XX``."""
    chain = None
    for place, code in V.PLACE_TO_CODE.items():
        hit = F.contains(text, F.lit(place))
        chain = F.when(hit, code) if chain is None else chain.when(hit, code)
    return chain.otherwise("XX")


def startup_category(industries: Column) -> Column:
    """``ai`` when any industry has ai, ml or machine anywhere inside, else ``tech``."""
    low = F.lower(F.concat_ws("\n", industries))
    return F.when(low.rlike("ai|ml|machine"), "ai").otherwise("tech")


def country_name(code: Column) -> Column:
    known = or_else(lookup(V.COUNTRY_NAMES, code), or_else(code))
    return F.coalesce(known, F.lit("—"))


# --- titles -------------------------------------------------------------------


def employment_type(title: Column) -> Column:
    return first_rule(title, V.EMPLOYMENT_RULES, F.lit("permanent"))


def role_of_title(title: Column) -> Column:
    return first_rule(title, V.ROLE_RULES, F.lit(None).cast("string"))


def remote_of_text(title: Column, location: Column) -> Column:
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(location, F.lit("")))
    return first_rule(text, V.REMOTE_RULES, F.lit(None).cast("string"))


def where_bucket(remote_policy: Column, location: Column, company_country: Column) -> Column:
    """One facet value bundling countries and remote tiers."""
    loc = F.lower(F.coalesce(location, F.lit("")))
    tokens = F.split(loc, V.PLACE_TOKEN_SEPARATOR)

    cities = [c for names in V.CITIES_BY_COUNTRY.values() for c in names]
    homes = [k for k, names in V.CITIES_BY_COUNTRY.items() for _ in names]
    city = F.try_element_at(F.array_intersect(_array(cities), tokens), F.lit(1))
    city_home = F.try_element_at(
        _array(homes), F.array_position(_array(cities), city).cast("int")
    )

    names = list(V.COUNTRY_NAMES.values())
    lowered = [n.lower() for n in names]
    phrases = F.array_compact(
        F.array(*[F.when(F.contains(loc, F.lit(n)), n) for n in lowered if " " in n])
    )
    named = F.try_element_at(
        F.array_intersect(_array(lowered), F.concat(tokens, phrases)), F.lit(1)
    )
    named_country = F.try_element_at(
        _array(names), F.array_position(_array(lowered), named).cast("int")
    )

    suffix = F.upper(F.regexp_extract(loc, r",\s*([a-z]{2})(?![A-Za-z0-9_])", 1))
    by_suffix = lookup(V.COUNTRY_NAMES, suffix)
    headquarters = F.when(
        company_country.isin(V.EU_HQ_COUNTRIES), lookup(V.COUNTRY_NAMES, company_country)
    )
    return (
        F.when(remote_policy == "remote-global", V.WHERE_WORLDWIDE)
        .when(remote_policy == "remote-eu", V.WHERE_EUROPE)
        .when(has(loc, V.WHERE_WORLDWIDE_TEXT, dialect="ascii"), V.WHERE_WORLDWIDE)
        .when(has(loc, V.WHERE_EUROPE_TEXT, dialect="ascii"), V.WHERE_EUROPE)
        .otherwise(
            F.coalesce(
                # An impossible empty-token list for empty text falls through by itself.
                city_home,
                named_country,
                by_suffix,
                headquarters,
                F.when(remote_policy == "remote", V.WHERE_REMOTE),
                F.lit(V.WHERE_OTHER),
            )
        )
    )


# --- aggregator gates ---------------------------------------------------------


def tech_relevant(title: Column, sectors: Column) -> Column:
    """Title rule, or a sector word in any key or value of ``array<map>`` ``sectors``."""
    pairs = F.flatten(
        F.transform(sectors, lambda m: F.flatten(F.array(F.map_keys(m), F.map_values(m))))
    )
    words = F.lower(F.concat_ws("\n", pairs))
    return has(title, V.TECH_TITLE) | contains_any(words, V.TECH_SECTOR_WORDS)


def lane_relevant(sectors: Column) -> Column:
    parents = F.flatten(F.transform(sectors, F.map_keys))
    return F.coalesce(F.arrays_overlap(parents, _array(V.LANE_SECTORS)), F.lit(False))


def remote_of_flag(remote: Column) -> Column:
    return F.when(remote == "fulltime", "remote").when(remote == "partial", "hybrid")


# --- public site rules --------------------------------------------------------


def lane_company(industry_tags: Column) -> Column:
    return F.coalesce(
        F.arrays_overlap(industry_tags, _array(V.LANE_INDUSTRIES)), F.lit(False)
    )


def lane_title(title: Column) -> Column:
    """A buying or product title that is not a trainee, assistant or fixed-term one."""
    wanted = has(title, "|".join(V.LANE_ROLE_PATTERNS), dialect="ascii")
    return wanted & ~has(title, V.LANE_EXCLUDED_TITLE, dialect="ascii")


def france_or_remote(remote_policy: Column, location: Column, country: Column) -> Column:
    low = F.lower(F.coalesce(location, F.lit("")))
    return F.coalesce(
        remote_policy.isin("remote-eu", "remote-global"), F.lit(False)
    ) | contains_any(low, ["france", "paris", ", fr"]) | F.coalesce(country == "FR", F.lit(False))


def excluded_company(slug: Column) -> Column:
    bare = F.regexp_replace(slug, V.LANE_COMPANY_PREFIX, "")
    return (bare == V.LANE_EXCLUDED_COMPANY) | bare.startswith(V.LANE_EXCLUDED_COMPANY + "-")


def source_class(source: Column) -> Column:
    return F.when(source.isin(V.ATS_CLASS_SOURCES), "ats").otherwise("aggregator")


def search_synonyms(role_family: Column, seniority: Column) -> Column:
    """Extra words a posting is findable by; absent parts are skipped."""
    return F.concat_ws(
        " ", lookup(V.SEARCH_SYNONYMS, role_family), lookup(V.SENIORITY_SYNONYMS, seniority)
    )


def remote_label(remote_policy: Column) -> Column:
    return F.coalesce(lookup(V.REMOTE_LABELS, remote_policy), F.lit(""))


def oss_signal(stars: Column, language: Column) -> Column:
    return (F.coalesce(stars, F.lit(0)) >= V.OSS_STAR_THRESHOLD) & F.coalesce(
        language.isin(V.OSS_LANGUAGES), F.lit(False)
    )
