"""Readers of multi-company payloads: each posting brings its company along."""

from pyspark.sql import Column, DataFrame, functions as F

from vacantia import fixed_values as V
from vacantia.functions import classify as C
from vacantia.functions.ids import (
    company_from_slug,
    is_slug,
    prefixed_slug,
    slugify,
    title_from_slug,
)
from vacantia.functions.text import (
    head, html_to_markdown, join_present, or_else, strip, strip_computed,
)
from vacantia.functions.times import iso_or_epoch, iso_time, rfc822_time
from vacantia.functions.once import evaluate_once
from vacantia.sources.payloads import aggregator, items, postings, text, titled


def _r(name: str) -> Column:
    return F.col(f"raw.{name}")


def _words(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _firm(name: Column, country: Column, categories: Column, url: Column, notes: Column,
          industry_tags: Column | None = None) -> dict[str, Column]:
    return {
        "name": name, "country": country, "categories": categories,
        "industry_tags": _words() if industry_tags is None else industry_tags,
        "career_url": url, "notes": notes,
    }


@aggregator("remoteok")
def remoteok(payloads: DataFrame) -> DataFrame:
    schema = """ARRAY<STRUCT<legal: STRING, company: STRING, url: STRING, apply_url: STRING,
        position: STRING, location: STRING, description: STRING, date: STRING,
        epoch: STRING>>"""
    rows = items(payloads, F.from_json("body", schema))
    header = (F.col("item") == 0) & _r("legal").isNotNull()
    name = text(_r("company"))
    url = or_else(_r("url"), _r("apply_url"))
    location = or_else(text(_r("location")), F.lit("Remote"))
    kept = rows.filter(~header & C.eu_signal(_r("location")) & (name != ""))
    return postings(
        kept,
        company=_firm(
            name, F.lit("XX"), _words("tech", "remote-eu"), url,
            F.concat(F.lit("Aggregated from RemoteOK ("), location, F.lit(")")),
        ),
        company_slug=F.concat(F.lit("via-remoteok-"), slugify(name)),
        title=titled(_r("position")), url=url, location=location,
        remote_policy=F.lit("remote-global"),
        posted_at=iso_or_epoch(or_else(_r("date"), _r("epoch")), millis="never"),
        description_md=html_to_markdown(_r("description")),
    )


@aggregator("weworkremotely")
def weworkremotely(payloads: DataFrame) -> DataFrame:
    """RSS; the item title is ``Company: Role``."""
    schema = """channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING,
        description: STRING, region: STRING, pubDate: STRING>>>"""
    rows = items(payloads, F.from_xml("body", schema, {"mode": "PERMISSIVE"})["channel"]["item"])
    split = evaluate_once(rows, parts=F.split(_r("title"), ":", 2))
    rows = evaluate_once(
        split, firm=F.col("parts")[0], role=F.try_element_at(F.col("parts"), F.lit(2))
    )
    name, title = text(F.col("firm")), text(F.col("role"))
    url = text(_r("link"))
    region = or_else(text(_r("region")), F.lit("Remote"))
    return postings(
        rows.filter((name != "") & (title != "")),
        company=_firm(
            name, F.lit("XX"), _words("tech", "remote-eu"), url,
            F.concat(F.lit("Aggregated from WeWorkRemotely ("), region, F.lit(")")),
        ),
        company_slug=F.concat(F.lit("via-wwr-"), slugify(name)),
        title=title, url=url, location=region, remote_policy=F.lit("remote-global"),
        posted_at=rfc822_time(_r("pubDate")), description_md=text(_r("description")),
    )


@aggregator("justjoinit")
def justjoinit(payloads: DataFrame) -> DataFrame:
    offer = """ARRAY<STRUCT<guid: STRING, slug: STRING, title: STRING, companyName: STRING,
        city: STRING, country: STRING, workplaceType: STRING, publishedAt: STRING,
        lastPublishedAt: STRING>>"""
    bare = F.from_json("body", offer)
    wrapped = F.from_json("body", f"data {offer}, offers {offer}")
    is_list = F.ltrim("body").startswith("[")
    filled = F.when(F.size(wrapped["data"]) > 0, wrapped["data"]).otherwise(wrapped["offers"])
    rows = items(payloads, F.when(is_list, bare).otherwise(filled))
    name, city = text(_r("companyName")), text(_r("city"))
    offer_slug = or_else(_r("slug"), or_else(_r("guid")))
    url = F.concat(F.lit("https://justjoin.it/offers/"), offer_slug)
    country = or_else(
        F.upper(F.substring(strip(or_else(_r("country"), F.lit("PL"))), 1, 2)), F.lit("PL")
    )
    place = F.lower(F.coalesce(_r("workplaceType"), F.lit("")))
    return postings(
        rows.filter(name != ""),
        company=_firm(
            name, country, _words("tech"), url,
            F.concat(
                F.lit("Aggregated from JustJoin.it ("), or_else(city, F.lit("Remote")), F.lit(")")
            ),
        ),
        company_slug=F.concat(F.lit("via-justjoinit-"), slugify(name)),
        title=titled(_r("title")), url=url, location=join_present(", ", city, country),
        remote_policy=F.when(place.isin("remote", "hybrid"), place).otherwise("onsite"),
        posted_at=iso_time(or_else(_r("publishedAt"), _r("lastPublishedAt"))),
    )


_HITS = """hits ARRAY<STRUCT<name: STRING, slug: STRING, language: STRING, remote: STRING,
    published_at: STRING, organization: STRUCT<slug: STRING, name: STRING, nb_employees: STRING>,
    offices: ARRAY<STRUCT<city: STRING, country: STRING, country_code: STRING>>,
    sectors_name: STRUCT<en: ARRAY<MAP<STRING, STRING>>>>>"""


def _hits(payloads: DataFrame, *, lane: bool, offices: int | None = None) -> DataFrame:
    """One hit, one posting. The lane pass keeps fashion sectors, the other tech roles.

    The location names the first ``offices`` offices, by default all.
    """
    rows = items(payloads, F.from_json("body", _HITS)["hits"])
    sectors = _r("sectors_name.en")
    gate = C.lane_relevant(sectors) if lane else C.tech_relevant(_r("name"), sectors)
    org, job = _r("organization.slug"), _r("slug")
    present = (
        (F.coalesce(org, F.lit("")) != "")
        & (F.coalesce(_r("organization.name"), F.lit("")) != "")
        & (F.coalesce(job, F.lit("")) != "")
        & (F.coalesce(_r("name"), F.lit("")) != "")
    )
    language = or_else(_r("language"), F.lit("en"))
    shown_language = F.when(language.isin(V.LISTING_LANGUAGES), language).otherwise("en")
    root = "https://www.welcometothejungle.com/"
    shown = _r("offices") if offices is None else F.slice(_r("offices"), 1, offices)
    office = F.transform(shown, lambda o: join_present(", ", o["city"], o["country"]))
    country = or_else(F.try_element_at(_r("offices"), F.lit(1))["country_code"], F.lit("XX"))
    staff = F.coalesce(_r("organization.nb_employees"), F.lit("?"))
    return postings(
        rows.filter(present & gate),
        company=_firm(
            _r("organization.name"), country, _words() if lane else _words("tech"),
            F.concat(F.lit(root + "en/companies/"), org),
            F.concat(
                F.lit("Aggregated from Welcome to the Jungle ("), staff, F.lit(" employees)"),
                F.lit(" — fashion lane." if lane else ""),
            ),
            _words("fashion") if lane else _words(),
        ),
        company_slug=prefixed_slug("wttjc-" if lane else "wttj-", slugify(org)),
        title=strip(_r("name")),
        url=F.concat(
            F.lit(root), shown_language, F.lit("/companies/"), org, F.lit("/jobs/"), job
        ),
        location=F.coalesce(
            F.array_join(F.filter(office, lambda o: o != ""), "; "), F.lit("")
        ),
        remote_policy=C.remote_of_flag(_r("remote")),
        posted_at=iso_or_epoch(_r("published_at"), millis="never"),
    )


@aggregator("wttj")
def wttj(payloads: DataFrame, offices: int | None = None) -> DataFrame:
    """Payloads fetched for the lane carry ``lane`` as their handle."""
    lane = F.coalesce(F.col("handle") == "lane", F.lit(False))
    return _hits(payloads.filter(~lane), lane=False, offices=offices).unionByName(
        _hits(payloads.filter(lane), lane=True, offices=offices)
    )


def _captures(text_col: Column, pattern: str, groups: dict[str, int]) -> Column:
    """All matches of ``pattern`` as ``array<struct>`` of named groups."""
    columns = [F.regexp_extract_all(text_col, F.lit(pattern), n) for n in groups.values()]
    return F.arrays_zip(*[c.alias(n) for n, c in zip(groups, columns)])


@aggregator("fashionjobs")
def fashionjobs(payloads: DataFrame) -> DataFrame:
    """Listing page; everything is in the offer links."""
    offers = _captures(F.col("body"), V.FASHION_OFFER, {"url": 1, "company": 2, "title": 3})
    rows = items(payloads, offers)
    slug = prefixed_slug("fjr-", F.lower(_r("company")))
    return postings(
        rows.filter(is_slug(slug)),
        company=_firm(
            company_from_slug(_r("company")), F.lit("FR"), _words(),
            F.concat(F.lit("https://fr.fashionjobs.com/recrutement/"), _r("company"), F.lit(".html")),
            F.lit("Aggregated from fashionjobs.com (fashion lane)."), _words("fashion"),
        ),
        company_slug=slug, title=title_from_slug(_r("title")), url=_r("url"),
        location=F.lit("France"),
    )


@aggregator("bof")
def bof(payloads: DataFrame, block_limit: int | None = None) -> DataFrame:
    """Listing page of item blocks; only European or remote places stay.

    Of each block ``block_limit`` characters are read, by default all.
    """
    # Blocks start at the item class; what precedes the first one is dropped, and a
    # closing section ends the block it is in.
    opened = F.filter(
        F.split("body", r'class="lister__item(?=[^"]*"\s+id="item-\d+")'),
        lambda b, i: i > 0,
    )
    blocks = F.transform(
        opened,
        lambda b: head(
            F.regexp_replace(
                F.substring_index(F.substring_index(b, "</section>", 1), 'class="lister__item', 1),
                r'^[^"]*"\s+id="item-\d+"', "",
            ),
            block_limit,
        ),
    )
    # The link is sought once; its parts are then read from the few characters it has.
    linked = evaluate_once(items(payloads, blocks), link=F.regexp_extract("raw", V.LISTING_TITLE, 0))
    found = evaluate_once(
        linked.filter(F.col("link") != ""),
        path=strip_computed(F.regexp_extract("link", V.LISTING_TITLE, 1)),
        full_title=strip_computed(F.regexp_extract("link", V.LISTING_TITLE, 2)),
        place=strip_computed(F.regexp_extract("raw", V.LISTING_LOCATION, 1)),
        brand=strip_computed(F.regexp_extract("raw", V.LISTING_BRAND, 1)),
    )
    found = evaluate_once(found.filter(F.col("path") != ""), named=C.eu_country_named(F.col("place")))
    rows = evaluate_once(found, gate=C.eu_or_remote(F.col("place"), F.col("named")))
    rest = F.btrim(F.substr("full_title", F.length("brand") + 1), F.lit(" :,-"))
    starts = (F.col("brand") != "") & F.lower("full_title").startswith(F.lower("brand"))
    title = or_else(F.when(starts, rest).otherwise(F.col("full_title")), F.col("full_title"))
    firm = or_else(F.col("brand"), F.lit("Unknown"))
    slug = prefixed_slug("bof-", slugify(firm))
    return postings(
        rows.filter(F.col("gate.keep") & is_slug(slug)),
        company=_firm(
            firm, or_else(F.col("gate.country"), F.lit("XX")), _words(),
            F.lit(V.LISTING_BASE + "/careers/"),
            F.lit("Aggregated from Business of Fashion Careers (fashion lane)."),
            _words("fashion"),
        ),
        company_slug=slug, title=title, url=F.concat(F.lit(V.LISTING_BASE), F.col("path")),
        location=F.col("place"), remote_policy=F.col("gate.remote_policy"),
    )


@aggregator("eures")
def eures(payloads: DataFrame) -> DataFrame:
    """Announced source without a payload format: always empty."""
    rows = items(payloads.filter(F.lit(False)), F.array("body"))
    return postings(
        rows, company=_firm(*[F.lit("")] * 2, _words(), F.lit(""), F.lit("")),
        title=F.col("raw"), url=F.col("raw"),
    )
