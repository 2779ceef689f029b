"""Readers of single-company board payloads (JSON and XML)."""

from pyspark.sql import Column, DataFrame, functions as F

from vacantia import fixed_values as V
from vacantia.functions import urls as U
from vacantia.functions.once import evaluate_once
from vacantia.functions.text import html_to_markdown, join_present, or_else, strip
from vacantia.functions.times import iso_or_epoch, iso_time
from vacantia.sources.payloads import board, items, postings, text, titled


def _r(name: str) -> Column:
    return F.col(f"raw.{name}")


@board("greenhouse")
def greenhouse(payloads: DataFrame) -> DataFrame:
    schema = """jobs ARRAY<STRUCT<title: STRING, absolute_url: STRING, content: STRING,
        location: STRUCT<name: STRING>, first_published: STRING, updated_at: STRING>>"""
    rows = items(payloads, F.from_json("body", schema)["jobs"])
    return postings(
        rows,
        title=titled(_r("title")), url=_r("absolute_url"), location=text(_r("location.name")),
        posted_at=iso_time(or_else(_r("first_published"), _r("updated_at"))),
        description_md=html_to_markdown(_r("content")),
    )


@board("lever")
def lever(payloads: DataFrame) -> DataFrame:
    schema = """ARRAY<STRUCT<text: STRING, hostedUrl: STRING, applyUrl: STRING,
        categories: STRUCT<location: STRING>, description: STRING, additional: STRING,
        lists: ARRAY<STRUCT<text: STRING, content: STRING>>, createdAt: STRING>>"""
    rows = items(payloads, F.from_json("body", schema))
    # Lists become headed sections between the description and the closing text.
    sections = F.transform(
        _r("lists"),
        lambda s: join_present(
            "\n\n",
            F.when(text(s["text"]) != "", F.concat(F.lit("## "), text(s["text"]))),
            html_to_markdown(s["content"]),
        ),
    )
    return postings(
        rows,
        title=titled(_r("text")), url=or_else(_r("hostedUrl"), _r("applyUrl")),
        location=text(_r("categories.location")),
        posted_at=iso_or_epoch(_r("createdAt"), millis="always"),
        description_md=join_present(
            "\n\n",
            html_to_markdown(_r("description")),
            F.array_join(F.filter(sections, lambda s: s != ""), "\n\n"),
            html_to_markdown(_r("additional")),
        ),
    )


@board("ashby")
def ashby(payloads: DataFrame) -> DataFrame:
    schema = """data STRUCT<jobBoard: STRUCT<jobPostings: ARRAY<STRUCT<id: STRING,
        title: STRING, locationName: STRING,
        secondaryLocations: ARRAY<STRUCT<locationName: STRING>>>>>>"""
    rows = items(payloads, F.from_json("body", schema)["data"]["jobBoard"]["jobPostings"])
    main = text(_r("locationName"))
    extra = F.array_join(
        F.filter(_r("secondaryLocations")["locationName"], lambda n: F.coalesce(n, F.lit("")) != ""),
        ", ",
    )
    location = (
        F.when(F.coalesce(extra, F.lit("")) == "", main)
        .when(main == "", extra)
        .otherwise(F.concat(main, F.lit(" (+ "), extra, F.lit(")")))
    )
    return postings(
        rows.filter(F.coalesce(_r("id"), F.lit("")) != ""),
        title=titled(_r("title")), location=location,
        url=F.concat(F.lit("https://jobs.ashbyhq.com/"), F.col("handle"), F.lit("/"), _r("id")),
    )


@board("smartrecruiters")
def smartrecruiters(payloads: DataFrame) -> DataFrame:
    section = "STRUCT<title: STRING, text: STRING>"
    schema = f"""content ARRAY<STRUCT<id: STRING, uuid: STRING, name: STRING, ref: STRING,
        company: STRUCT<identifier: STRING>,
        location: STRUCT<city: STRING, region: STRING, country: STRING>,
        jobAd: STRUCT<sections: STRUCT<companyDescription: {section}, jobDescription: {section},
          qualifications: {section}, additionalInformation: {section}>>,
        releasedDate: STRING, createdOn: STRING>>"""
    rows = items(payloads, F.from_json("body", schema)["content"])
    post_id = or_else(_r("id"), _r("uuid"))
    company = or_else(_r("company.identifier"), F.col("company_slug"))
    built = F.concat(
        F.lit("https://jobs.smartrecruiters.com/"), company, F.lit("/"), post_id
    )
    parts = []
    for name in ("companyDescription", "jobDescription", "qualifications", "additionalInformation"):
        title = F.nullif(_r(f"jobAd.sections.{name}.title"), F.lit(""))
        parts += [
            F.concat(F.lit("## "), title),
            html_to_markdown(_r(f"jobAd.sections.{name}.text")),
        ]
    return postings(
        rows.filter(F.coalesce(post_id, F.lit("")) != ""),
        title=titled(_r("name")), url=or_else(_r("ref"), built),
        location=join_present(
            ", ", _r("location.city"), _r("location.region"), _r("location.country")
        ),
        posted_at=iso_time(or_else(_r("releasedDate"), _r("createdOn"))),
        description_md=join_present("\n\n", *parts),
    )


@board("recruitee")
def recruitee(payloads: DataFrame) -> DataFrame:
    schema = """offers ARRAY<STRUCT<title: STRING, careers_url: STRING,
        careers_apply_url: STRING, city: STRING, country: STRING, description: STRING,
        requirements: STRING, created_at: STRING, published_at: STRING>>"""
    rows = items(payloads, F.from_json("body", schema)["offers"])
    stamp = or_else(_r("created_at"), _r("published_at"))
    return postings(
        rows,
        title=titled(_r("title")), url=or_else(_r("careers_url"), _r("careers_apply_url")),
        location=join_present(", ", _r("city"), _r("country")),
        posted_at=iso_time(F.regexp_replace(stamp, " UTC$", "Z")),
        description_md=html_to_markdown(or_else(_r("description"), _r("requirements"))),
    )


@board("personio")
def personio(payloads: DataFrame) -> DataFrame:
    """XML feed; a body that does not parse yields nothing."""
    schema = """position ARRAY<STRUCT<id: STRING, name: STRING, office: STRING,
        createdAt: STRING, created_at: STRING,
        jobDescriptions: STRUCT<jobDescription: ARRAY<STRUCT<name: STRING, value: STRING>>>>>"""
    rows = items(payloads, F.from_xml("body", schema, {"mode": "PERMISSIVE"})["position"])
    described = F.transform(
        _r("jobDescriptions.jobDescription"),
        lambda d: join_present(
            "\n\n",
            F.when(text(d["name"]) != "", F.concat(F.lit("## "), text(d["name"]))),
            text(d["value"]),
        ),
    )
    post_id, title = text(_r("id")), text(_r("name"))
    return postings(
        rows.filter((post_id != "") & (title != "")),
        title=title, location=text(_r("office")),
        url=F.concat(
            F.lit("https://"), F.col("handle"), F.lit(".jobs.personio.com/job/"), post_id
        ),
        posted_at=iso_time(or_else(_r("createdAt"), _r("created_at"))),
        description_md=F.coalesce(
            F.array_join(F.filter(described, lambda d: d != ""), "\n\n"), F.lit("")
        ),
    )


@board("workday")
def workday(payloads: DataFrame) -> DataFrame:
    """Posting ages are relative words there, so no date is taken."""
    schema = """jobPostings ARRAY<STRUCT<title: STRING, externalPath: STRING,
        locationsText: STRING>>"""
    rows = items(payloads, F.from_json("body", schema)["jobPostings"])
    title = text(_r("title"))
    return postings(
        rows.filter(title != ""),
        title=title, location=text(_r("locationsText")),
        url=U.workday_job_url(U.workday_base(F.col("handle")), _r("externalPath")),
    )


@board("phenom")
def phenom(payloads: DataFrame) -> DataFrame:
    schema = """jobs ARRAY<STRUCT<data: STRUCT<slug: STRING, req_id: STRING, title: STRING,
        city: STRING, state: STRING, country: STRING, description: STRING,
        location: STRUCT<city: STRING, state: STRING, country: STRING, name: STRING>,
        posted_date: STRING, postedAt: STRING, postedDate: STRING>>>"""
    rows = items(payloads, F.from_json("body", schema)["jobs"])
    slug = or_else(_r("data.slug"), _r("data.req_id"))
    title = text(_r("data.title"))

    def joined(prefix: str, names: list[str]) -> Column:
        return join_present(", ", *[strip(_r(f"{prefix}.{n}")) for n in names])

    flat = joined("data", ["city", "state", "country"])
    nested = joined("data.location", ["city", "state", "country", "name"])
    stamp = or_else(_r("data.posted_date"), _r("data.postedAt"), _r("data.postedDate"))
    return postings(
        rows.filter((F.coalesce(slug, F.lit("")) != "") & (title != "")),
        title=title, location=F.when(flat != "", flat).otherwise(nested),
        url=F.concat(U.site_root(F.col("handle")), F.lit("/jobs/"), slug),
        posted_at=iso_or_epoch(stamp, millis="large"),
        description_md=html_to_markdown(_r("data.description")),
    )


@board("custom_page")
def custom_page(payloads: DataFrame) -> DataFrame:
    """Openings extracted from a careers page; off-domain links are refused."""
    schema = """jobs ARRAY<STRUCT<title: STRING, location: STRING, url: STRING,
        remote_policy: STRING>>"""
    sites = evaluate_once(
        payloads,
        __root=U.site_root(F.col("handle")), __domain=U.registrable_domain(F.col("handle")),
    )

    def trimmed(j: Column) -> Column:
        return F.struct(
            *[text(j[n]).alias(n) for n in ("title", "url", "location")],
            j["remote_policy"].alias("remote_policy"),
        )

    def resolved(j: Column) -> Column:
        return F.struct(
            j["title"].alias("title"), j["location"].alias("location"),
            j["remote_policy"].alias("remote_policy"),
            F.when(j["url"] != "", U.resolve(j["url"], F.col("__root"))).alias("url"),
        )

    def usable(j: Column) -> Column:
        return (j["title"] != "") & U.plausible_job_url(j["url"], F.col("__domain"))

    parsed = F.from_json("body", schema)["jobs"]
    pages = evaluate_once(
        sites, __jobs=F.filter(F.transform(F.transform(parsed, trimmed), resolved), usable)
    )
    pages = evaluate_once(pages, __urls=F.col("__jobs.url"))
    # First occurrence of a URL inside the page's own array.
    first = F.filter(
        F.col("__jobs"), lambda j, i: F.array_position(F.col("__urls"), j["url"]) == i + 1
    )
    rows = items(pages, first)
    return postings(
        rows,
        title=_r("title"), url=_r("url"), location=_r("location"),
        remote_policy=F.when(_r("remote_policy").isin(V.REMOTE_POLICIES), _r("remote_policy")),
    )
