"""Landed payloads to jobs and companies: one contract, one registry.

A reader takes the payloads of its own source and yields *postings*: the jobs
columns it knows plus ``ingest_seq`` material (``page``, ``item``). Readers are
projections over ``from_json`` / ``xpath`` / regex extraction, so a scan of the
payload table stays one narrow stage: filter by source, parse, explode, project.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vacantia import schemas
from vacantia.functions.ids import stable_id
from vacantia.functions.text import or_else, strip
from vacantia.operators.merge import first_per_key

Reader = Callable[[DataFrame], DataFrame]

BOARD_READERS: dict[str, Reader] = {}
AGGREGATOR_READERS: dict[str, Reader] = {}

# Sources whose listings repeat a posting, and what identifies it there.
REPEATING_SOURCES = {
    "workday": ["company_slug", "url"], "phenom": ["company_slug", "url"],
    "wttj": ["id"], "fashionjobs": ["id"], "bof": ["url"],
}

# What the bodies of a source are; the others are pages, which always parse.
JSON_SOURCES = [
    "greenhouse", "lever", "ashby", "smartrecruiters", "recruitee", "workday", "phenom",
    "remoteok", "justjoinit", "wttj",
]
XML_SOURCES = ["personio", "weworkremotely"]
UNREADABLE = "Payload does not parse"

# Company columns an aggregator posting carries along, prefixed in its rows.
COMPANY_FIELDS = [
    "name", "country", "categories", "industry_tags", "career_url", "notes",
]


def board(source: str) -> Callable[[Reader], Reader]:
    """Register a reader whose payloads belong to one known company each."""
    def add(fn: Reader) -> Reader:
        BOARD_READERS[source] = fn
        return fn

    return add


def aggregator(source: str) -> Callable[[Reader], Reader]:
    """Register a reader whose payloads name the companies themselves."""
    def add(fn: Reader) -> Reader:
        AGGREGATOR_READERS[source] = fn
        return fn

    return add


def titled(title: Column) -> Column:
    return or_else(strip(title), F.lit("(untitled)"))


def text(col: Column) -> Column:
    return strip(F.coalesce(col, F.lit("")))


def items(payloads: DataFrame, array: Column, *carry: str) -> DataFrame:
    """One row per array element (``raw``), with its position; null arrays vanish."""
    keep = ["source", "company_slug", "handle", "page", "fetched_at", *carry]
    return payloads.select(*keep, F.posexplode(array).alias("item", "raw"))


def postings(rows: DataFrame, company: dict[str, Column] | None = None, **fields: Column) -> DataFrame:
    """Finish a reader: drop rows without a URL, compute the id, fix the columns."""
    url = fields["url"]
    slug = fields.get("company_slug", F.col("company_slug"))
    shown = rows.filter(F.coalesce(url, F.lit("")) != "")
    values = {
        "location": F.lit(""), "remote_policy": F.lit(None), "posted_at": F.lit(None),
        "description_md": F.lit(""), **fields, "company_slug": slug,
    }
    out = shown.select(
        stable_id(slug, url).alias("id"),
        *[
            values[f.name].cast(f.dataType).alias(f.name)
            for f in schemas.JOBS
            if f.name in values and f.name not in ("id", "source", "scraped_at")
        ],
        F.date_trunc("second", F.col("fetched_at")).alias("scraped_at"),
        F.col("source"), F.col("page"), F.col("item"),
        *[c.alias(f"company_{n}") for n, c in (company or {}).items()],
    )
    return out


def read_source(payloads: DataFrame, source: str) -> DataFrame:
    """Postings of one source, each once where its listings repeat them."""
    reader = BOARD_READERS.get(source) or AGGREGATOR_READERS[source]
    found = reader(payloads.filter(F.col("source") == source))
    keys = REPEATING_SOURCES.get(source)
    order = [F.col("page"), F.col("item"), F.col("id")]
    return first_per_key(found, keys, order) if keys else found


def read_all(payloads: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Postings of the given sources (by default all), company columns alongside.

    One narrow branch per source: land payloads partitioned by ``source`` and every
    branch scans only its own.
    """
    names = sources or [*BOARD_READERS, *AGGREGATOR_READERS]
    out = read_source(payloads, names[0])
    for name in names[1:]:
        out = out.unionByName(read_source(payloads, name), allowMissingColumns=True)
    missing = {
        f"company_{f.name}": F.lit(None).cast(f.dataType)
        for f in schemas.COMPANIES
        if f.name in COMPANY_FIELDS and f"company_{f.name}" not in out.columns
    }
    return out.withColumns(missing)


def attempts(payloads: DataFrame, landing: DataFrame | None = None) -> DataFrame:
    """``source, company_slug, error, duration_ms`` of every landed source and company.

    A body that does not parse is an error, whatever else was read from its source.
    ``landing`` holds the fetches with their own ``error`` and ``duration_ms``, also those
    that brought no payload; its errors come first.
    """
    xml = F.from_xml("body", "broken STRING", {"columnNameOfCorruptRecord": "broken"})["broken"]
    source = F.col("source")
    broken = F.col("body").isNotNull() & (
        (source.isin(JSON_SOURCES) & F.try_parse_json("body").isNull())
        | (source.isin(XML_SOURCES) & xml.isNotNull())
    )
    keys = ["source", "company_slug"]
    read = payloads.groupBy(*keys).agg(F.max(F.when(broken, F.lit(UNREADABLE))).alias("unreadable"))
    if landing is None:
        return read.select(*keys, F.col("unreadable").alias("error"), F.lit(0).alias("duration_ms"))
    fetched = landing.groupBy(*keys).agg(
        F.max("error").alias("failed"), F.sum("duration_ms").cast("int").alias("duration_ms")
    )
    return read.join(fetched, keys, "full_outer").select(
        *keys, F.coalesce("failed", "unreadable").alias("error"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"),
    )


def companies_of(found: DataFrame) -> DataFrame:
    """Company rows behind aggregator postings, one per posting (merge dedupes them)."""
    return found.select(
        F.col("company_slug").alias("slug"),
        *[F.col(f"company_{n}").alias(n) for n in COMPANY_FIELDS],
        "source", "page", "item",
    )
