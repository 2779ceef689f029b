"""Rule classifiers and visibility rules over the derived tables."""

from pyspark.sql import functions as F

from proofs.base import NOW, now, pick, proof, rx, stamp, stamp_sql, with_tables
from vacantia import fixed_values as V
from vacantia.functions import classify as C
from vacantia.operators import visibility
from vacantia.plans import read_model


def _hit(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, {rx(pattern)}, 'i'), false)"


def _rules(column: str, rules: list[tuple[str, str]], otherwise: str) -> str:
    arms = " ".join(f"WHEN {_hit(column, p)} THEN '{label}'" for label, p in rules)
    return f"CASE {arms} ELSE {otherwise} END"


_NON_EU = (
    f"CASE WHEN trim(coalesce(location, '')) = '' THEN false "
    f"WHEN {_hit('location', V.EU_OR_GLOBAL_PLACES)} THEN false "
    f"ELSE {_hit('location', V.NON_EU_PLACES)} OR {_hit('location', V.US_STATE_SUFFIX)} END"
)
_KEEP = (
    f"CASE WHEN {_hit('title', V.OFF_SCOPE_TITLE)} THEN false "
    f"WHEN remote_policy IN ('remote-global', 'remote-eu') THEN true ELSE NOT ({_NON_EU}) END"
)


@proof(
    with_tables(
        f"SELECT ingest_seq, {_NON_EU} AS non_eu, {_hit('title', V.OFF_SCOPE_TITLE)} AS off_scope, "
        f"{_KEEP} AS keep FROM jobs"
    )
)
def location_keep_split(t):
    title, location = F.col("title"), F.col("location")
    return t.jobs.select(
        "ingest_seq", C.non_eu_location(location).alias("non_eu"),
        C.off_scope_title(title).alias("off_scope"),
        C.keep_job(title, F.col("remote_policy"), location).alias("keep"),
    )


@proof(
    with_tables(
        f"SELECT source, CAST(count(*) FILTER ({_KEEP}) AS BIGINT) AS kept, "
        f"CAST(count(*) FILTER (NOT {_KEEP}) AS BIGINT) AS dropped FROM jobs GROUP BY source"
    )
)
def keep_counts(t):
    keep = C.keep_job(F.col("title"), F.col("remote_policy"), F.col("location"))
    return t.jobs.groupBy("source").agg(
        F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped")
    )


@proof(
    with_tables(
        f"""SELECT ingest_seq, {_rules('title', V.EMPLOYMENT_RULES, "'permanent'")} AS employment_type,
          coalesce(nullif(role_family, ''), {_rules('title', V.ROLE_RULES, 'NULL')}) AS role_family,
          coalesce(nullif(remote_policy, ''),
            {_rules("(title || ' ' || coalesce(location, ''))", V.REMOTE_RULES, 'NULL')}) AS remote_policy,
          length(description_md) > 50 AS has_description
        FROM jobs"""
    )
)
def title_classes(t):
    return read_model.lite(t.jobs.withColumn("id", F.col("ingest_seq"))).select(
        F.col("id").alias("ingest_seq"), "employment_type", "role_family", "remote_policy",
        "has_description",
    )


_CITY_ARMS = " ".join(
    f"WHEN list_contains(tok, {rx(city)}) THEN {rx(country)}"
    for country, names in V.CITIES_BY_COUNTRY.items()
    for city in names
)
_NAME_ARMS = " ".join(
    f"WHEN {'contains(loc, ' + rx(n.lower()) + ')' if ' ' in n else 'list_contains(tok, ' + rx(n.lower()) + ')'} "
    f"THEN {rx(n)}"
    for n in V.COUNTRY_NAMES.values()
)
_CODE_ARMS = " ".join(f"WHEN {rx(k)} THEN {rx(v)}" for k, v in V.COUNTRY_NAMES.items())
_HQ_ARMS = " ".join(f"WHEN {rx(k)} THEN {rx(V.COUNTRY_NAMES[k])}" for k in V.EU_HQ_COUNTRIES)
WHERE_CTE = f"""SELECT *, CASE
    WHEN remote_policy = 'remote-global' THEN '{V.WHERE_WORLDWIDE}'
    WHEN remote_policy = 'remote-eu' THEN '{V.WHERE_EUROPE}'
    WHEN regexp_matches(loc, {rx(V.WHERE_WORLDWIDE_TEXT)}) THEN '{V.WHERE_WORLDWIDE}'
    WHEN regexp_matches(loc, {rx(V.WHERE_EUROPE_TEXT)}) THEN '{V.WHERE_EUROPE}'
    ELSE coalesce(CASE {_CITY_ARMS} END, CASE {_NAME_ARMS} END,
      CASE upper(regexp_extract(loc, ',\\s*([a-z]{{2}})(?:$|[^a-z0-9_])', 1)) {_CODE_ARMS} END,
      CASE company_country {_HQ_ARMS} END,
      CASE WHEN remote_policy = 'remote' THEN '{V.WHERE_REMOTE}' END, '{V.WHERE_OTHER}') END AS where_value
  FROM (SELECT j.*, c.country AS company_country, lower(coalesce(j.location, '')) AS loc,
          regexp_split_to_array(lower(coalesce(j.location, '')), {rx(V.PLACE_TOKEN_SEPARATOR)}) AS tok
        FROM jobs j LEFT JOIN companies c ON c.slug = j.company_slug)"""


@proof(
    with_tables(
        "SELECT ingest_seq, company_country, where_value FROM w", w=WHERE_CTE
    )
)
def where_bucket(t):
    return read_model.with_where(t.jobs, t.companies).select(
        "ingest_seq", "company_country", F.col("where").alias("where_value")
    )


_REMOTE_HIT = _hit("location", V.REMOTE_GLOBAL_TEXT)
_REMOTE_EU_HIT = _hit("location", V.REMOTE_EU_TEXT)
_COUNTRY = f"regexp_extract(location, {rx('(?i)' + V.EU_COUNTRY_TEXT)}, 1)"
_EU_CODES = " ".join(f"WHEN {rx(k.lower())} THEN {rx(v)}" for k, v in V.EU_COUNTRY_CODES.items())


@proof(
    with_tables(
        f"""SELECT ingest_seq, keep, CASE WHEN keep THEN code END AS country, CASE WHEN keep THEN policy END AS policy, eu_signal
        FROM (SELECT ingest_seq,
          coalesce(location, '') <> '' AND ({_REMOTE_HIT} OR {_REMOTE_EU_HIT} OR {_COUNTRY} <> '') AS keep,
          CASE WHEN {_REMOTE_HIT} OR {_REMOTE_EU_HIT} THEN 'XX' ELSE CASE lower({_COUNTRY}) {_EU_CODES} END END AS code,
          CASE WHEN {_REMOTE_HIT} THEN 'remote-global' WHEN {_REMOTE_EU_HIT} THEN 'remote-eu' END AS policy,
          coalesce(location, '') = '' OR regexp_matches(lower(location), '{'|'.join(V.EU_SIGNAL_WORDS)}') AS eu_signal
        FROM jobs)"""
    )
)
def eu_gates(t):
    gate = C.eu_or_remote(F.col("location"))
    return t.jobs.select(
        "ingest_seq", gate["keep"].alias("keep"), gate["country"].alias("country"),
        gate["remote_policy"].alias("policy"), C.eu_signal(F.col("location")).alias("eu_signal"),
    )


_SECTOR = ["Fashion / Luxury / Beauty / Lifestyle", "Hospitality", "Tech", "Public"]
_CHILD = ["Jewellery", "Hotels", "SaaS / Cloud", "Media buying"]


@proof(
    with_tables(
        f"""SELECT ingest_seq, {_hit('title', V.TECH_TITLE)} OR regexp_matches(lower(parent || chr(10) || child),
          '{'|'.join(V.TECH_SECTOR_WORDS)}') AS tech, parent = 'Fashion / Luxury / Beauty / Lifestyle' AS lane
        FROM (SELECT *, {pick('o_custkey', _SECTOR)} AS parent, {pick('ingest_seq', _CHILD)} AS child FROM jobs)"""
    )
)
def sector_gates(t):
    rows = t.jobs.selectExpr(
        "*", f"{pick('o_custkey', _SECTOR)} AS parent", f"{pick('ingest_seq', _CHILD)} AS child"
    )
    sectors = F.array(F.create_map("parent", "child"))
    return rows.select(
        "ingest_seq", C.tech_relevant(F.col("title"), sectors).alias("tech"),
        C.lane_relevant(sectors).alias("lane"),
    )


def _lookup(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {rx(k)} THEN {rx(v)}" for k, v in table.items()) + " END"


@proof(
    with_tables(
        f"""SELECT ingest_seq, concat_ws(' ', {_lookup('role_family', V.SEARCH_SYNONYMS)},
          {_lookup('seniority', V.SENIORITY_SYNONYMS)}) AS synonyms,
          CASE WHEN source IN ('greenhouse','lever','ashby','workable','recruitee','personio','smartrecruiters')
               THEN 'ats' ELSE 'aggregator' END AS source_class,
          CASE remote_policy WHEN 'remote' THEN NULL ELSE CASE seniority WHEN 'mid' THEN 'hybrid' WHEN 'senior' THEN 'remote' END END AS flag
        FROM jobs"""
    )
)
def search_synonyms(t):
    flag = F.when(F.col("remote_policy") == "remote", F.lit(None)).otherwise(
        F.when(F.col("seniority") == "mid", "partial").when(F.col("seniority") == "senior", "fulltime")
    )
    return t.jobs.select(
        "ingest_seq", C.search_synonyms(F.col("role_family"), F.col("seniority")).alias("synonyms"),
        C.source_class(F.col("source")).alias("source_class"), C.remote_of_flag(flag).alias("flag"),
    )


_PUBLIC = (
    "NOT starts_with(slug, 'via-') AND coalesce(name, '') <> '' AND name <> slug AND tags = ''"
)
_LANE = "NOT starts_with(slug, 'via-') AND coalesce(name, '') <> '' AND tags <> ''"


@proof(
    with_tables(
        f"SELECT j.ingest_seq, c.name AS company_name, c.country AS company_country FROM jobs j "
        f"JOIN companies c ON c.slug = j.company_slug WHERE {_PUBLIC}"
    )
)
def public_jobs(t):
    return visibility.public_jobs(t.jobs, t.companies).select(
        "ingest_seq", "company_name", "company_country"
    )


@proof(with_tables(f"SELECT slug, {_LANE} AS is_lane FROM companies WHERE ({_PUBLIC}) OR ({_LANE})"))
def page_companies(t):
    public = visibility.public_companies(t.companies).select("slug", F.lit(False).alias("is_lane"))
    lane = visibility.lane_companies(t.companies).select("slug", F.lit(True).alias("is_lane"))
    return public.unionByName(lane)


@proof(
    with_tables(
        f"SELECT j.ingest_seq, {_LANE} AS is_lane FROM jobs j JOIN companies c ON c.slug = j.company_slug "
        f"WHERE ({_PUBLIC}) OR ({_LANE})"
    )
)
def page_jobs(t):
    return visibility.all_page_jobs(t.jobs, t.companies).select("ingest_seq", "is_lane")


_ROLE_HIT = " OR ".join(_hit("title", p) for p in V.LANE_ROLE_PATTERNS)


@proof(
    with_tables(
        f"""SELECT j.ingest_seq, j.company_slug, {stamp_sql('j.posted_at')} AS posted FROM jobs j
        JOIN companies c ON c.slug = j.company_slug WHERE {_LANE}
          AND NOT regexp_matches(regexp_replace(slug, '^(wttj|wttjc|fjr)-', ''), '^chanel(-|$)')
          AND (coalesce(remote_policy IN ('remote-eu', 'remote-global'), false)
               OR regexp_matches(lower(coalesce(location, '')), 'france|paris|, fr') OR country = 'FR')
          AND ({_ROLE_HIT}) AND NOT {_hit('title', V.LANE_EXCLUDED_TITLE)}"""
    )
)
def lane_query(t):
    return visibility.curated_lane(t.jobs, t.companies).select(
        "ingest_seq", "company_slug", stamp(F.col("posted_at")).alias("posted")
    )


@proof(
    with_tables(
        f"""SELECT (SELECT count(*) FROM jobs j JOIN companies c ON c.slug = j.company_slug WHERE {_PUBLIC}) AS job_count,
          (SELECT count(*) FROM jobs j JOIN companies c ON c.slug = j.company_slug WHERE {_PUBLIC}
             AND posted_at <= {NOW} AND posted_at >= {NOW} - INTERVAL 1 DAY) AS new_today,
          (SELECT count(*) FROM companies WHERE {_PUBLIC}) AS company_count"""
    )
)
def header_strip(t):
    return visibility.header_counts(t.jobs, t.companies, now())


@proof(with_tables(f"SELECT count(*) AS lane_companies FROM companies WHERE {_LANE}"))
def lane_coverage(t):
    return visibility.lane_coverage(t.companies)
