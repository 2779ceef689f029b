"""Seed, routes, run logs, whole batch jobs, snapshots and streams."""

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from proofs.base import COUNTRIES, LOCATIONS, TITLES, pick, proof, rx, stamp, with_tables
from proofs.rules import _KEEP
from vacantia import schemas
from vacantia.operators import changes
from vacantia.plans import daily
from vacantia.session import shared_dir
from vacantia.sinks import writers
from vacantia.functions import validation
from vacantia.sources import payloads as P, quarantine, routes, seed, snapshots
from vacantia.streaming import incremental


def _scratch(t, name: str) -> str:
    """A fresh folder below the shared one, for queries that write."""
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- seed ---------------------------------------------------------------------

_SLUG = "'c' || CAST(c_custkey - (CASE WHEN c_custkey % 100 = 1 THEN 1 ELSE 0 END) AS STRING)"
_YAML = f"""SELECT 'file:/seed/' || lower(c_mktsegment) || '/' || {_SLUG} || '.yaml' AS path,
  CASE c_custkey % 9
    WHEN 1 THEN 'name: [unclosed'
    WHEN 2 THEN '- just\n- a list\n'
    WHEN 3 THEN 'slug: x\nname: A\ncountry: FR\n'
    WHEN 4 THEN 'name: A\ncountry: FRA\ncareer_url: https://c.test\n'
    WHEN 5 THEN 'name: A\ncountry: FR\n'
    WHEN 6 THEN 'name: A\ncountry: FR\nmood: good\n'
    ELSE 'name: ' || c_name || '\ncountry: DE\ncategories: [tech, ai]\nats:\n  provider: lever\n  handle: h' ||
      CAST(c_custkey AS STRING) || '\ntop_repo_stars: 12\n' END AS body"""


@proof(
    f"""WITH s AS (SELECT *, {_SLUG} AS slug FROM customer),
    d AS (SELECT *, count(*) OVER (PARTITION BY slug) AS n FROM s)
    SELECT 'file:/seed/' || lower(c_mktsegment) || '/' || slug || '.yaml' AS path, slug,
      CASE WHEN c_custkey % 9 IN (1, 2, 3, 6) THEN NULL WHEN c_custkey % 9 IN (4, 5) THEN 'A' ELSE c_name END AS name,
      CASE WHEN c_custkey % 9 IN (0, 7, 8) THEN 'h' || c_custkey END AS ats_handle,
      CASE WHEN c_custkey % 9 IN (0, 7, 8) THEN 12 END AS top_repo_stars,
      concat_ws(',', CASE c_custkey % 9 WHEN 1 THEN 'invalid_yaml' WHEN 2 THEN 'not_a_mapping' WHEN 3 THEN 'declares_slug'
        WHEN 4 THEN 'country' WHEN 5 THEN 'source' WHEN 6 THEN 'unknown_field' END,
        CASE WHEN n > 1 THEN 'duplicate_slug' END) AS problems FROM d"""
)
def seed_decode(t):
    docs = t.sql(_YAML + " FROM {customer}", customer=t.customer)
    return seed.decode_seed(docs).select(
        "path", "slug", "name", "ats_handle", "top_repo_stars",
        F.array_join("problems", ",").alias("problems"),
    )


_STORED = f"""SELECT {pick('c_custkey', ['k', 'Bad ', 's'])} || CAST(c_custkey AS STRING) AS slug,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS name,
  {pick('c_custkey', ['FR', None, '', 'DE'])} AS country,
  {pick('c_custkey', ['lever', None, 'ashby', 'fax'])} AS ats_provider,
  {pick('c_custkey', ['h', 'h', None, 'h', None])} AS ats_handle,
  {pick('c_custkey', ['https://c.test', None])} AS career_url"""


@proof(
    f"""WITH cur AS (SELECT 'k' || (s_suppkey * 6) AS slug, s_name AS name, 'GB' AS country FROM supplier),
    st AS (SELECT slug, coalesce(name, slug) AS name, coalesce(nullif(country, ''), 'XX') AS country,
      CASE WHEN ats_handle IS NOT NULL THEN ats_provider END AS p, career_url FROM ({_STORED} FROM customer))
    SELECT slug, name, country FROM cur
    UNION ALL SELECT slug, name, country FROM st WHERE slug NOT IN (SELECT slug FROM cur)
      AND regexp_matches(slug, '^[a-z0-9][a-z0-9-]*$') AND coalesce(p, '') <> 'fax' AND (p IS NOT NULL OR career_url IS NOT NULL)"""
)
def tagger_companies(t):
    curated = schemas.conform(
        t.supplier.select(
            F.concat(F.lit("k"), F.col("s_suppkey") * 6).alias("slug"),
            F.col("s_name").alias("name"), F.lit("GB").alias("country"),
        ),
        schemas.COMPANIES,
    )
    stored = t.sql(_STORED + " FROM {customer}", customer=t.customer)
    return seed.tagger_companies(curated, stored).select("slug", "name", "country")


_ROUTE = f"""SELECT 'c' || CAST(c_custkey AS STRING) AS slug,
  {pick('c_custkey', ['lever', 'workable', None, 'phenom', None])} AS ats_provider,
  {pick('c_custkey', ['h', 'w', None, 'https://p.test/api/jobs?_phenom_countries=France,Spain', None])} AS ats_handle,
  {pick('c_custkey', [None, None, 'https://c.test', None, None])} AS career_url"""


@proof(
    """SELECT 'c' || c_custkey AS slug, CASE c_custkey % 5 WHEN 0 THEN 'lever' WHEN 1 THEN 'workable' WHEN 2 THEN 'custom_page'
        WHEN 3 THEN 'phenom' ELSE 'none' END AS route,
      CASE c_custkey % 5 WHEN 1 THEN 'Unsupported provider: workable' WHEN 4 THEN 'No ATS handle or career_url' END AS error,
      CASE c_custkey % 5 WHEN 0 THEN 'h' WHEN 2 THEN 'https://c.test'
        WHEN 3 THEN 'https://p.test/api/jobs?country=France https://p.test/api/jobs?country=Spain' END AS urls
    FROM customer"""
)
def company_routes(t):
    resolved = routes.resolve_routes(t.sql(_ROUTE + " FROM {customer}", customer=t.customer))
    landed = routes.requests(resolved).groupBy("slug").agg(
        F.array_join(F.sort_array(F.collect_list("url")), " ").alias("urls")
    )
    return resolved.join(landed, "slug", "left").select("slug", "route", "error", "urls")


@proof(
    """SELECT CASE WHEN event_id % 2 = 0 THEN '2001-07-01' ELSE '2001-07-02' END AS snapshot_date, event_type AS extractor,
      'u' || user_id AS company_slug, event_type <> 'error' AS success, CAST(floor(value) AS INT) AS job_count, event_id
    FROM events"""
)
def run_metadata(t):
    """Two runs write their metadata documents; the scan of the JSON files gives every result."""
    root = _scratch(t, "metadata")
    results = t.events.select(
        F.col("event_type").alias("extractor"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("company_slug"),
        (F.col("event_type") != "error").alias("success"),
        F.floor("value").cast("int").alias("job_count"),
        F.col("event_id").cast("int").alias("duration_ms"), F.lit(None).cast("string").alias("error"),
        (F.col("event_id") % 2).alias("day"),
    )
    header = daily.run_header(t.jobs, t.companies, F.lit("2001-07-01").cast("timestamp"), "1")
    for k, day in enumerate(("2001-07-01", "2001-07-02")):
        rows = results.filter(F.col("day") == k).drop("day")
        writers.write_run_metadata(header, rows, root, day, per_document=200)
    return snapshots.read_published_run_log(t.spark, root).select(
        F.col("snapshot_date").cast("string").alias("snapshot_date"), "extractor", "company_slug",
        "success", "job_count", F.col("duration_ms").cast("bigint").alias("event_id"),
    )


# --- the daily job ------------------------------------------------------------

_POST = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
  CASE WHEN {pick('o_orderkey', TITLES)} = '' THEN 'Untitled' ELSE {pick('o_orderkey', TITLES)} END AS title,
  coalesce({pick('o_orderkey * 7 + o_custkey', LOCATIONS)}, '') AS location,
  'https://g.test/' || CAST(o_orderkey - o_orderkey % 3 AS STRING) AS url"""


def _payload_table(t):
    """Status F lands as greenhouse boards, O as remoteok and P as justjoinit feeds."""
    rows = t.sql(_POST + " FROM {orders}", orders=t.orders)
    green = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.col("title"), F.col("url").alias("absolute_url"),
                    F.struct(F.col("location").alias("name")).alias("location"),
                )
            ).alias("jobs")
        )
    )
    remote = F.to_json(
        F.array(
            F.struct(
                F.concat(F.lit("Firm "), F.col("o_custkey").cast("string")).alias("company"),
                F.col("url"), F.col("title").alias("position"), F.lit("Europe").alias("location"),
            )
        )
    )
    offers = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.concat(F.lit("Firm "), F.col("o_custkey").cast("string")).alias("companyName"),
                    F.col("o_orderkey").cast("string").alias("slug"), F.col("title"),
                    F.lit("Wien").alias("city"),
                )
            ).alias("data")
        )
    )
    status = F.col("o_orderstatus")
    return rows.select(
        F.when(status == "F", "greenhouse").when(status == "O", "remoteok").otherwise("justjoinit").alias("source"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("company_slug"),
        F.lit("h").alias("handle"), F.lit(0).alias("page"),
        F.lit("2002-01-01").cast("timestamp").alias("fetched_at"),
        F.when(status == "F", green).when(status == "O", remote).otherwise(offers).alias("body"),
    )


_FOUND = f"""SELECT CASE o_orderstatus WHEN 'F' THEN 'c' || o_custkey WHEN 'O' THEN 'via-remoteok-firm-' || o_custkey
    ELSE 'via-justjoinit-firm-' || o_custkey END AS company_slug, title,
  CASE o_orderstatus WHEN 'P' THEN 'https://justjoin.it/offers/' || o_orderkey ELSE url END AS url,
  CASE o_orderstatus WHEN 'F' THEN trim(location) WHEN 'O' THEN 'Europe' ELSE 'Wien, PL' END AS location,
  CASE o_orderstatus WHEN 'O' THEN 'remote-global' WHEN 'P' THEN 'onsite' END AS remote_policy,
  CASE o_orderstatus WHEN 'F' THEN 'greenhouse' WHEN 'O' THEN 'remoteok' ELSE 'justjoinit' END AS source,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 3 END AS rk FROM ({_POST} FROM orders)"""
_UNIQUE = "SELECT * FROM (SELECT *, min(rk) OVER (PARTITION BY url) AS best FROM found) WHERE rk = best"


def _collected(t):
    """Postings staged as a written table, as the daily job does."""
    path = _scratch(t, "postings")
    daily.collect(_payload_table(t), ["greenhouse", "remoteok", "justjoinit"]).write.parquet(path)
    return t.spark.read.parquet(path)


def _curated(t):
    return schemas.conform(
        t.customer.select(
            F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("slug"),
            F.col("c_name").alias("name"), F.lit("FR").alias("country"),
            F.lit("greenhouse").alias("ats_provider"), F.lit("h").alias("ats_handle"),
        ),
        schemas.COMPANIES,
    )


@proof(
    f"""WITH found AS ({_FOUND}), uniq AS ({_UNIQUE})
    SELECT substr(sha256(company_slug || ':' || url), 1, 16) AS id, title, location, source,
      CASE WHEN source = 'greenhouse' THEN 'data' END AS role_family
    FROM uniq WHERE {_KEEP}"""
)
def daily_snapshot(t):
    """Payloads to kept jobs, tags carried from a prior snapshot of the board jobs."""
    found = _collected(t)
    prior = found.filter("source = 'greenhouse'").select("id").distinct().withColumns(
        {"role_family": F.lit("data"), "seniority": F.lit(None).cast("string")}
    )
    run = daily.build_snapshot(_curated(t), found, prior)
    return run.jobs.select("id", "title", "location", "source", "role_family")


@proof(
    f"""WITH found AS ({_FOUND}), uniq AS ({_UNIQUE})
    SELECT 'c' || c_custkey AS slug, c_name AS name, 'FR' AS country FROM customer
    UNION ALL SELECT DISTINCT company_slug, 'Firm ' || regexp_extract(company_slug, '(\\d+)$', 1),
      CASE WHEN source = 'remoteok' THEN 'XX' ELSE 'PL' END FROM found WHERE source <> 'greenhouse'"""
)
def daily_companies(t):
    run = daily.build_snapshot(_curated(t), _collected(t))
    return run.companies.select("slug", "name", "country")


@proof(
    f"""WITH found AS ({_FOUND}), uniq AS ({_UNIQUE}),
    board AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 2 THEN 'HTTP 503' WHEN c_custkey % 11 = 3 THEN 'Payload does not parse' END AS error,
      CASE WHEN c_custkey % 7 = 2 THEN 30 ELSE 0 END AS ms FROM customer)
    SELECT 'greenhouse' AS extractor, 'c' || k AS company_slug, error IS NULL AS success, CAST(count(u.url) AS INT) AS job_count, ms AS duration_ms, error
    FROM board LEFT JOIN uniq u ON u.company_slug = 'c' || k AND source = 'greenhouse' GROUP BY k, error, ms
    UNION ALL SELECT s, '(aggregator)', s <> 'bof' AND s <> 'weworkremotely', CAST((SELECT count(*) FROM uniq WHERE source = s) AS INT),
      CASE WHEN s = 'bof' THEN 12 ELSE 0 END, CASE s WHEN 'bof' THEN 'timeout' WHEN 'weworkremotely' THEN 'Payload does not parse' END
    FROM unnest(['remoteok','weworkremotely','justjoinit','wttj','eures','fashionjobs','bof']) AS x(s)"""
)
def daily_run_log(t):
    """Boards and a feed with broken bodies, and fetches that failed."""
    payloads = _payload_table(t)
    board = t.customer.select(
        F.lit("greenhouse").alias("source"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("company_slug"),
        F.lit("h").alias("handle"), F.lit(1).alias("page"), F.lit("2002-01-01").cast("timestamp").alias("fetched_at"),
        F.lit("{oops").alias("body"), "c_custkey",
    )
    broken = board.filter("c_custkey % 11 = 3").drop("c_custkey")
    feed = t.region.select(
        F.lit("weworkremotely").alias("source"), F.lit("f").alias("company_slug"), F.lit("h").alias("handle"),
        F.lit(0).alias("page"), F.lit("2002-01-01").cast("timestamp").alias("fetched_at"),
        F.lit("<rss><channel><item>").alias("body"),
    )
    landing = board.filter("c_custkey % 7 = 2").select(
        "source", "company_slug", F.lit("HTTP 503").alias("error"), F.lit(30).alias("duration_ms")
    ).unionAll(t.region.filter("r_regionkey = 0").select(F.lit("bof"), F.lit("x"), F.lit("timeout"), F.lit(12)))
    attempts = P.attempts(payloads.unionByName(broken).unionByName(feed), landing)
    run = daily.build_snapshot(_curated(t), _collected(t), attempts=attempts)
    return run.run_log.select("extractor", "company_slug", "success", "job_count", "duration_ms", "error")


@proof(
    f"""SELECT 'jobs' AS kind, substr(sha256(company_slug || ':' || url), 1, 16) AS key FROM ({_FOUND}) WHERE source = 'greenhouse' AND {_KEEP}
    UNION ALL SELECT 'companies', 'c' || c_custkey FROM customer
    UNION ALL SELECT 'log', 'c' || c_custkey FROM customer"""
)
def daily_boards_only(t):
    """A run over boards alone: no aggregator columns, companies or log rows."""
    path = _scratch(t, "boards")
    daily.collect(_payload_table(t), ["greenhouse"]).write.parquet(path)
    run = daily.build_snapshot(_curated(t), t.spark.read.parquet(path), sources=["greenhouse"])
    parts = (("jobs", run.jobs, "id"), ("companies", run.companies, "slug"), ("log", run.run_log, "company_slug"))
    out = None
    for kind, df, key in parts:
        rows = df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"))
        out = rows if out is None else out.unionAll(rows)
    return out


@proof(
    f"""WITH found AS ({_FOUND}), uniq AS ({_UNIQUE})
    SELECT (SELECT CAST(count(*) AS INT) FROM uniq WHERE {_KEEP}) AS job_count,
      (SELECT CAST(count(*) AS INT) FROM customer) + (SELECT CAST(count(DISTINCT company_slug) AS INT) FROM found WHERE source <> 'greenhouse')
        AS company_count, '2' AS pipeline_version"""
)
def daily_header(t):
    run = daily.build_snapshot(_curated(t), _collected(t), version="2")
    return run.header.select("job_count", "company_count", "pipeline_version")


@proof(
    with_tables(
        """SELECT ingest_seq, 'Revised ' || title AS title, 'Ops' AS source FROM jobs WHERE o_orderstatus <> 'F'"""
    )
)
def snapshot_latest(t):
    """Two dated writes, one of them repeated, and one that dies between its tables.

    The newest published date is read back: of the last day, whose jobs were written and whose
    companies were not, nothing is seen.
    """
    root = _scratch(t, "snapshots")
    jobs = t.jobs.withColumn("id", F.col("ingest_seq").cast("string"))
    firms = t.companies
    revised = jobs.filter("o_orderstatus <> 'F'").withColumns(
        {"title": F.concat(F.lit("Revised "), "title"), "source": F.lit("Ops")}
    )
    writers.write_snapshot(jobs, firms, root, "2024-01-01")
    writers.write_snapshot(jobs, firms, root, "2024-01-02")
    writers.write_snapshot(revised, firms, root, "2024-01-02")
    broken = firms.withColumn("country", F.raise_error(F.concat(F.lit("lost executor "), "slug")).cast("string"))
    try:
        writers.write_snapshot(jobs, broken, root, "2024-01-03")
    except PySparkException:
        pass
    if snapshots.dates(t.spark, root)[-1] != "2024-01-02":
        raise AssertionError("a broken write became visible")
    stored = snapshots.latest(snapshots.read_jobs(t.spark, root))
    return stored.select(F.col("id").cast("bigint").alias("ingest_seq"), "title", "source")


_LANDED = """SELECT CAST(CASE c_custkey % 9 WHEN 8 THEN 7 ELSE c_custkey % 2 + 1 END AS STRING) AS schema_version,
  CASE WHEN c_custkey % 13 = 5 THEN 'Bad Slug' ELSE 'c' || CAST(c_custkey AS STRING) END AS slug, c_name AS label, c_name AS name,
  CASE WHEN c_custkey % 7 = 3 THEN 'FRA' ELSE 'FR' END AS country, 'ai, tech' AS categories, 'https://c.test' AS career_url,
  CASE c_custkey % 5 WHEN 1 THEN 'many' WHEN 2 THEN '' ELSE CAST(c_custkey AS STRING) END AS stars"""
_VERSIONS = [
    quarantine.Version(1, {"slug": "slug", "name": "label", "country": "country", "career_url": "career_url"}),
    quarantine.Version(2, {"slug": "slug", "name": "name", "country": "country", "career_url": "career_url",
                           "categories": "categories", "top_repo_stars": "stars"}),
]


@proof(
    f"""WITH l AS ({_LANDED.replace("STRING", "VARCHAR")}, c_custkey FROM customer),
    r AS (SELECT *, concat_ws(',', CASE WHEN schema_version = '7' THEN 'unknown_version' END,
      CASE WHEN schema_version = '2' AND stars = 'many' THEN 'type:top_repo_stars' END,
      CASE WHEN schema_version <> '7' AND slug = 'Bad Slug' THEN 'slug' END,
      CASE WHEN schema_version <> '7' AND country = 'FRA' THEN 'country' END) AS reasons FROM l)
    SELECT 'read' AS result, slug, CASE WHEN schema_version = '2' THEN TRY_CAST(nullif(stars, '') AS BIGINT) END AS stars, reasons FROM r WHERE reasons = ''
    UNION ALL SELECT 'quarantine', slug, NULL, reasons FROM r WHERE reasons <> ''
    UNION ALL SELECT 'replayed', slug, NULL, '' FROM r WHERE reasons = 'country'"""
)
def typed_reads(t):
    """Two schema versions; the quarantine is written, and replayed once three letters are allowed."""
    landed = t.sql(_LANDED + " FROM {customer}", customer=t.customer)
    good, bad = quarantine.read(landed, schemas.COMPANIES, _VERSIONS, validation.company_violations())
    path = _scratch(t, "quarantine")
    bad.write.parquet(path)
    stored = t.spark.read.parquet(path)
    lenient = F.filter(validation.company_violations(), lambda r: r != "country")
    again, _ = quarantine.replay(stored, schemas.COMPANIES, _VERSIONS, lenient)
    null = F.lit(None).cast("long").alias("stars")
    rows = good.select(F.lit("read").alias("result"), "slug", F.col("top_repo_stars").alias("stars"), F.lit("").alias("reasons"))
    rows = rows.unionAll(stored.select(F.lit("quarantine"), "slug", null, F.array_join("reasons", ",")))
    return rows.unionAll(again.select(F.lit("replayed"), "slug", null, F.lit("")))


@proof(
    """SELECT 'F' AS status, TRUE AS refused, CAST(0 AS BIGINT) AS events UNION ALL
    SELECT 'O', FALSE, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'O')"""
)
def refused_diff(t):
    """A diff against a run that found nothing is refused; against one that found less it is written."""
    root = _scratch(t, "refused")
    jobs = t.jobs.withColumn("id", F.col("ingest_seq").cast("string"))
    for day, rows in (("2024-01-01", jobs), ("2024-01-02", jobs.filter("FALSE")), ("2024-01-03", jobs.filter("o_orderstatus = 'O'"))):
        writers.write_snapshot(rows, t.companies, root, day)
    out = []
    for status, day in (("F", "2024-01-02"), ("O", "2024-01-03")):
        try:
            out.append((status, False, daily.diff(t.spark, root, day, "2024-01-01").count()))
        except changes.EmptySnapshotError:
            out.append((status, True, 0))
    return t.spark.createDataFrame(out, "status string, refused boolean, events long")


# --- streams ------------------------------------------------------------------


def _stream(t, name: str):
    schema = getattr(t, name).schema
    rows = t.spark.readStream.schema(schema).parquet(f"{t.folder}/{name}*.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@proof(
    "SELECT event_type || '-' || user_id AS key, arg_min(event_id, (ts, event_id)) AS event_id "
    "FROM events GROUP BY 1"
)
def stream_ingest(t):
    """First arrival per key over the whole feed, in twenty micro-batches that keep state."""
    root = _scratch(t, "ingest")
    keyed = _epochs(t, root, 20).withColumn(
        "key", F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    )
    incremental.start_first_arrivals(
        keyed, f"{root}/table", f"{root}/checkpoint", key="key", order=[F.col("ts"), F.col("event_id")]
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/table").select("key", "event_id")


def _epochs(t, root: str, n: int):
    """The events as a feed of ``n`` files, written in order of time, one for each micro-batch."""
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds("ts")
    bounds = rows.select(F.percentile_approx(seconds, [i / n for i in range(1, n)])).first()[0] or []
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = rows.filter(seconds >= low) if low is not None else rows
        part = part.filter(seconds < high) if high is not None else part
        part.coalesce(1).write.mode("append").parquet(f"{root}/feed")
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")


@proof(
    "SELECT event_type || '-' || user_id AS key, arg_min(event_id, (ts, event_id)) AS event_id "
    "FROM events GROUP BY 1"
)
def stream_ingest_buckets(t):
    """The same without state: stored keys lie in hash buckets."""
    root = _scratch(t, "ingest-buckets")
    keyed = _stream(t, "events").withColumn(
        "key", F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    )
    apply = incremental.first_seen_batches(
        t.spark, f"{root}/table", key="key", order=[F.col("ts"), F.col("event_id")]
    )
    incremental.upsert_batches(keyed, apply, f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/table").select("key", "event_id")


@proof(
    """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n FROM (
      SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS w, event_type, count(*) AS n FROM events GROUP BY 1, 2)
    WHERE w + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""
)
def stream_window(t):
    """Seven-day windows; only those the watermark has closed are final."""
    root = _scratch(t, "window")
    counts = incremental.windowed_counts(
        _stream(t, "events"), keys=["event_type"], ts="ts", size="7 days", delay="1 day"
    )
    incremental.drain(counts, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table").select(
        stamp(F.col("window_start")).alias("window_start"), "event_type", "n"
    )


@proof(
    """SELECT c_custkey AS id, coalesce(tag, 'none') AS tag FROM customer LEFT JOIN (
      SELECT user_id, arg_max(event_type, event_id) AS tag FROM events GROUP BY 1) ON user_id = c_custkey"""
)
def stream_upsert(t):
    """Last event per user overlaid on the customer table, from a log that merges itself."""
    root = _scratch(t, "upsert")
    base = t.customer.select(F.col("c_custkey").alias("id"), F.lit("none").alias("tag"))
    updates = _epochs(t, root, 12).select(
        F.col("user_id").alias("id"), F.col("event_type").alias("tag"), "event_id"
    )
    log = incremental.UpdateLog(t.spark, f"{root}/log", key="id", sequence="event_id", ratio=3)
    incremental.upsert_batches(updates, log.apply, f"{root}/checkpoint").awaitTermination()
    return log.over(base, ["tag"])


@proof("SELECT DISTINCT event_type || '-' || user_id AS key FROM events")
def stream_first_seen(t):
    """The watermarked form: one row per key while the delay covers the feed."""
    root = _scratch(t, "first-seen")
    keyed = _stream(t, "events").withColumn(
        "key", F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    )
    seen = incremental.first_seen(keyed, key="key", ts="ts", delay="1000 days").select("key")
    incremental.drain(seen, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table")


# --- composed jobs on repeated ids ---------------------------------------------


@proof(
    with_tables(
        """SELECT CASE o_orderstatus WHEN 'F' THEN 'removed' ELSE 'changed' END AS event, CAST(ingest_seq AS VARCHAR) AS id,
          CASE o_orderstatus WHEN 'P' THEN 'title' END AS field, CASE o_orderstatus WHEN 'P' THEN title END AS old,
          CASE o_orderstatus WHEN 'P' THEN 'Revised ' || title END AS new FROM jobs WHERE o_orderstatus <> 'O'"""
    )
)
def daily_diff(t):
    """Two written snapshots that hold every id twice; one event per id and field."""
    root = _scratch(t, "diff")
    jobs = t.jobs.withColumn("id", F.col("ingest_seq").cast("string"))
    title = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Revised "), "title")).otherwise(F.col("title"))
    today = jobs.filter("o_orderstatus <> 'F'").withColumn("title", title)
    writers.write_snapshot(jobs.unionAll(jobs), t.companies, root, "2024-01-01")
    writers.write_snapshot(today.unionAll(today), t.companies, root, "2024-01-02")
    events = daily.diff(t.spark, root, "2024-01-02", "2024-01-01")
    return events.select("event", "id", "field", "old", "new")


@proof(with_tables("SELECT 'new' AS event, id, count(*) AS n FROM (SELECT DISTINCT id FROM jobs) GROUP BY ALL"))
def first_day_diff(t):
    """A diff against a day that was never written: all is new, each id once."""
    before = snapshots.read_jobs(t.spark, _scratch(t, "nothing")).drop("snapshot_date")
    events = changes.change_events(schemas.conform(t.jobs, schemas.JOBS), before)
    return events.groupBy("event", "id").agg(F.count("*").alias("n"))



@proof(
    with_tables(
        f"""SELECT ingest_seq, CASE WHEN hit THEN 'data' ELSE role_family END AS role_family,
          CASE WHEN hit THEN 'senior' ELSE seniority END AS seniority, CASE WHEN hit THEN NULL ELSE remote_policy END AS remote_policy
        FROM (SELECT *, bool_or(ingest_seq % 3 = 0 AND o_orderstatus <> 'P') OVER (PARTITION BY id) AS hit FROM jobs)"""
    )
)
def answers_overlay(t):
    """Tagger answers over a snapshot with repeated ids; answers come twice as well."""
    body = '{"role_family": "Data", "seniority": " SENIOR", "remote_policy": "moon"}'
    answers = t.jobs.filter("ingest_seq % 3 = 0 AND o_orderstatus <> 'P'").select("id", F.lit(body).alias("body"))
    tagged = daily.apply_answers(
        t.jobs.withColumns({"visa_sponsorship": F.lit(None).cast("boolean"), **{
            c: F.array().cast("array<string>") for c in ("stack", "languages")}}),
        answers.unionAll(answers),
    )
    return tagged.select("ingest_seq", "role_family", "seniority", "remote_policy")
