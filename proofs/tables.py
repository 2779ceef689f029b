"""Merges, diffs, counts, rankings and samples over the derived tables."""

from pyspark.sql import functions as F

from proofs.base import (
    JOBS_SQL,
    NOW,
    now,
    pick,
    proof,
    rx,
    stamp,
    stamp_sql,
    with_tables,
    written_once,
)
from proofs.rules import _LANE, _PUBLIC, WHERE_CTE
from vacantia import fixed_values as V
from vacantia.functions import classify as C
from vacantia.functions import ids
from vacantia.functions import text as X
from vacantia.functions.times import posted_within
from vacantia.operators import changes, facets, merge, quality, rank_index, ranking, rollups, search, search_index, visibility
from vacantia.plans import read_model
from vacantia.sinks import writers

# --- merges -------------------------------------------------------------------


@proof(
    with_tables(
        """SELECT ingest_seq, url, source FROM (
          SELECT *, min(source_rank) OVER (PARTITION BY url) AS best FROM jobs) WHERE source_rank = best"""
    )
)
def source_priority_dedupe(t):
    return merge.dedupe_by_source_priority(t.jobs).select("ingest_seq", "url", "source")


@proof(
    """WITH d AS (SELECT doc_id, source, md5(text) AS k, CAST(substr(source, 4) AS INT) AS r FROM documents)
    SELECT doc_id, source FROM (SELECT *, min(r) OVER (PARTITION BY k) AS best FROM d) WHERE r = best"""
)
def document_priority_dedupe(t):
    rows = t.documents.select(
        "doc_id", "source", F.md5(F.col("text").cast("binary")).alias("url"),
        F.substr("source", F.lit(4)).cast("int").alias("source_rank"),
    )
    return merge.dedupe_by_source_priority(rows).select("doc_id", "source")


@proof(
    with_tables(
        """SELECT ingest_seq, company_slug, url FROM (SELECT *, row_number() OVER (
          PARTITION BY company_slug, url ORDER BY ingest_seq) AS rn FROM jobs) WHERE rn = 1"""
    )
)
def tenant_dedupe(t):
    return merge.first_per_key(t.jobs, ["company_slug", "url"], [F.col("ingest_seq")]).select(
        "ingest_seq", "company_slug", "url"
    )


@proof(
    with_tables(
        """SELECT max(ingest_seq) AS ingest_seq, company_slug FROM jobs GROUP BY company_slug"""
    )
)
def last_wins(t):
    return merge.last_per_key(t.jobs, ["company_slug"], "ingest_seq").select(
        "ingest_seq", "company_slug"
    )


@proof(
    """SELECT lower(trim(p_name)) AS name_key, min(p_partkey) AS p_partkey FROM part GROUP BY 1"""
)
def first_wins(t):
    rows = t.part.withColumn("name_key", F.lower(X.strip(F.col("p_name"))))
    return merge.first_per_key(rows, ["name_key"], [F.col("p_partkey")]).select(
        "name_key", "p_partkey"
    )


_DIM = "SELECT 'k-' || CAST({k} % 700 AS STRING) AS slug, {n} AS name, {k} AS seq, {r} AS rank_in"


@proof(
    """WITH cur AS (SELECT 'k-' || s_suppkey AS slug, s_name AS name FROM supplier),
    disc AS (SELECT 'k-' || (c_custkey % 700) AS slug, c_name AS name, c_custkey AS seq, c_nationkey % 3 AS r FROM customer),
    win AS (SELECT slug, name FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY r DESC, seq) AS rn FROM disc) WHERE rn = 1)
    SELECT slug, name FROM cur UNION ALL SELECT slug, name FROM win WHERE slug NOT IN (SELECT slug FROM cur)"""
)
def dimension_merge(t):
    key = F.lit("k-")
    curated = t.supplier.select(
        F.concat(key, F.col("s_suppkey")).alias("slug"), F.col("s_name").alias("name")
    )
    found = t.customer.select(
        F.concat(key, F.col("c_custkey") % 700).alias("slug"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("ingest_seq"), (F.col("c_nationkey") % 3).alias("source_rank"),
    )
    return merge.merge_dimension(curated, found)


@proof(
    """SELECT 'k-' || c_custkey AS slug, c_name AS name,
      CASE WHEN s_suppkey IS NOT NULL THEN CASE WHEN s_acctbal > 0 THEN floor(s_acctbal) END ELSE -1 END AS top_repo_stars
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
)
def preserve_enriched(t):
    rebuilt = t.customer.select(
        F.concat(F.lit("k-"), F.col("c_custkey")).alias("slug"), F.col("c_name").alias("name"),
        F.lit(-1.0).alias("top_repo_stars"),
    )
    old = t.supplier.select(
        F.concat(F.lit("k-"), F.col("s_suppkey")).alias("slug"),
        F.when(F.col("s_acctbal") > 0, F.floor("s_acctbal").cast("double")).alias("top_repo_stars"),
    )
    return merge.preserve_columns(rebuilt, old, ["top_repo_stars"])


_ORG = "CASE WHEN c_custkey % 5 = 0 THEN 'Acme' || CAST(c_custkey AS STRING) || {s} ELSE lower(c_mktsegment) || '-' || CAST(c_nationkey AS STRING) || {s} END"
_SUFFIXES = ["ai", "-hq", "team", "-inc", "co", "", "zinc"]


@proof(
    f"""WITH o AS (SELECT DISTINCT trim(regexp_replace(lower(org), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM (
        SELECT {_ORG.format(s=pick('c_custkey', _SUFFIXES))} AS org FROM customer)),
    v AS (SELECT s FROM o
      UNION SELECT rtrim(substr(s, 1, length(s) - 2), '-') FROM o WHERE ends_with(s, 'ai') OR ends_with(s, 'hq')
      UNION SELECT rtrim(substr(s, 1, length(s) - 4), '-') FROM o WHERE ends_with(s, 'team')
      UNION SELECT rtrim(rtrim(s, '-inc'), '-co') FROM o WHERE ends_with(s, 'inc') OR ends_with(s, 'co')),
    e AS (SELECT trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM supplier
      UNION SELECT lower(c_mktsegment) || '-' || c_nationkey FROM customer WHERE c_acctbal < 0)
    SELECT s AS slug FROM v WHERE length(s) > 2 AND length(s) < 50 AND s NOT IN (SELECT s FROM e)"""
)
def slug_candidates(t):
    orgs = t.customer.selectExpr(f"{_ORG.format(s=pick('c_custkey', _SUFFIXES))} AS org").distinct()
    found = orgs.select(F.explode(ids.slug_candidates(F.col("org"))).alias("slug")).distinct()
    seeded = t.supplier.select(ids.slugify_uncapped(F.col("s_name")).alias("slug")).union(
        t.customer.filter("c_acctbal < 0").select(
            F.concat_ws("-", F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"))
        )
    )
    return merge.without_existing(found, seeded.distinct())


@proof(
    """WITH m AS (SELECT CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE replace(p_name, ' ', '/') || '/' || p_partkey END AS id FROM part)
    SELECT DISTINCT substr(id, 1, strpos(id, '/') - 1) AS org FROM m WHERE contains(id, '/')"""
)
def distinct_orgs(t):
    models = t.part.selectExpr(
        "CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE replace(p_name, ' ', '/') || '/' || "
        "CAST(p_partkey AS STRING) END AS id"
    )
    return quality.distinct_orgs(models, "id")


_OWNERS = ["Google", "acme", "torvalds", "Beta", "KUBERNETES-sigs"]


@proof(
    f"""SELECT DISTINCT owner FROM (SELECT {pick('c_custkey', _OWNERS)} || CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS owner,
      CASE WHEN c_acctbal > 0 THEN 'Organization' ELSE 'User' END AS owner_type FROM customer)
    WHERE owner_type = 'Organization' AND lower(owner) NOT IN ('google', 'torvalds', 'kubernetes-sigs')"""
)
def organisation_owners(t):
    repos = t.customer.selectExpr(
        f"{pick('c_custkey', _OWNERS)} || CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS STRING) ELSE '' END AS owner",
        "CASE WHEN c_acctbal > 0 THEN 'Organization' ELSE 'User' END AS owner_type",
    )
    return quality.organisation_owners(repos)


# --- snapshots: yesterday knows statuses F and O, today O and P -----------------

_TODAY = """SELECT o_orderkey AS k, 'c-' || CAST(o_custkey AS STRING) AS company_slug,
  o_orderpriority || CASE WHEN o_orderkey % 6 = 0 THEN ' (v2)' ELSE '' END AS title,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'loc' || CAST(o_orderkey % 5 AS STRING) END AS location,
  CASE WHEN o_orderkey % 9 = 0 THEN 'remote' END AS remote_policy,
  CASE WHEN o_orderkey % 4 = 0 THEN 'senior' ELSE NULL END AS seniority,
  CASE WHEN o_orderkey % 8 = 0 THEN 10.0 ELSE 5.0 END AS lo, 20.0 AS hi,
  CASE WHEN o_orderkey % 11 = 0 THEN 'EURO' ELSE 'EUR' END AS ccy,
  CAST(o_orderdate AS TIMESTAMP) AS posted_at, o_orderstatus"""
_YESTERDAY = """SELECT o_orderkey AS k, 'c-' || CAST(o_custkey AS STRING) AS company_slug,
  o_orderpriority AS title,
  CASE WHEN o_orderkey % 14 = 0 THEN '' ELSE 'loc' || CAST(o_orderkey % 5 AS STRING) END AS location,
  CASE WHEN o_orderkey % 18 = 0 THEN 'remote' END AS remote_policy,
  CASE WHEN o_orderkey % 4 < 2 THEN 'senior' ELSE NULL END AS seniority,
  5.0 AS lo, 20.0 AS hi, 'EUR' AS ccy,
  CAST(o_orderdate AS TIMESTAMP) AS posted_at, o_orderstatus"""


def _snapshot(t, text: str, gone: str):
    rows = t.sql(text + " FROM {orders} WHERE o_orderstatus <> '" + gone + "'", orders=t.orders)
    url = F.concat(F.lit("https://j.test/"), F.col("k"))
    return rows.select(
        ids.stable_id(F.col("company_slug"), url).alias("id"), "company_slug", "title",
        url.alias("url"), "location", "remote_policy", "seniority",
        F.col("lo").cast("double").alias("salary_min"), F.col("hi").cast("double").alias("salary_max"),
        F.col("ccy").alias("salary_currency"), F.lit(None).cast("string").alias("salary_period"),
        "posted_at", F.lit("feed").alias("source"), F.col("k").alias("ingest_seq"),
        F.lit("").alias("description_md"), F.col("posted_at").alias("scraped_at"),
    )


def _events(t):
    return changes.change_events(_snapshot(t, _TODAY, "F"), _snapshot(t, _YESTERDAY, "P"))


_BAND = "CASE WHEN length(ccy) = 3 THEN CAST(lo AS DOUBLE) || '|' || CAST(hi AS DOUBLE) || '|' || ccy || '|year' END"
_SIDE = (
    "SELECT substr(sha256(company_slug || ':' || 'https://j.test/' || k), 1, 16) AS id, company_slug, title, "
    "'https://j.test/' || k AS url, coalesce(location, '') AS location, remote_policy, seniority, "
    f"{_BAND} AS salary, 'feed' AS source, posted_at FROM ("
)
_CHANGED = " UNION ALL ".join(
    f"SELECT 'changed' AS event, t.id, NULL AS company_slug, NULL AS title, NULL AS url, NULL AS location, "
    f"NULL AS source, NULL AS posted, '{f}' AS field, y.{f} AS old, t.{f} AS new FROM t JOIN y USING (id) "
    f"WHERE t.{f} IS DISTINCT FROM y.{f}"
    for f in changes.TRACKED
)
_DIFF_CTE = f"""WITH t AS ({_SIDE}{_TODAY} FROM orders WHERE o_orderstatus <> 'F')),
  y AS ({_SIDE}{_YESTERDAY} FROM orders WHERE o_orderstatus <> 'P')),
  ev AS ({_CHANGED}
    UNION ALL SELECT 'new', id, company_slug, title, url, location, source, {stamp_sql('posted_at')}, NULL, NULL, NULL
      FROM t WHERE id NOT IN (SELECT id FROM y)
    UNION ALL SELECT 'removed', id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
      FROM y WHERE id NOT IN (SELECT id FROM t))"""


@proof(f"{_DIFF_CTE} SELECT * FROM ev")
def snapshot_diff_events(t):
    return _events(t).withColumn("posted", stamp(F.col("posted_at"))).drop("posted_at")


@proof(
    f"""{_DIFF_CTE}, top AS (SELECT company_slug, count(*) AS n FROM ev WHERE event = 'new'
       GROUP BY 1 ORDER BY n DESC, company_slug LIMIT 5),
    s AS (SELECT count(*) FILTER (event = 'new') AS a, count(*) FILTER (event = 'removed') AS b,
             count(*) FILTER (event = 'changed') AS c FROM ev),
    l AS (SELECT coalesce(string_agg(company_slug || '(' || n || ')', ', ' ORDER BY n DESC, company_slug), '') AS top FROM top)
    SELECT a AS n_new, b AS n_removed, c AS n_changed, top, a + b + c = 0 AS is_empty,
      '+' || a || ' new · -' || b || ' removed · ~' || c || ' changed' ||
      CASE WHEN top <> '' THEN chr(10) || 'Top: ' || top ELSE '' END AS summary FROM s, l"""
)
def diff_summary(t):
    return changes.change_summary(_events(t))


@proof(
    f"""{_DIFF_CTE} SELECT CASE event
      WHEN 'removed' THEN '{{"event":"removed","id":"' || id || '"}}'
      WHEN 'changed' THEN '{{"event":"changed","job_id":"' || id || '","field":"' || field || '","old":' ||
         coalesce('"' || old || '"', 'null') || ',"new":' || coalesce('"' || new || '"', 'null') || '}}'
      ELSE '{{"event":"new","id":"' || id || '","company_slug":"' || company_slug || '","title":"' || title ||
         '","url":"' || url || '","location":"' || location || '","source":"' || source || '","posted_at":"' ||
         replace(posted, ' ', 'T') || '.000Z"}}' END AS value FROM ev"""
)
def change_log(t):
    return writers.change_log_rows(_events(t))


_PRIOR = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'data' WHEN o_orderkey % 3 = 1 THEN '' END AS role_family,
  CASE WHEN o_orderkey % 4 = 0 THEN 'mid' END AS seniority, o_custkey AS seq"""


@proof(
    f"""WITH p AS ({_PRIOR} FROM orders WHERE o_orderstatus <> 'P'),
    dup AS (SELECT * FROM p UNION ALL SELECT k, 'sales', NULL, seq - 5000000 FROM p),
    tagged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM dup
       WHERE coalesce(role_family, '') <> '' OR coalesce(seniority, '') <> '') WHERE rn = 1),
    j AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'hr' END AS role_family,
            CASE WHEN o_orderkey % 7 = 0 THEN 'exec' END AS seniority FROM orders WHERE o_orderstatus <> 'F')
    SELECT j.k AS id, CASE WHEN j.role_family IS NULL AND j.seniority IS NULL THEN t.role_family ELSE j.role_family END AS role_family,
      CASE WHEN j.role_family IS NULL AND j.seniority IS NULL THEN t.seniority ELSE j.seniority END AS seniority
    FROM j LEFT JOIN tagged t USING (k)"""
)
def carry_forward(t):
    prior = t.sql(_PRIOR + " FROM {orders} WHERE o_orderstatus <> 'P'", orders=t.orders)
    prior = prior.unionByName(
        prior.select(
            "k", F.lit("sales").alias("role_family"), F.lit(None).cast("string").alias("seniority"),
            (F.col("seq") - 5000000).alias("seq"),
        )
    ).withColumnRenamed("k", "id")
    jobs = t.orders.filter("o_orderstatus <> 'F'").selectExpr(
        "o_orderkey AS id", "CASE WHEN o_orderkey % 5 = 0 THEN 'hr' END AS role_family",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'exec' END AS seniority",
    )
    return merge.carry_tags_forward(jobs, prior, sequence="seq")


@proof(
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'new' || o_orderpriority ELSE 'old' END AS role_family
    FROM orders"""
)
def tag_overlay(t):
    base = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("old").alias("role_family"))
    fresh = t.orders.filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("new"), "o_orderpriority").alias("role_family"),
    )
    return merge.overlay(base, fresh, ["role_family"])


@proof(
    with_tables(
        "SELECT ingest_seq FROM jobs WHERE role_family IS NULL AND seniority IS NULL"
    )
)
def untagged(t):
    return merge.untagged(t.jobs).select("ingest_seq")


# --- counts -------------------------------------------------------------------

_FACETS = """SELECT 'role' AS facet, role_family AS value, count(*) AS n FROM w WHERE coalesce(role_family, '') <> '' GROUP BY 2
  UNION ALL SELECT 'country', company_country, count(*) FROM w WHERE coalesce(company_country, '') <> '' GROUP BY 2
  UNION ALL SELECT 'source', source, count(*) FROM w GROUP BY 2
  UNION ALL SELECT 'where', where_value, count(*) FROM w GROUP BY 2"""


def _facets(t):
    return facets.facet_counts(
        read_model.with_where(t.jobs, t.companies),
        {"role": "role_family", "country": "company_country", "source": "source", "where": "where"},
    )


@proof(with_tables(_FACETS, w=WHERE_CTE))
def facet_counts(t):
    return _facets(t)


@proof(
    with_tables(
        f"""SELECT value, n, 'where' AS facet FROM (SELECT value, n FROM f WHERE facet = 'where' AND value <> 'Other' ORDER BY n DESC, value LIMIT 25)
        UNION ALL SELECT value, n, 'role' FROM f WHERE facet = 'role' AND value IN ({', '.join(rx(r) for r in V.ROLE_LABELS)})""",
        w=WHERE_CTE, f=_FACETS,
    )
)
def facet_options(t):
    counts = _facets(t)
    return facets.where_options(counts).unionByName(facets.role_options(counts)).select(
        "value", "n", "facet"
    )


@proof(
    with_tables(
        """SELECT value, n, row_number() OVER (ORDER BY CASE value WHEN 'Remote' THEN 0 WHEN 'France' THEN 1 ELSE 2 END, value) AS panel,
          row_number() OVER (ORDER BY CASE WHEN starts_with(value, 'Remote') THEN 0 ELSE 1 END,
            CASE WHEN starts_with(value, 'Remote') THEN -n ELSE 0 END, value) AS chips
        FROM f WHERE facet = 'where'""",
        w=WHERE_CTE, f=_FACETS,
    )
)
def facet_orders(t):
    from pyspark.sql import Window

    # Facet values are bounded by the country and tier names, so these windows are small.
    rows = _facets(t).filter("facet = 'where'")
    value, n = F.col("value"), F.col("n")
    return rows.select(
        "value", "n",
        F.row_number().over(Window.orderBy(*facets.pinned_order(value))).alias("panel"),
        F.row_number().over(Window.orderBy(*facets.grouped_order(value, n, "Remote"))).alias("chips"),
    )


_FACETS_SQL = with_tables(
        f"""SELECT 'where' AS facet, w.where_value AS value, count(*) AS n FROM w JOIN companies c ON c.slug = w.company_slug WHERE {_PUBLIC} GROUP BY 2
        UNION ALL SELECT 'remote', remote_policy, count(*) FROM w JOIN companies c ON c.slug = w.company_slug WHERE {_PUBLIC} AND coalesce(remote_policy, '') <> '' GROUP BY 2
        UNION ALL SELECT 'role', role_family, count(*) FROM w JOIN companies c ON c.slug = w.company_slug WHERE {_PUBLIC} AND coalesce(role_family, '') <> '' GROUP BY 2""",
        w=WHERE_CTE,
    )


@proof(_FACETS_SQL)
def search_facets(t):
    """Counts of the index of public rows, from its bitmaps."""
    rows = visibility.public_jobs(
        read_model.with_where(t.jobs, t.companies).drop("company_country"), t.companies
    )
    names = {"where": "where", "remote": "remote_policy", "role": "role_family"}
    root = written_once(
        t, "facets", lambda root: search_index.write_day(rows, F.col("title"), root, "2026-05-01", key="ingest_seq", facets=names)
    )
    return search_index.facet_counts(t.spark, root)


@proof(_FACETS_SQL)
def read_model_facets(t):
    """The same by one pass over the rows."""
    rows = visibility.public_jobs(
        read_model.with_where(t.jobs, t.companies).drop("company_country"), t.companies
    )
    return facets.facet_counts(
        rows, {"where": "where", "remote": "remote_policy", "role": "role_family"}
    )


@proof(with_tables("SELECT company_slug, count(*) AS n FROM jobs GROUP BY 1"))
def company_counts(t):
    return facets.counts_by(t.jobs, "company_slug")


@proof(
    with_tables(
        f"""SELECT company_slug, n FROM (SELECT company_slug, count(*) AS n FROM jobs
        WHERE posted_at > {NOW} - INTERVAL 7 DAY GROUP BY 1) ORDER BY n DESC, company_slug LIMIT 15"""
    )
)
def recent_activity(t):
    recent = t.jobs.filter(F.col("posted_at") > now() - F.expr("interval 7 days"))
    counts = facets.counts_by(recent, "company_slug")
    return counts.orderBy(F.col("n").desc(), "company_slug").limit(15)


@proof(
    with_tables(
        "SELECT country, count(*) AS n FROM companies WHERE NOT starts_with(slug, 'via-') "
        "AND country <> '' GROUP BY 1 ORDER BY n DESC, country LIMIT 15"
    )
)
def country_ranking(t):
    firms = t.companies.filter(~F.col("slug").startswith("via-") & (F.col("country") != ""))
    return facets.counts_by(firms, "country").orderBy(F.col("n").desc(), "country").limit(15)


@proof(
    with_tables(
        """SELECT CASE WHEN source IN ('greenhouse','lever','ashby') THEN 'ats' ELSE 'aggregator' END AS source_class,
          count(*) AS n, count(DISTINCT source) AS n_sources FROM jobs GROUP BY 1"""
    )
)
def source_split(t):
    return facets.source_split(t.jobs)


_LOG = (
    "SELECT CAST(ts AS DATE) AS snapshot_date, event_type AS extractor, 'u-' || CAST(user_id AS STRING) AS company_slug, "
    "event_type <> 'error' AS success, CASE WHEN value > 40 THEN CAST(FLOOR(value) AS INT) ELSE 0 END AS job_count, "
    "CAST(FLOOR(value * 10) AS INT) AS duration_ms"
)


@proof(
    f"""WITH l AS ({_LOG} FROM events) SELECT count(*) AS total, count(*) FILTER (success) AS ok,
      avg(CAST(success AS INT)) AS success_rate, avg(CAST(success AS INT)) < 0.5 AS below_half FROM l"""
)
def run_success(t):
    return quality.success_summary(t.sql(_LOG + " FROM {events}", events=t.events))


@proof(
    with_tables(
        """SELECT source AS extractor, '(aggregator)' AS company_slug, true AS success, CAST(count(*) AS INT) AS job_count
        FROM (SELECT *, min(source_rank) OVER (PARTITION BY url) AS best FROM jobs) WHERE source_rank = best GROUP BY 1"""
    )
)
def run_log_counts(t):
    attempts = t.jobs.select("source").distinct().select(
        F.col("source").alias("extractor"), F.lit("(aggregator)").alias("company_slug"),
        F.lit(True).alias("success"), F.lit(0).alias("duration_ms"),
        F.lit(None).cast("string").alias("error"),
    )
    kept = merge.dedupe_by_source_priority(t.jobs)
    return quality.source_log(kept, attempts).drop("duration_ms", "error")


@proof(
    f"""WITH l AS ({_LOG} FROM events), r AS (SELECT DISTINCT snapshot_date FROM l ORDER BY 1 DESC LIMIT 2)
    SELECT company_slug, count(*) AS observations FROM l WHERE snapshot_date IN (SELECT snapshot_date FROM r)
    GROUP BY 1 HAVING count(*) >= 2 AND max(job_count) = 0"""
)
def stale_entities(t):
    return quality.stale_entities(t.sql(_LOG + " FROM {events}", events=t.events), 2)


@proof(
    """SELECT source, lang, count(*) AS n, avg(CASE WHEN quality IS NOT NULL THEN 1.0 ELSE 0 END) AS quality_coverage,
      avg(CASE WHEN coalesce(t, '') <> '' THEN 1.0 ELSE 0 END) AS topic_coverage,
      avg(len(string_split(lang, 'e'))) AS avg_stack, CAST(sum(n_chars) AS BIGINT) AS n_chars
    FROM (SELECT d.*, l.quality, CASE WHEN toxic = 1 THEN '' ELSE CAST(toxic AS VARCHAR) END AS t
          FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY 1, 2"""
)
def coverage_pivot(t):
    rows = t.documents.drop("text").join(t.labels, "doc_id", "left").withColumns(
        {
            "topic": F.when(F.col("toxic") == 1, "").otherwise(F.col("toxic").cast("string")),
            "stack": F.split("lang", "e"),
        }
    )
    return quality.coverage(
        rows, ["quality", "topic"], by=["source", "lang"], stack="stack", tokens=["n_chars"]
    )


@proof(
    """WITH p AS (SELECT 'u' || user_id AS slug, event_type AS provider, count(*) FILTER (value > 30) AS n FROM events GROUP BY 1, 2),
    h AS (SELECT * FROM p WHERE n > 0)
    SELECT slug, upper(slug[1]) || slug[2:] AS name, 'XX' AS country, first(provider ORDER BY n DESC, provider) AS ats_provider, slug AS ats_handle,
      CAST(sum(n) AS BIGINT) AS total_jobs, 'draft: probe found {' || string_agg('''' || provider || ''': ' || n, ', ' ORDER BY provider) || '} (' || CAST(sum(n) AS BIGINT) || ' jobs across providers)' AS notes FROM h GROUP BY slug"""
)
def best_provider(t):
    probes = t.events.groupBy(
        F.concat(F.lit("u"), "user_id").alias("slug"), F.col("event_type").alias("provider")
    ).agg(F.count_if(F.col("value") > 30).alias("job_count"))
    return quality.best_provider(probes)


@proof(
    with_tables(
        """SELECT company_slug, CAST(c.period AS VARCHAR) AS period, n, p AS previous_n, n - p AS delta
        FROM (SELECT *, CASE WHEN lag(n) OVER w IS NULL THEN NULL WHEN lag(period) OVER w = period - INTERVAL 7 DAY THEN lag(n) OVER w ELSE 0 END AS p FROM c
        WINDOW w AS (PARTITION BY company_slug ORDER BY c.period)) c""",
        c="""SELECT company_slug, CAST(date_trunc('week', posted_at) AS DATE) AS period, count(*) AS n FROM jobs
           WHERE posted_at IS NOT NULL GROUP BY 1, 2""",
    )
)
def velocity_wow(t):
    """From counts kept over three days, of which the last holds all jobs as they are."""
    out = rollups.weekly_velocity(t.spark, _three_days(t), "2026-05-03")
    return out.withColumn("period", F.col("period").cast("string"))


def _three_days(t) -> str:
    """Three written snapshots and their counts: rows come, go, change hands and dates."""
    jobs, k = t.jobs, F.col("ingest_seq")
    moved = jobs.filter(k % 3 != 1).withColumns({
        "company_slug": F.when(k % 7 == 0, F.lit("other")).otherwise(F.col("company_slug")),
        "posted_at": F.when(k % 5 == 0, F.col("posted_at") + F.expr("interval 9 days")).otherwise(F.col("posted_at")),
    })

    def build(root: str) -> None:
        for day, rows in (("2026-05-01", jobs.filter(k % 4 != 0)), ("2026-05-02", moved.unionAll(moved.filter(k % 11 == 0))), ("2026-05-03", jobs)):
            writers.write_snapshot(rows, t.companies, root, day)
            rollups.update(t.spark, root, day)

    return written_once(t, "rollup", build)


@proof(
    with_tables(
        """SELECT company_slug, CAST(c.period AS VARCHAR) AS period, n, p AS previous_n, n - p AS delta
        FROM (SELECT *, CASE WHEN lag(n) OVER w IS NULL THEN NULL WHEN lag(period) OVER w = period - INTERVAL 7 DAY THEN lag(n) OVER w ELSE 0 END AS p FROM c
        WINDOW w AS (PARTITION BY company_slug ORDER BY c.period)) c""",
        c="""SELECT company_slug, CAST(date_trunc('week', posted_at) AS DATE) AS period, count(*) AS n FROM jobs
           WHERE posted_at IS NOT NULL GROUP BY 1, 2""",
    )
)
def velocity_recount(t):
    """The same by a recount of the jobs."""
    return changes.weekly_velocity(t.jobs).withColumn("period", F.col("period").cast("string"))


@proof(with_tables("SELECT company_slug, count(*) AS n FROM jobs GROUP BY 1"))
def company_counts_kept(t):
    return rollups.company_counts(t.spark, _three_days(t), "2026-05-03")


@proof(
    with_tables(
        f"""SELECT company_slug, n FROM (SELECT company_slug, count(*) AS n FROM jobs
        WHERE posted_at > {NOW} - INTERVAL 7 DAY GROUP BY 1) ORDER BY n DESC, company_slug LIMIT 15"""
    )
)
def recent_activity_kept(t):
    recent = rollups.recent_counts(t.spark, _three_days(t), "2026-05-03", now() - F.expr("interval 7 days"))
    return recent.orderBy(F.col("n").desc(), "company_slug").limit(15)


# --- rankings and samples -----------------------------------------------------

_W1 = "posted_at DESC NULLS LAST, company_slug, ingest_seq"


def _order():
    return ranking.recency("posted_at", "ingest_seq")


@proof(
    with_tables(
        f"""SELECT ingest_seq, company_slug, company_rank FROM (SELECT *, row_number() OVER (
          PARTITION BY company_slug ORDER BY {_W1}) AS company_rank FROM jobs) WHERE company_rank <= 5
        ORDER BY {_W1} LIMIT 100"""
    )
)
def front_page_cap(t):
    return ranking.front_page(t.jobs, _order()).select("ingest_seq", "company_slug", "company_rank")


@proof(
    with_tables(
        f"""SELECT ingest_seq, global_rank, CAST(ceil(global_rank / 100.0) AS BIGINT) AS page FROM (
          SELECT ingest_seq, row_number() OVER (ORDER BY {_W1}) AS global_rank FROM jobs)"""
    )
)
def page_of_rank(t):
    """Ranks of the stored ranking; nothing is sorted when it is read."""
    ranked = rank_index.ranks(t.spark, _listing(t), "2026-05-01")
    return ranked.select("ingest_seq", "global_rank", F.ceil(F.col("global_rank") / 100).cast("bigint").alias("page"))


def _listing(t) -> str:
    """The listing of jobs, written in order once."""
    slim = t.jobs.select("ingest_seq", "company_slug", "posted_at")
    return written_once(t, "listing", lambda root: rank_index.write(slim, _order(), root, "2026-05-01"))


@proof(
    with_tables(
        f"""SELECT ingest_seq, global_rank FROM (SELECT ingest_seq, row_number() OVER (ORDER BY {_W1}) AS global_rank FROM jobs)
        WHERE global_rank BETWEEN 701 AND 800"""
    )
)
def listing_page(t):
    """Page eight, read from the folders that hold it."""
    return rank_index.page(t.spark, _listing(t), "2026-05-01", 8).select("ingest_seq", "global_rank")


@proof(
    with_tables(
        f"""SELECT ingest_seq, global_rank, CAST(ceil(global_rank / 100.0) AS BIGINT) AS page FROM (
          SELECT ingest_seq, row_number() OVER (ORDER BY {_W1}) AS global_rank FROM jobs)"""
    )
)
def page_of_rank_once(t):
    """The same without a stored ranking."""
    slim = t.jobs.select("ingest_seq", "company_slug", "posted_at")
    return ranking.pages(slim, _order()).select("ingest_seq", "global_rank", "page")


@proof(
    with_tables(
        """SELECT ingest_seq, company_slug, row_number() OVER (PARTITION BY company_slug
          ORDER BY posted_at DESC NULLS LAST, title, ingest_seq) AS company_position FROM jobs"""
    )
)
def company_postings(t):
    slim = t.jobs.select("ingest_seq", "company_slug", "posted_at", "title")
    order = [F.col("posted_at").desc_nulls_last(), F.col("title"), F.col("ingest_seq")]
    root = written_once(t, "companies", lambda root: rank_index.write(slim, order, root, "2026-05-01", group="company_slug"))
    return rank_index.group_positions(t.spark, root, "2026-05-01", "company_slug", "company_position").select(
        "ingest_seq", "company_slug", "company_position"
    )


@proof(
    with_tables(
        f"""SELECT slug, name, coalesce(n, 0) AS n FROM companies LEFT JOIN
        (SELECT company_slug AS slug, count(*) AS n FROM jobs GROUP BY 1) USING (slug) WHERE {_PUBLIC}"""
    )
)
def company_ranking(t):
    return ranking.company_ranking(visibility.public_companies(t.companies), t.jobs).select(
        "slug", "name", "n"
    )


@proof(
    with_tables(
        """SELECT company_slug, n, lpad(CAST(rn AS VARCHAR), 2, '0') AS rank,
          greatest(2, CAST(floor(n * 200.0 / greatest(m, 1) + 0.5) AS BIGINT)) AS bar
        FROM (SELECT *, row_number() OVER (ORDER BY n DESC, company_slug) AS rn, max(n) OVER () AS m
              FROM (SELECT company_slug, count(*) AS n FROM jobs WHERE NOT starts_with(company_slug, 'via-') GROUP BY 1
                    ORDER BY n DESC, company_slug LIMIT 25))"""
    )
)
def leaderboard(t):
    curated = t.jobs.filter(~F.col("company_slug").startswith("via-"))
    return ranking.leaderboard(facets.counts_by(curated, "company_slug"), 25)


def _sample_sql(n: int) -> str:
    return f"""WITH k AS (SELECT greatest(1, {n} // greatest(count(DISTINCT source), 1)) AS target FROM documents),
    h AS (SELECT greatest(1, target // 2) AS half FROM k),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn,
            count(*) OVER (PARTITION BY source) AS total FROM documents),
    s AS (SELECT doc_id, source, rn, CASE WHEN rn <= half THEN 0 WHEN rn > total - half THEN 1 ELSE 2 END AS seg FROM r, h)
    SELECT doc_id, source FROM s ORDER BY CASE WHEN seg = 2 THEN 1 ELSE 0 END, source, CASE WHEN seg = 1 THEN 1 ELSE 0 END, rn LIMIT {n}"""


def _sample(t, n: int):
    rows = t.documents.select("doc_id", "source", "n_chars")
    sample = ranking.stratified_sample(rows, n, size=F.col("n_chars"), key="doc_id")
    return sample.select("doc_id", "source")


@proof(_sample_sql(60))
def stratified_sample(t):
    return _sample(t, 60)


@proof(_sample_sql(5000))
def stratified_sample_large(t):
    return _sample(t, 5000)


_FEED = """SELECT id, title, company_slug, url, location, description_md, coalesce(posted_at, scraped_at) AS pub
  FROM jobs_once ORDER BY coalesce(posted_at, scraped_at) DESC, id LIMIT 50"""
_LONGER = "description_md || repeat(' more', 200)"
_ONCE = f"""SELECT * REPLACE ({_LONGER} AS description_md) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_seq) AS once FROM jobs) WHERE once = 1"""


def _once(t):
    jobs = t.jobs.withColumn("description_md", F.expr(_LONGER))
    return merge.first_per_key(jobs, ["id"], [F.col("ingest_seq")])


@proof(
    with_tables(
        """SELECT title || ' — ' || company_slug AS title, url AS link, id AS guid,
          strftime(pub, '%a, %d %b %Y %H:%M:%S +0000') AS pubDate,
          '<b>' || company_slug || '</b> · ' || coalesce(nullif(location, ''), '—') || chr(10) || chr(10) ||
            description_md AS description FROM feed""",
        jobs_once=_ONCE, feed=_FEED,
    )
)
def feed_top50(t):
    return writers.feed_items(_once(t)).drop("published")


_XML = "replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@proof(
    with_tables(
        f"""SELECT '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<rss version="2.0"><channel><title>New postings</title>'
          || '<link>https://site.test/</link><description>Daily</description><lastBuildDate>'
          || strftime({NOW}, '%a, %d %b %Y %H:%M:%S +0000') || '</lastBuildDate><language>en</language>'
          || string_agg('<item><title>' || {_XML.format(x="(title || ' — ' || company_slug)")} || '</title><link>' || url
             || '</link><guid isPermaLink="false">' || id || '</guid><pubDate>' || strftime(pub, '%a, %d %b %Y %H:%M:%S +0000')
             || '</pubDate><description>' || {_XML.format(x="('<b>' || company_slug || '</b> · ' || coalesce(nullif(location, ''), '—') || chr(10) || chr(10) || description_md)")}
             || '</description></item>', '' ORDER BY pub DESC, id) || '</channel></rss>' AS xml FROM feed""",
        jobs_once=_ONCE, feed=_FEED,
    )
)
def feed_xml(t):
    return writers.feed_document(
        writers.feed_items(_once(t)), title="New postings", link="https://site.test/",
        description="Daily", built_at=now(),
    )


@proof(
    with_tables(
        """SELECT ingest_seq, '{"@context":"https://schema.org","@type":"JobPosting","title":"' || title
          || '","description":"' || CASE WHEN description_md = '' THEN title ELSE description_md END || '"'
          || CASE WHEN posted_at IS NULL THEN '' ELSE ',"datePosted":"' || strftime(posted_at, '%Y-%m-%dT%H:%M:%SZ') || '"' END
          || ',"hiringOrganization":{"@type":"Organization","name":"' || company_slug || '"}'
          || CASE WHEN coalesce(location, '') = '' THEN '' ELSE
             ',"jobLocation":{"@type":"Place","address":{"@type":"PostalAddress","addressLocality":"' || location || '"}}' END
          || CASE WHEN remote_policy = 'remote-eu' THEN ',"applicantLocationRequirements":{"@type":"Country","name":"Europe"}' ELSE '' END
          || CASE WHEN starts_with(remote_policy, 'remote') THEN ',"jobLocationType":"TELECOMMUTE"' ELSE '' END
          || ',"url":"https://site.test/jobs/' || company_slug || '/'
          || coalesce(nullif(trim(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'job')
          || '-' || substr(id, 1, 8) || '/","directApply":false}' AS body FROM jobs"""
    )
)
def posting_json(t):
    rows = t.jobs.withColumns(
        {
            "company_name": F.col("company_slug"), "career_url": F.lit(None).cast("string"),
            "description_html": F.col("description_md"),
        }
    )
    return rows.select("ingest_seq", writers.posting_json("https://site.test").alias("body"))


_KR = (
    "CASE WHEN {x} >= 1000 THEN CAST(CAST(floor({x} / 1000 + 0.5) AS BIGINT) AS VARCHAR) || 'k' "
    "WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"
)


@proof(
    with_tables(
        f"""SELECT ingest_seq, array_to_string(list_filter([
          CASE WHEN d IS NULL THEN '' WHEN d <= 1 THEN 'NEW' WHEN d <= 7 THEN d || 'D'
               WHEN d <= 31 THEN CAST(floor(d / 7.0 + 0.5) AS BIGINT) || 'W' ELSE CAST(floor(d / 30.0 + 0.5) AS BIGINT) || 'MO' END,
          CASE remote_policy WHEN 'remote-global' THEN 'REMOTE-WW' WHEN 'remote-eu' THEN 'REMOTE-EU'
               WHEN 'remote' THEN 'REMOTE' WHEN 'hybrid' THEN 'HYBRID' ELSE '' END,
          CASE WHEN salary_currency IS NULL OR (lo IS NULL AND hi IS NULL) THEN '' ELSE
            CASE salary_currency WHEN 'EUR' THEN '€' WHEN 'GBP' THEN '£' WHEN 'USD' THEN '$' WHEN 'PLN' THEN 'zł' WHEN 'CHF' THEN 'CHF'
              ELSE salary_currency || ' ' END
            || CASE WHEN lo IS NOT NULL AND hi IS NOT NULL AND lo <> hi THEN {_KR.format(x='lo')} || '–' || {_KR.format(x='hi')}
                    ELSE {_KR.format(x='coalesce(lo, hi)')} END
            || CASE salary_period WHEN 'month' THEN '/mo' WHEN 'day' THEN '/d' WHEN 'hour' THEN '/h' ELSE '' END END
          ], lambda x: x <> ''), ' · ') AS meta
        FROM (SELECT *, floor(salary_min) AS lo, floor(salary_max) AS hi, CASE WHEN posted_at <= {NOW} THEN
                CAST(floor((epoch({NOW}) - epoch(posted_at)) / 86400) AS BIGINT) END AS d FROM jobs)"""
    )
)
def meta_line(t):
    whole = {c: F.floor(c).cast("double") for c in ("salary_min", "salary_max")}
    return t.jobs.withColumns(whole).select(
        "ingest_seq", read_model.meta_line(now()).alias("meta")
    )


@proof(
    with_tables(
        "SELECT id, description_md, ingest_seq FROM jobs WHERE length(description_md) > 0"
    )
)
def description_rows(t):
    side = writers.descriptions(t.jobs.withColumn("id", F.struct("id", "ingest_seq")))
    return side.select("id.id", "description_md", "id.ingest_seq")


@proof(
    with_tables(
        """SELECT ingest_seq, CASE WHEN ok THEN salary_min END AS salary_min, CASE WHEN ok THEN salary_max END AS salary_max,
          CASE WHEN ok THEN salary_currency END AS salary_currency, CASE WHEN ok THEN per END AS salary_period, coalesce(location, '') AS location
        FROM (SELECT *, coalesce(nullif(salary_period, ''), 'year') AS per,
          coalesce(length(salary_currency) = 3 AND (salary_min IS NOT NULL OR salary_max IS NOT NULL)
            AND coalesce(salary_min <= salary_max, true) AND coalesce(nullif(salary_period, ''), 'year') IN ('year','month','day','hour'), false) AS ok
          FROM jobs)"""
    )
)
def storage_rows(t):
    repaired = changes.repaired(t.jobs.withColumn("id", F.col("ingest_seq").cast("string")))
    flat = writers.job_rows(repaired)
    return flat.select(
        F.col("id").cast("bigint").alias("ingest_seq"), "salary_min", "salary_max",
        "salary_currency", "salary_period", "location",
    )


# --- search -------------------------------------------------------------------

_QUERY = "the of ention"
_WORDS = search.query_terms(_QUERY)
_TOK = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
_TF = ", ".join(
    f"len(list_filter(toks, lambda w: w = {rx(w)})) AS tf{i}" for i, w in enumerate(_WORDS)
)
_DF = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(_WORDS)))
_SCORE = " + ".join(
    f"ln(1.0 + (docs - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * n / mean))"
    for i in range(len(_WORDS))
)


@proof(
    f"""WITH d AS (SELECT doc_id, lang, source, {_TOK} AS toks FROM documents),
    f AS (SELECT doc_id, lang, source, len(toks) AS n, {_TF} FROM d),
    s AS (SELECT count(*) AS docs, avg(n) AS mean, {_DF} FROM f)
    SELECT doc_id, round({_SCORE}, 6) AS score FROM f, s
    WHERE {' AND '.join(f'tf{i} > 0' for i in range(len(_WORDS)))} AND lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3')
    ORDER BY round({_SCORE}, 9) DESC, doc_id LIMIT 25"""
)
def faceted_search(t):
    """From the stored index, whose two halves were appended one after the other."""
    hits = search_index.search(
        t.spark, _document_index(t), _QUERY, facets=["lang", "source"],
        selected={"lang": ["en", "de"], "source": ["src1", "src2", "src3"]},
    )
    return hits.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))


def _document_index(t) -> str:
    """The index over all documents, in two appended halves."""
    def build(root: str) -> None:
        for k, day in enumerate(("2026-05-01", "2026-05-02")):
            rows = t.documents.filter(F.col("doc_id") % 2 == k)
            search_index.write_day(rows, F.col("text"), root, day, key="doc_id", facets={"lang": "lang", "source": "source"}, block_rows=1 << 12)

    return written_once(t, "index", build)


@proof(
    """WITH d AS (SELECT lang, source FROM documents WHERE lang IN ('en', 'fr') AND source IN ('src0', 'src2', 'src5'))
    SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM d GROUP BY 2
    UNION ALL SELECT 'source', source, count(*) FROM d GROUP BY 2"""
)
def selected_facets(t):
    """Facet counts under a selection, from bitmaps."""
    return search_index.facet_counts(t.spark, _document_index(t), {"lang": ["en", "fr"], "source": ["src0", "src2", "src5"]})


@proof(
    f"""WITH d AS (SELECT doc_id, lang, source, {_TOK} AS toks FROM documents),
    f AS (SELECT doc_id, lang, source, len(toks) AS n, {_TF} FROM d),
    s AS (SELECT count(*) AS docs, avg(n) AS mean, {_DF} FROM f)
    SELECT doc_id, round({_SCORE}, 6) AS score FROM f, s
    WHERE {' AND '.join(f'tf{i} > 0' for i in range(len(_WORDS)))} AND lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3')
    ORDER BY round({_SCORE}, 9) DESC, doc_id LIMIT 25"""
)
def faceted_scan(t):
    """The same without an index: one pass over the texts."""
    hits = search.search(
        t.documents.select("doc_id", "lang", "source", "text"), F.col("text"), _QUERY,
        key="doc_id", facets={"lang": "lang", "source": "source"},
        selected={"lang": ["en", "de"], "source": ["src1", "src2", "src3"]},
    )
    return hits.select("doc_id", F.round("score", 6).alias("score"))


@proof("SELECT doc_id FROM documents WHERE source IN ('src1', 'src4') ORDER BY doc_id LIMIT 25 OFFSET 25")
def facet_noop(t):
    """Every language selected is no restriction; page two of an empty query."""
    hits = search.search(
        t.documents.select("doc_id", "lang", "source"), F.lit(""), "", key="doc_id", page=2,
        facets={"lang": "lang", "source": "source"},
        selected={"lang": ["de", "en", "es", "fr"], "source": ["src1", "src4"]},
    )
    return hits.select("doc_id")


@proof(
    "SELECT DISTINCT lang AS facet, source AS value FROM documents WHERE n_chars % 3 < 2"
)
def search_params(t):
    key = (
        F.when(F.col("n_chars") % 3 == 0, F.concat(F.lit("filter["), "lang", F.lit("][]")))
        .when(F.col("n_chars") % 3 == 1, F.concat(F.lit("filter["), "lang", F.lit("]")))
        .otherwise("q")
    )
    return search.selection_of(t.documents.select(key.alias("key"), F.col("source").alias("value")))
