"""Column functions over whole tables."""

from pyspark.sql import functions as F

from proofs.base import NOW, PERIODS, now, pick, proof, rx, stamp, with_tables
from vacantia import fixed_values as V
from vacantia.functions import classify as C
from vacantia.functions import ids, money, tagging, text, times, urls, validation

_SLUG = (
    "trim(regexp_replace(lower(trim({x})), '[^a-z0-9]+', '-', 'g'), '-')"
)


@proof(
    "SELECT c_custkey, substr(sha256(c_name || ':' || CAST(c_custkey AS VARCHAR)), 1, 16) AS id "
    "FROM customer"
)
def stable_id(t):
    return t.customer.select(
        "c_custkey", ids.stable_id(F.col("c_name"), F.col("c_custkey").cast("string")).alias("id")
    )


_DECORATED = (
    "'  ' || p_name || ' & Ça Coöp: ' || p_brand || ' / ' || p_type || ' -- ' || p_name || ' ' || "
    "p_name || '!'"
)
_FOLDED = (
    "trim(regexp_replace(strip_accents(lower({x})), '[^a-z0-9]+', '-', 'g'), '-')"
)


@proof(
    f"""WITH s AS (SELECT p_partkey, {_DECORATED} AS x FROM part)
    SELECT p_partkey, {_SLUG.format(x='x')} AS uncapped,
      coalesce(nullif(substr({_SLUG.format(x='x')}, 1, 48), ''), 'unknown') AS slug48,
      substr('fjr-' || {_SLUG.format(x='x')}, 1, 64) AS prefixed,
      regexp_matches(substr('fjr-' || {_SLUG.format(x='x')}, 1, 64), '^[a-z0-9][a-z0-9-]*$')
        AS valid
    FROM s"""
)
def slugify48(t):
    x = t.part.selectExpr("p_partkey", f"{_DECORATED} AS x")
    slug = ids.slugify_uncapped(F.col("x"))
    prefixed = ids.prefixed_slug("fjr-", slug)
    return x.select(
        "p_partkey", slug.alias("uncapped"), ids.slugify(F.col("x")).alias("slug48"),
        prefixed.alias("prefixed"), ids.is_slug(prefixed).alias("valid"),
    )


@proof(
    f"""WITH s AS (SELECT p_partkey, {_DECORATED} AS x FROM part)
    SELECT p_partkey, rtrim(substr({_FOLDED.format(x='x')}, 1, 60), '-') AS slug60 FROM s"""
)
def slugify60(t):
    x = t.part.selectExpr("p_partkey", f"{_DECORATED} AS x")
    return x.select("p_partkey", ids.path_slug(F.col("x")).alias("slug60"))


@proof(
    with_tables(
        f"""SELECT ingest_seq, company_slug || '/' ||
          coalesce(nullif(rtrim(substr({_FOLDED.format(x='title')}, 1, 60), '-'), ''), 'job')
          || '-' || substr(id, 1, 8) AS path FROM jobs"""
    )
)
def job_path(t):
    return t.jobs.select(
        "ingest_seq",
        ids.job_path(F.col("company_slug"), F.col("title"), F.col("id")).alias("path"),
    )


@proof(
    """WITH s AS (SELECT p_partkey, replace(p_name || ' ' || p_type, ' ', '-') AS x FROM part)
    SELECT p_partkey,
      array_to_string(list_transform(list_filter(string_split(x, '-'), lambda p: p <> ''),
        lambda p: upper(p[1]) || lower(p[2:])), ' ') AS company,
      upper(replace(x, '-', ' ')[1]) || lower(replace(x, '-', ' ')[2:]) AS title
    FROM s"""
)
def pretty_names(t):
    x = F.replace(F.concat_ws(" ", "p_name", "p_type"), F.lit(" "), F.lit("-"))
    return t.part.select(
        "p_partkey", ids.company_from_slug(x).alias("company"), ids.title_from_slug(x).alias("title")
    )


@proof(
    """SELECT event_id,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS iso_z,
      strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS iso_offset,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS epoch_s,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS epoch_ms,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS rfc822,
      CAST(NULL AS VARCHAR) AS junk,
      strftime(ts, '%d/%m/%Y') AS european,
      strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') AS rfc822_text
    FROM events"""
)
def timestamps(t):
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds(ts).cast("string")
    millis = F.unix_millis(ts).cast("string")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select(
        "event_id",
        stamp(times.iso_time(F.concat(iso, F.lit("Z")))).alias("iso_z"),
        stamp(times.iso_time(F.concat(iso, F.lit("+02:00")))).alias("iso_offset"),
        stamp(times.iso_or_epoch(seconds, millis="never")).alias("epoch_s"),
        stamp(times.iso_or_epoch(millis, millis="large")).alias("epoch_ms"),
        stamp(times.rfc822_time(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss Z"))).alias("rfc822"),
        stamp(times.iso_time(F.concat(F.lit("posted "), iso))).alias("junk"),
        times.european_date(F.col("ts")).alias("european"),
        times.rfc822_text(ts).alias("rfc822_text"),
    )


@proof(
    with_tables(
        f"""SELECT ingest_seq,
          CASE WHEN d IS NULL THEN '' WHEN d <= 0 THEN 'TODAY' WHEN d = 1 THEN '1D'
               WHEN d <= 7 THEN d || 'D' WHEN d <= 31 THEN CAST(floor(d / 7.0 + 0.5) AS BIGINT) || 'W'
               ELSE CAST(floor(d / 30.0 + 0.5) AS BIGINT) || 'MO' END AS age,
          coalesce(d <= 1, false) AS is_new,
          CASE remote_policy WHEN 'remote-global' THEN 'REMOTE-WW' WHEN 'remote-eu' THEN 'REMOTE-EU'
               WHEN 'remote' THEN 'REMOTE' WHEN 'hybrid' THEN 'HYBRID' ELSE '' END AS remote
        FROM (SELECT *, CASE WHEN posted_at <= {NOW} THEN
                CAST(floor((epoch({NOW}) - epoch(posted_at)) / 86400) AS BIGINT) END AS d FROM jobs)"""
    )
)
def age_labels(t):
    return t.jobs.select(
        "ingest_seq",
        times.age_label(F.col("posted_at"), now()).alias("age"),
        times.is_new(F.col("posted_at"), now()).alias("is_new"),
        C.remote_label(F.col("remote_policy")).alias("remote"),
    )


_ABS = {
    "root": "'/jobs/' || CAST(page_id AS VARCHAR)",
    "bare": "'jobs/' || CAST(page_id AS VARCHAR)",
    "proto": "'//boards.greenhouse.io/x/' || CAST(page_id AS VARCHAR)",
    "full": "'https://other.test/' || CAST(page_id AS VARCHAR)",
}
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_ROOT = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


@proof(
    f"""SELECT page_id, {_ROOT} || {_ABS['root']} AS root, {_ROOT} || '/' || {_ABS['bare']} AS bare,
      'https:' || {_ABS['proto']} AS proto, {_ABS['full']} AS full,
      array_to_string(string_split({_HOST}, '.')[-2:], '.') AS domain,
      true AS own_ok, true AS board_ok, false AS other_ok, false AS relative_ok
    FROM pages"""
)
def absolute_urls(t):
    p = t.pages.select("page_id", "url").selectExpr(
        "*", *[f"{e.replace('VARCHAR', 'STRING')} AS {n}" for n, e in _ABS.items()]
    )
    url, domain = F.col("url"), urls.registrable_domain(F.col("url"))
    full = {n: urls.absolute_url(F.col(n), url) for n in _ABS}
    return p.select(
        "page_id", *[c.alias(n) for n, c in full.items()], domain.alias("domain"),
        urls.plausible_job_url(full["root"], domain).alias("own_ok"),
        urls.plausible_job_url(full["proto"], domain).alias("board_ok"),
        urls.plausible_job_url(full["full"], domain).alias("other_ok"),
        urls.plausible_job_url(F.col("root"), domain).alias("relative_ok"),
    )


# The tag rules again, as this side states them; RE2 runs them in this order.
_TAG_RULES = [
    ("(?is)<script\\b.*?</script>", "''"), ("(?is)<style\\b.*?</style>", "''"), ("(?s)<!--.*?-->", "''"),
    ("(?is)<head\\b.*?</head>", "''"), ("(?i)<!doctype[^>]*>", "''"), ("[ \\t\\r\\n]+", "' '"),
    ("(?i) ?<br ?/?> ?", "'  ' || chr(10)"),
    *[(f"(?i)<h{n}\\b[^>]*>\\s*", f"chr(10) || chr(10) || '{'#' * n} '") for n in range(1, 7)],
    ("(?i)\\s*</h[1-6]>\\s*", "chr(10) || chr(10)"),
    *[(f"(?i)</?{tag}\\b[^>]*>", "chr(10) || chr(10)")
      for tag in ("ul", "ol", "p", "div", "section", "article", "table", "tr", "blockquote")],
    ("(?i)<li\\b[^>]*>\\s*", "chr(10) || '* '"), ("(?i)</?(?:b|strong)\\b[^>]*>", "'**'"),
    ("(?i)</?(?:i|em)\\b[^>]*>", "'*'"),
    ('(?i)<a\\b[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>', "'[\\2](\\1)'"), ("(?i)\\s*</li>", "''"), ("<[^>]+>", "''"),
]
_ENTITY_RULES = [("&nbsp;", "' '"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"),
                 ("&apos;", "chr(39)"), ("&amp;", "'&'")]
# Long pages, pages of blank lines and of empty paragraphs, with text behind them.
_LONG_PAGE = ("CASE page_id % 25 WHEN 3 THEN html || repeat('<br>', 100000) || '<p>end</p>' "
              "WHEN 4 THEN html || repeat('<p></p>', 100000) || 'end' "
              "WHEN 5 THEN html || repeat('word ', 8000) || '<h2>end</h2>' ELSE html END")


def _html_sql() -> str:
    out = _LONG_PAGE
    for pattern, repl in _TAG_RULES:
        out = f"regexp_replace({out}, {rx(pattern)}, {repl}, 'g')"
    for entity, char in _ENTITY_RULES:
        out = f"replace({out}, '{entity}', {char})"
    out = f"regexp_replace({out}, '[ \\t]*\\n([ \\t]*\\n)+', chr(10) || chr(10), 'g')"
    return f"trim({out}, ' ' || chr(9) || chr(10) || chr(13))"


@proof(f"SELECT page_id, {_html_sql()} AS markdown FROM pages")
def html_text(t):
    pages = t.pages.select("page_id", F.expr(_LONG_PAGE).alias("html"))
    return pages.select("page_id", text.page_text(F.col("html")).alias("markdown"))


_HEADED = (
    "substr(text, 1, CAST(FLOOR(length(text) / 2) AS INT)) || chr(10) || '## About us' || chr(10) || "
    "'We hire. ' || lang || chr(10) || '## Role' || chr(10) || 'Great BENEFITS here' || chr(10) "
    "|| '## Stack ' || source || chr(10) || substr(text, CAST(FLOOR(length(text) / 2) AS INT) + 1)"
)


def _boilerplate_sql(column: str) -> str:
    out = column
    for trigger in V.BOILERPLATE_TRIGGERS:
        groups = trigger.count("(") - trigger.count("(?:")
        out = (
            f"regexp_replace({out}, '(?ism){trigger}.*?(^##|\\z)', '\\{groups + 1}', 'g')"
        )
    return f"trim({out}, ' ' || chr(9) || chr(10) || chr(13))"


@proof(
    f"""WITH d AS (SELECT doc_id, {_HEADED} AS body FROM documents)
    SELECT doc_id, {_boilerplate_sql('body')} AS stripped FROM d"""
)
def strip_boilerplate(t):
    body = t.documents.selectExpr("doc_id", f"{_HEADED} AS body")
    return body.select("doc_id", text.strip_boilerplate(F.col("body")).alias("stripped"))


_TERMS = ["Python", "the", "DER", "tion", "Éen", "que", "Kubernetes", "las"]


@proof(
    f"""SELECT doc_id, coalesce(array_to_string(list_filter([{', '.join(rx(w) for w in _TERMS)}],
      lambda w: contains(lower(text), lower(w))), ','), '') AS terms FROM documents"""
)
def grounded_terms(t):
    values = F.array(*[F.lit(w) for w in _TERMS])
    return t.documents.select(
        "doc_id", F.array_join(text.grounded(values, F.col("text")), ",").alias("terms")
    )


# In some documents the brand stands behind 200,000 letters.
_FAR_BRAND = "CASE doc_id % 40 WHEN 7 THEN text || repeat('x', 210000) || source || ' ' || lang ELSE text END"


@proof(
    "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') AS safe, "
    "contains(regexp_replace(lower(text), '[^a-z]', '', 'g'), "
    f"regexp_replace(lower(source || lang), '[^a-z]', '', 'g')) AS brand FROM (SELECT * REPLACE ({_FAR_BRAND} AS text) FROM documents)"
)
def ascii_and_brand(t):
    docs = t.documents.withColumn("text", F.expr(_FAR_BRAND))
    return docs.select(
        "doc_id", text.ascii_safe(F.col("text")).alias("safe"),
        text.brand_in_body(F.concat("source", "lang"), F.col("text")).alias("brand"),
    )


_BAND_IN = f"""SELECT p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN '-5'
    ELSE CAST(CAST(FLOOR(p_retailprice) AS BIGINT) * 10 AS STRING) END AS low,
  CASE p_partkey % 5 WHEN 0 THEN NULL ELSE CAST(CAST(FLOOR(p_retailprice) AS BIGINT) * 20 AS STRING) END AS high,
  {pick('p_partkey', [' eur', 'GBP', 'usd', 'PLN', 'XYZ', None])} AS ccy,
  {pick('p_partkey', ['year', ' Month ', 'day', 'hour', 'decade', None, 'YEAR'])} AS per,
  CASE p_partkey % 3 WHEN 0 THEN 'pays € well' WHEN 1 THEN 'no hint' ELSE
    'from ' || CAST(CAST(FLOOR(p_retailprice) AS BIGINT) * 10 AS STRING) END AS body"""


@proof(
    f"""WITH r AS ({_BAND_IN} FROM part),
    n AS (SELECT *, coalesce(TRY_CAST(low AS DOUBLE), TRY_CAST(high AS DOUBLE)) AS lo,
                 coalesce(TRY_CAST(high AS DOUBLE), TRY_CAST(low AS DOUBLE)) AS hi,
                 upper(trim(ccy)) AS c, lower(trim(per)) AS p, lower(body) AS b FROM r),
    v AS (SELECT *, coalesce(lo > 0 AND hi > 0 AND hi >= lo
      AND c IN ('EUR','GBP','USD','PLN','CHF','SEK','DKK','NOK','CZK','HUF','RON','BGN')
      AND p IN ('year','month','day','hour')
      AND (contains(b, lower(c)) OR contains(b, CASE c WHEN 'EUR' THEN '€' WHEN 'GBP' THEN '£'
             WHEN 'USD' THEN '$' ELSE '' END)
           OR contains(b, substr(CAST(CAST(floor(lo) AS BIGINT) AS VARCHAR), 1, 3))
           OR contains(b, substr(CAST(CAST(floor(hi) AS BIGINT) AS VARCHAR), 1, 3))
           OR contains(b, 'salary') OR contains(b, 'compensation')), false) AS ok FROM n)
    SELECT p_partkey, ok, CASE WHEN ok THEN lo END AS salary_min, CASE WHEN ok THEN hi END AS salary_max,
      CASE WHEN ok THEN c END AS currency, CASE WHEN ok THEN p END AS period FROM v"""
)
def salary_normalise(t):
    rows = t.sql(_BAND_IN + " FROM {part}", part=t.part)
    s = money.canonical_band(*[F.col(c) for c in ("low", "high", "ccy", "per", "body")])
    return rows.select("p_partkey", s.alias("s")).select(
        "p_partkey", F.col("s").isNotNull().alias("ok"), F.col("s.min").alias("salary_min"),
        F.col("s.max").alias("salary_max"), F.col("s.currency").alias("currency"),
        F.col("s.period").alias("period"),
    )


_LABEL_IN = f"""SELECT p_partkey,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(CAST(FLOOR(p_retailprice) AS BIGINT) * (1 + p_partkey % 90) / 2 AS DOUBLE) END AS lo,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(CAST(FLOOR(p_retailprice) AS BIGINT) * (1 + p_partkey % 90) AS DOUBLE) END AS hi,
  {pick('p_partkey', ['EUR', 'GBP', 'USD', 'PLN', 'SEK', 'HUF', '', None])} AS ccy,
  {pick('p_partkey', PERIODS)} AS per"""
_K = (
    "CASE WHEN {x} >= 1000 THEN CAST(CAST(floor({x} / 1000 + 0.5) AS BIGINT) AS VARCHAR) || 'k' "
    "WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"
)


@proof(
    f"""WITH r AS ({_LABEL_IN} FROM part)
    SELECT p_partkey, CASE WHEN coalesce(ccy, '') = '' OR (lo IS NULL AND hi IS NULL) THEN '' ELSE
      CASE ccy WHEN 'EUR' THEN '€' WHEN 'GBP' THEN '£' WHEN 'USD' THEN '$' WHEN 'PLN' THEN 'zł'
        WHEN 'SEK' THEN 'kr' ELSE ccy || ' ' END
      || CASE WHEN lo IS NOT NULL AND hi IS NOT NULL AND lo <> hi
              THEN {_K.format(x='lo')} || '–' || {_K.format(x='hi')}
              ELSE {_K.format(x='coalesce(lo, hi)')} END
      || CASE per WHEN 'month' THEN '/mo' WHEN 'day' THEN '/d' WHEN 'hour' THEN '/h' ELSE '' END END
      AS label FROM r"""
)
def salary_label(t):
    rows = t.sql(_LABEL_IN + " FROM {part}", part=t.part)
    return rows.select(
        "p_partkey",
        money.salary_label(*[F.col(c) for c in ("lo", "hi", "ccy", "per")]).alias("label"),
    )


_ANSWER = f"""SELECT event_id, event_type || ' at 12{{{{x}}}} salary python' AS body, {{json}} AS answer"""
_ROLES_IN = [" Engineer ", "SALES", "pm", "wizard", None, "ml/ai", "hr", "DevOps"]
_SEN_IN = ["Senior", "lead", " mid", None, "EXEC"]
_REMOTE_IN = ["Remote-EU", "everywhere", "hybrid ", None]
_VISA_IN = ["true", "false", '"yes"', "null", "1"]


def _json_sql(quote: str) -> str:
    def field(name: str, index: str, values: list[str | None]) -> str:
        raw = ["null" if v is None else f'"{v}"' for v in values]
        return f"""'"{name}": ' || {pick(index, raw)}"""

    visa = f"""'"visa_sponsorship": ' || {pick('event_id', _VISA_IN)}"""
    return (
        "'{' || " + field("role_family", "event_id", _ROLES_IN) + " || ', ' || "
        + field("seniority", "event_id", _SEN_IN) + " || ', ' || "
        + field("remote_policy", "event_id", _REMOTE_IN) + " || ', ' || " + visa
        + """ || ', "stack": ["Python", "' || event_type || '", "Rust", ""]' """
        + """ || ', "salary_min": ' || CAST(event_id + 1 AS STRING) """
        + """ || ', "salary_currency": "EUR", "salary_period": "year"}'"""
    )


_ANSWERS = (
    f"SELECT event_id, event_type || ' work, salary shown, python' AS body, {_json_sql('')} AS answer"
)
_SYN = " ".join(f"WHEN {rx(k)} THEN {rx(v)}" for k, v in V.ROLE_SYNONYMS.items())
_ALLOWED = ", ".join(rx(v) for v in V.ROLE_FAMILIES)


@proof(
    f"""WITH a AS ({_ANSWERS} FROM events),
    j AS (SELECT event_id, lower(body) AS b, json(answer) AS j FROM a),
    f AS (SELECT event_id, b, lower(trim(j->>'role_family')) AS rf, lower(trim(j->>'seniority')) AS sn,
            lower(trim(j->>'remote_policy')) AS rp, json_type(j, '$.visa_sponsorship') AS vt,
            j->>'visa_sponsorship' AS v, CAST(j->'stack' AS VARCHAR[]) AS st,
            CAST(j->>'salary_min' AS DOUBLE) AS smin FROM j)
    SELECT event_id, CASE WHEN rf IN ({_ALLOWED}) THEN rf ELSE CASE rf {_SYN} END END AS role_family,
      CASE WHEN sn IN ('intern','junior','mid','senior','staff','principal','exec') THEN sn END AS seniority,
      CASE WHEN rp IN ('onsite','hybrid','remote','remote-eu','remote-global') THEN rp END AS remote_policy,
      CASE WHEN vt = 'BOOLEAN' THEN v = 'true' END AS visa,
      array_to_string(list_filter(st, lambda x: x <> '' AND contains(b, lower(x))), ',') AS stack,
      smin AS salary_min FROM f"""
)
def response_normalise(t):
    rows = t.sql(_ANSWERS.replace("{", "{{").replace("}", "}}") + " FROM {events}", events=t.events)
    fields = tagging.normalised_answer(F.col("a"), F.col("body"))
    return rows.withColumn("a", tagging.parse_answer(F.col("answer"))).select(
        "event_id", fields["role_family"].alias("role_family"),
        fields["seniority"].alias("seniority"), fields["remote_policy"].alias("remote_policy"),
        fields["visa_sponsorship"].alias("visa"),
        F.array_join(fields["stack"], ",").alias("stack"),
        fields["salary"]["min"].alias("salary_min"),
    )


_P = tagging.VARIANTS
_LONG_TURN = "CASE WHEN turn = 0 AND text <> '' THEN text || repeat(' more', 2000) ELSE text END"


@proof(
    "SELECT conv_id, turn, " + ", ".join(
        f"{rx(v.instructions)} || 'Title: ' || role || chr(10) || chr(10) || 'Description:' || chr(10) || "
        f"CASE WHEN coalesce(text, '') = '' THEN {rx(v.empty_description)} "
        f"ELSE text END AS {n}" for n, v in _P.items()
    ) + f" FROM (SELECT * REPLACE ({_LONG_TURN} AS text) FROM conversations)"
)
def prompt_rows(t):
    turns = t.conversations.withColumn("text", F.expr(_LONG_TURN))
    return turns.select(
        "conv_id", "turn",
        *[
            tagging.messages(n, F.col("role"), F.col("text"))[1]["content"].alias(n) for n in _P
        ],
    )


_PLACES = [
    "Paris, France", "greater London area", "Berlin", "Nowhere", "", "Zürich HQ", "Remote UK",
    "Czech lands", "oslo", "Riga, Latvia", "Helsinki and Oslo",
]
_INDUSTRIES = ["retail,B2B", "AI,Data", "aiming high", "Machine tools", "html", "fintech", ""]
_PLACE_CASE = " ".join(
    f"WHEN contains(place, {rx(k)}) THEN {rx(v)}" for k, v in V.PLACE_TO_CODE.items()
)
_EU_ANY = " OR ".join(f"contains(lower(place || ' ' || s_name), {rx(w)})" for w in V.EU_COMPANY_WORDS)


@proof(
    f"""WITH s AS (SELECT *, {pick('s_suppkey', _PLACES)} AS place,
      {pick('s_suppkey', _INDUSTRIES)} AS ind FROM supplier)
    SELECT s_suppkey, CASE {_PLACE_CASE} ELSE 'XX' END AS code,
      CASE WHEN regexp_matches(lower(ind), 'ai|ml|machine') THEN 'ai' ELSE 'tech' END AS category,
      ({_EU_ANY}) AS eu,
      CASE WHEN {pick('s_nationkey', ['FR', 'ZZ', '', None])} IN ('FR') THEN 'France'
           ELSE coalesce(nullif({pick('s_nationkey', ['FR', 'ZZ', '', None])}, ''), '—') END AS country
    FROM s"""
)
def country_from_text(t):
    s = t.supplier.selectExpr(
        "*", f"{pick('s_suppkey', _PLACES)} AS place", f"{pick('s_suppkey', _INDUSTRIES)} AS ind",
        f"{pick('s_nationkey', ['FR', 'ZZ', '', None])} AS code_in",
    )
    return s.select(
        "s_suppkey", C.country_of_text(F.col("place")).alias("code"),
        C.startup_category(F.split("ind", ",")).alias("category"),
        C.eu_company(F.col("place"), F.col("s_name")).alias("eu"),
        C.country_name(F.col("code_in")).alias("country"),
    )


_BOARD_URLS = [
    ("https://boards.greenhouse.io/", "acme{n}/jobs/1", "greenhouse", "acme{n}"),
    ("https://jobs.lever.co/", "acme{n}", "lever", "acme{n}"),
    ("https://jobs.ashbyhq.com/", "acme{n}/x", "ashby", "acme{n}"),
    ("https://acme{n}.ashbyhq.com/", "", "ashby", "acme{n}"),
    ("https://apply.workable.com/", "acme{n}/", "workable", "acme{n}"),
    ("https://acme{n}.workable.com/", "j/1", "workable", "acme{n}"),
    ("https://careers.smartrecruiters.com/", "Acme{n}", "smartrecruiters", "Acme{n}"),
    ("https://acme{n}.recruitee.com/", "o/dev", "recruitee", "acme{n}"),
    ("https://acme{n}.jobs.personio.de/", "", "personio", "acme{n}"),
    ("https://acme{n}.jobs.personio.com", "", "personio", "acme{n}"),
    ("https://boards.greenhouse.io", "", None, None),
]


def _n(template: str) -> str:
    return " || ".join(
        f"'{p}'" if p != "#" else "CAST(page_id AS STRING)"
        for p in template.replace("{n}", "\x00#\x00").split("\x00") if p
    ) or "''"


_URL_CASE = "CASE page_id % 12 " + " ".join(
    f"WHEN {i} THEN {_n(a + b)}" for i, (a, b, _, _) in enumerate(_BOARD_URLS)
) + " ELSE url END"
_PROVIDER_CASE = "CASE page_id % 12 " + " ".join(
    f"WHEN {i} THEN {rx(p)}" for i, (_, _, p, _) in enumerate(_BOARD_URLS)
) + " END"
_HANDLE_CASE = "CASE page_id % 12 " + " ".join(
    f"WHEN {i} THEN {_n(h) if h else 'NULL'}" for i, (_, _, _, h) in enumerate(_BOARD_URLS)
) + " END"


@proof(f"SELECT page_id, {_PROVIDER_CASE} AS provider, {_HANDLE_CASE} AS handle FROM pages")
def url_provider(t):
    found = t.pages.selectExpr("page_id", f"{_URL_CASE} AS u").withColumn(
        "b", urls.board_of(F.col("u"))
    )
    return found.select("page_id", "b.provider", "b.handle")


_WD = """CASE page_id % 4
  WHEN 0 THEN 'https://Acme' || CAST(page_id AS STRING) || '.wd3.myworkdayjobs.com/en-US/Careers/job/1'
  WHEN 1 THEN 'https://acme' || CAST(page_id AS STRING) || '.wd5.myworkdayjobs.com/wday/cxs/acme/Ext/jobs'
  WHEN 2 THEN 'https://plain.test/de/Site'
  ELSE url END"""
_WD_BODY = """CASE page_id % 4
  WHEN 1 THEN 'x cxs/acme' || CAST(page_id AS STRING) || '/Portal_1/jobs y'
  WHEN 2 THEN 'see https://other' || CAST(page_id AS STRING) || '.wd1.myworkdayjobs.com now' ELSE '' END"""


@proof(
    """SELECT page_id,
      CASE page_id % 4 WHEN 2 THEN 'other' || page_id WHEN 3 THEN NULL ELSE 'acme' || page_id END AS tenant,
      CASE page_id % 4 WHEN 0 THEN 'wd3' WHEN 1 THEN 'wd5' WHEN 2 THEN 'wd1' END AS cluster,
      CASE page_id % 4 WHEN 0 THEN 'Careers' WHEN 1 THEN 'Portal_1' WHEN 2 THEN 'Site' END AS site
    FROM pages"""
)
def workday_site(t):
    p = t.pages.selectExpr("page_id", f"{_WD} AS u", f"{_WD_BODY} AS body")
    return p.withColumn("w", urls.workday_site(F.col("u"), F.col("body"))).select(
        "page_id", "w.tenant", "w.cluster", "w.site"
    )


_HANDLE = """CASE s_suppkey % 3
  WHEN 0 THEN 'https://c.test/api/jobs?q=' || CAST(s_suppkey AS STRING) || '&_phenom_countries=Germany,United%20Kingdom, France'
  WHEN 1 THEN 'https://c.test/api/jobs?_phenom_countries=Spain'
  ELSE 'https://c.test/api/jobs?q=1' END"""


@proof(
    """SELECT s_suppkey, u AS url FROM (SELECT s_suppkey, unnest(CASE s_suppkey % 3
      WHEN 0 THEN ['https://c.test/api/jobs?q=' || s_suppkey || '&country=Germany',
                   'https://c.test/api/jobs?q=' || s_suppkey || '&country=United%20Kingdom',
                   'https://c.test/api/jobs?q=' || s_suppkey || '&country=France']
      WHEN 1 THEN ['https://c.test/api/jobs?country=Spain']
      ELSE ['https://c.test/api/jobs?q=1'] END) AS u FROM supplier)"""
)
def country_fanout(t):
    s = t.supplier.selectExpr("s_suppkey", f"{_HANDLE} AS handle")
    return s.select("s_suppkey", F.explode(urls.country_requests(F.col("handle"))).alias("url"))


@proof(
    """WITH l AS (SELECT doc_id, '[' || source || ' ' || lang || '](https://site-' || doc_id ||
       '.test/a) text [gh](https://github.com/x) [' || source || '](https://b.test/p#frag) [y ](http://c.test/' || lang || ')' AS md
       FROM documents)
    SELECT doc_id, substr(md, 2, strpos(md, ']') - 2) AS name, 'https://site-' || doc_id || '.test/a' AS url FROM l
    UNION ALL SELECT l.doc_id, 'y' AS name, 'http://c.test/' || d.lang AS url FROM l JOIN documents d USING (doc_id)"""
)
def markdown_links(t):
    md = F.concat(
        F.lit("["), F.concat_ws(" ", "source", "lang"), F.lit("](https://site-"), "doc_id",
        F.lit(".test/a) text [gh](https://github.com/x) ["), "source",
        F.lit("](https://b.test/p#frag) [y ](http://c.test/"), "lang", F.lit(")"),
    )
    return t.documents.select("doc_id", F.explode(text.markdown_links(md)).alias("l")).select(
        "doc_id", "l.name", "l.url"
    )


_COMMENT = """CASE s_suppkey % 5 WHEN 0 THEN '<p>' || s_name || ' | Engineer</p>'
  WHEN 1 THEN 'We - hiring' WHEN 2 THEN 'lower case start | x'
  WHEN 3 THEN '<b>Acme  Co.</b> — remote' ELSE 'X| y' END"""


@proof(
    """SELECT s_suppkey, CASE s_suppkey % 5 WHEN 3 THEN 'Acme Co' END AS name FROM supplier"""
)
def leading_name(t):
    s = t.supplier.selectExpr("s_suppkey", f"{_COMMENT} AS c")
    return s.select("s_suppkey", text.leading_name(F.col("c")).alias("name"))


_LANGS = ["Python", "COBOL", None, "Rust"]


@proof(
    f"""SELECT s_suppkey, coalesce(stars, 0) >= 100 AND coalesce(lang IN ('Python', 'Rust'), false) AS oss_signal
    FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_acctbal AS BIGINT) END AS stars,
          {pick('s_suppkey', _LANGS)} AS lang FROM supplier)"""
)
def oss_signal(t):
    s = t.supplier.selectExpr(
        "s_suppkey",
        "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_acctbal AS BIGINT) END AS stars",
        f"{pick('s_suppkey', _LANGS)} AS lang",
    )
    return s.select("s_suppkey", C.oss_signal(F.col("stars"), F.col("lang")).alias("oss_signal"))


_ROW = f"""SELECT c_custkey,
  {pick('c_custkey', ['ok-slug', 'Bad Slug', '-x', 'a'])} AS slug,
  {pick('c_custkey', ['N', None, 'M'])} AS name,
  {pick('c_custkey', ['FR', 'FRA', None, 'XX', 'DE'])} AS country,
  {pick('c_custkey', ['tech', 'ai', 'nope'])} AS cats,
  {pick('c_custkey', ['lever', None, 'fax', 'ashby'])} AS ats_provider,
  {pick('c_custkey', ['h', None, '', 'h2', None])} AS ats_handle,
  {pick('c_custkey', [None, 'https://c.test', None])} AS career_url,
  {pick('c_custkey', ['seed', None, 'series-z'])} AS funding_stage,
  {pick('c_custkey', ['1-10', None, 'huge'])} AS size_bucket"""


@proof(
    f"""WITH r AS ({_ROW} FROM customer)
    SELECT c_custkey, array_to_string(list_filter([
      CASE WHEN NOT regexp_matches(slug, '^[a-z0-9][a-z0-9-]*$') THEN 'slug' END,
      CASE WHEN name IS NULL THEN 'name' END,
      CASE WHEN country IS NULL OR length(country) <> 2 THEN 'country' END,
      CASE WHEN cats NOT IN ('ai','tech','oss','remote-eu','research') THEN 'categories' END,
      CASE WHEN (ats_provider IS NULL) <> (ats_handle IS NULL)
             OR ats_provider IN ('fax') OR ats_handle = '' THEN 'ats' END,
      CASE WHEN funding_stage = 'series-z' THEN 'funding_stage' END,
      CASE WHEN size_bucket = 'huge' THEN 'size_bucket' END,
      CASE WHEN (ats_provider IS NULL OR ats_handle IS NULL) AND career_url IS NULL THEN 'source' END
      ], lambda x: x IS NOT NULL), ',') AS problems FROM r"""
)
def validate_rows(t):
    r = t.sql(_ROW + " FROM {customer}", customer=t.customer).withColumns(
        {"categories": F.array("cats"), "industry_tags": F.array().cast("array<string>")}
    )
    return r.select(
        "c_custkey", F.array_join(validation.company_violations(), ",").alias("problems")
    )
