"""Bindings of operators to the given tables, each with its check SQL.

``jobs`` and ``companies`` are derived row by row from ``orders`` and
``customer`` by one SQL text both engines run; only the operator under test is
written twice.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.functions.ids import stable_id
from vacantia.session import shared_dir

NOW = "TIMESTAMP '2001-07-20 06:00:00'"

TITLES = [
    "Senior Data Engineer", "Machine Learning Engineer", "Recruiter", "Account Executive",
    "Product Manager", "UX Designer", "Backend Developer", "Barista", "Massage Therapist",
    "Acheteur mode", "Chef de produit junior", "Head of Sourcing", "Category Manager",
    "Marketing Intern", "Werkstudent Software", "Freelance Illustrator", "Office Coordinator",
    "Legal Counsel", "Customer Support Specialist", "Research Scientist", "Tax Manager",
    "Data Analyst (remote, EU)", "Fully remote Writer", "DevOps hybrid 2 days", "On-site Technician",
    "Sous chef", "Truck Driver", "Alternance acheteur", "Merchandiser", "SRE", "CTO",
    "Product Marketing Lead", "Bi Analyst", "FP&A Partner", "Remote Sales", "Gardener", "",
    "Assistante achats", "Chief of Staff", "Contract Lawyer",
]
LOCATIONS = [
    "Paris, France", "Berlin, Germany", "London", "San Francisco, CA", "New York, NY", "Remote",
    "Remote — Europe", "Anywhere in the World", "Leipzig, DE", "Berlin, DE", "Toronto, Canada",
    "Bengaluru, India", "Lisbon, Portugal", "", None, "Austin, Texas", "Kraków", "Warsaw, Poland",
    "Remote - Worldwide", "EMEA", "Zürich", "München", "MÜNCHEN, Bayern", "Tallinn, EE",
    "Venice, Italy", "Nice", "Hybrid", "Singapore", "Tokyo, Japan", "Madrid / Barcelona",
    "Den Haag", "United Kingdom", "United States", "Remote US", "Cape Town", "Stockholm, SE",
    "remote - eu", "Chicago, IL or London", "Hannover", "Sao Paulo, BR", "  Office, xx ",
]
SOURCES = [
    "greenhouse", "lever", "ashby", "remoteok", "weworkremotely", "justjoinit", "wttj",
    "workday", "bof",
]
COUNTRIES = [
    "FR", "DE", "GB", "ES", "IT", "NL", "BE", "SE", "DK", "FI", "NO", "IE", "PT", "PL", "CZ",
    "AT", "CH", "EE", "LT", "LV", "US", "CA", "XX", "IL", "UA",
]
CURRENCIES = ["EUR", "GBP", "USD", "PLN", "CHF", "eur", "JPY", None]
PERIODS = ["year", "month", "day", "hour", "week", None]


def lit(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(index: str, values: list[str | None]) -> str:
    """``CASE`` choosing ``values[index % len]``; valid in both engines."""
    arms = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {arms} END"


def slug_sql(key: str) -> str:
    return (
        f"CASE {key} % 11 WHEN 0 THEN 'via-remoteok-' WHEN 1 THEN 'wttjc-' WHEN 2 THEN 'fjr-' "
        f"ELSE 'co-' END || CAST({key} AS STRING)"
    )


COMPANIES_SQL = f"""
SELECT {slug_sql('c_custkey')} AS slug,
       CASE WHEN c_custkey % 29 = 5 THEN NULL
            WHEN c_custkey % 13 = 4 THEN {slug_sql('c_custkey')}
            ELSE c_name END AS name,
       {pick('c_nationkey', COUNTRIES)} AS country,
       CASE WHEN c_custkey % 11 IN (1, 2) THEN 'fashion,home' ELSE '' END AS tags,
       c_acctbal, c_mktsegment, c_custkey
FROM {{customer}}
"""
JOBS_SQL = f"""
SELECT o_orderkey AS ingest_seq,
       {slug_sql('o_custkey')} AS company_slug,
       {pick('o_orderkey', TITLES)} AS title,
       'https://jobs.example.org/p/' || CAST(
         CASE WHEN o_orderkey % 10 IN (3, 4, 5) THEN o_orderkey - o_orderkey % 10 + 3
              ELSE o_orderkey END AS STRING) AS url,
       {pick('o_orderkey * 7 + o_custkey', LOCATIONS)} AS location,
       {pick('o_orderkey + o_custkey', ['remote-global', 'remote-eu', 'remote', 'hybrid', 'onsite',
                                        '', None, None, None, None, None, None, None])}
         AS remote_policy,
       {pick('o_orderkey * 3', ['senior', 'mid', 'junior', None, None, None, None])} AS seniority,
       {pick('o_orderkey * 5 + o_custkey', ['engineering', 'data', 'sales', 'other', '', None, None,
                                            None, None, None, None])} AS role_family,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS salary_min,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice * 2 - 90000 END AS salary_max,
       {pick('o_orderkey', CURRENCIES)} AS salary_currency,
       {pick('o_orderkey + 1', PERIODS)} AS salary_period,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS posted_at,
       TIMESTAMP '2002-01-01 00:00:00' AS scraped_at,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority || ' opening, ' || o_orderstatus ||
         ' hiring round for a growing team in this field' END AS description_md,
       {pick('o_orderkey + o_orderkey % 2', SOURCES)} AS source,
       CASE {pick('o_orderkey + o_orderkey % 2', SOURCES)}
         WHEN 'remoteok' THEN 1 WHEN 'weworkremotely' THEN 2 WHEN 'justjoinit' THEN 3
         WHEN 'wttj' THEN 4 WHEN 'bof' THEN 7 ELSE 0 END AS source_rank,
       o_orderstatus, o_custkey
FROM {{orders}}
"""
ID_SQL = "substr(sha256(company_slug || ':' || url), 1, 16)"


def with_tables(sql: str, **more: str) -> str:
    """Check SQL with ``companies`` and ``jobs`` (with ``id``) in scope."""
    jobs = JOBS_SQL.format(orders="orders")
    parts = {
        "companies": COMPANIES_SQL.format(customer="customer"),
        "jobs0": jobs,
        "jobs": f"SELECT *, {ID_SQL} AS id FROM jobs0",
        **more,
    }
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {ctes}\n{sql}"


class Tables:
    """Lazy access to one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **frames)

    @cached_property
    def jobs(self) -> DataFrame:
        rows = self.spark.sql(JOBS_SQL, orders=self.orders)
        return rows.withColumn("id", stable_id(F.col("company_slug"), F.col("url")))

    @cached_property
    def companies(self) -> DataFrame:
        rows = self.spark.sql(COMPANIES_SQL, customer=self.customer)
        return rows.withColumn("industry_tags", F.split("tags", ","))


@dataclass(frozen=True)
class Proof:
    build: Callable[[Tables], DataFrame]
    oracle: str | None


PROOFS: dict[str, Proof] = {}


def proof(oracle: str | None = None, name: str | None = None):
    """Register a query under its function name, with the SQL that must agree."""
    def add(fn: Callable[[Tables], DataFrame]):
        PROOFS[name or fn.__name__] = Proof(fn, oracle)
        return fn

    return add


def rx(pattern: str) -> str:
    """Pattern as a SQL literal."""
    return lit(pattern)


def now():
    return F.expr(NOW)


def stamp(col, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(col, fmt)


def stamp_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


_WRITTEN: dict[tuple[str, str, str], str] = {}


def written_once(t: Tables, name: str, build: Callable[[str], None]) -> str:
    """Folder of stored tables that several queries of a session read, written by the first."""
    place = (t.spark.sparkContext.applicationId, t.folder, name)
    if place not in _WRITTEN:
        root = f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"
        build(root)
        _WRITTEN[place] = root
    return _WRITTEN[place]
