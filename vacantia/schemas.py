"""Declared schemas of every table at rest (never inferred)."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_STRING, _DOUBLE, _BOOL = T.StringType(), T.DoubleType(), T.BooleanType()
_INT, _LONG, _TIME, _DATE = T.IntegerType(), T.LongType(), T.TimestampType(), T.DateType()
_STRINGS = T.ArrayType(_STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


JOBS = _struct(
    id=_STRING, company_slug=_STRING, title=_STRING, url=_STRING, location=_STRING,
    countries=_STRINGS, remote_policy=_STRING, seniority=_STRING, role_family=_STRING,
    salary_min=_DOUBLE, salary_max=_DOUBLE, salary_currency=_STRING, salary_period=_STRING,
    visa_sponsorship=_BOOL, languages=_STRINGS, stack=_STRINGS, posted_at=_TIME,
    scraped_at=_TIME, description_md=_STRING, source=_STRING,
)
COMPANIES = _struct(
    slug=_STRING, name=_STRING, country=_STRING, categories=_STRINGS, industry_tags=_STRINGS,
    ats_provider=_STRING, ats_handle=_STRING, career_url=_STRING, github_org=_STRING,
    funding_stage=_STRING, size_bucket=_STRING, notes=_STRING, oss_signal=_BOOL,
    top_repo_stars=_LONG, primary_language=_STRING,
)
PAYLOADS = _struct(
    source=_STRING, company_slug=_STRING, handle=_STRING, page=_INT, fetched_at=_TIME,
    body=_STRING,
)
RESULT = _struct(
    extractor=_STRING, company_slug=_STRING, success=_BOOL, job_count=_INT, duration_ms=_INT,
    error=_STRING,
)
RUN_METADATA = _struct(
    run_at=_TIME, pipeline_version=_STRING, company_count=_INT, job_count=_INT,
    extractor_results=T.ArrayType(RESULT),
)
RUN_LOG = T.StructType([T.StructField("snapshot_date", _DATE), *RESULT.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``; a column the input lacks is a typed null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
