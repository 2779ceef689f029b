"""Scans of stored snapshots and run metadata."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vacantia import schemas
from vacantia.operators.quality import flatten_runs
from vacantia.sinks import publish


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table under its declared schema; a missing path is an empty table."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return schemas.empty(spark, schema)
        raise
    return schemas.conform(stored, schema)


def _dated(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("snapshot_date", T.DateType())])


def _stored(schema: T.StructType) -> T.StructType:
    """With the columns that folders hold."""
    return T.StructType([*_dated(schema).fields, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])


def read_jobs(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """All published snapshots, or those of the named dates, with their ``snapshot_date``."""
    return _read(spark, root, "jobs", schemas.JOBS, dates)


def read_companies(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    return _read(spark, root, "companies", schemas.COMPANIES, dates)


def _read(spark: SparkSession, root: str, table: str, schema: T.StructType, dates: list[str] | None) -> DataFrame:
    stored = publish.read(spark, root, table, versions=dates, schema=_stored(schema))
    return schemas.empty(spark, _dated(schema)) if stored is None else schemas.conform(stored, _dated(schema))


def read_digests(spark: SparkSession, root: str, date: str) -> DataFrame:
    """Digests of the buckets of a snapshot; no rows where it has none."""
    stored = publish.read(spark, root, "digests", versions=[date])
    return spark.createDataFrame([], _DIGESTS) if stored is None else stored


_DIGESTS = "bucket int, n long, sum_0 decimal(38,0), sum_1 decimal(38,0), buckets int"


def read_buckets(spark: SparkSession, root: str, date: str, common: int, buckets: list[int]) -> DataFrame:
    """Jobs of a date whose bucket, counted modulo ``common``, is one of ``buckets``."""
    stored = publish.read(spark, root, "jobs", versions=[date], schema=_stored(schemas.JOBS))
    if stored is None:
        return schemas.empty(spark, schemas.JOBS)
    # A filter on folders: other buckets are not opened.
    return schemas.conform(stored.filter((F.col("bucket") % common).isin(buckets)), schemas.JOBS)


def dates(spark: SparkSession, root: str, table: str = "jobs") -> list[str]:
    """Published dates, oldest first; from the manifest, no table is listed or read."""
    return sorted(publish.published(spark, root, table))


def on_date(snapshots: DataFrame, date: str) -> DataFrame:
    return snapshots.filter(F.col("snapshot_date") == F.lit(date).cast("date")).drop("snapshot_date")


def latest(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest snapshot."""
    newest = snapshots.agg(F.max("snapshot_date")).scalar()
    return snapshots.filter(F.col("snapshot_date") == newest).drop("snapshot_date")


def read_run_log(spark: SparkSession, pattern: str) -> DataFrame:
    """Extractor results of every metadata document; the date is the folder it is under."""
    return _run_log(spark, [pattern])


def read_published_run_log(spark: SparkSession, root: str) -> DataFrame:
    """The same of the published runs below a snapshot root."""
    return _run_log(spark, publish.folders(spark, root, "metadata"))


def _run_log(spark: SparkSession, paths: list[str]) -> DataFrame:
    docs = schemas.empty(spark, schemas.RUN_METADATA).withColumn("__path", F.lit(""))
    if paths:
        docs = (
            spark.read.schema(schemas.RUN_METADATA).option("multiLine", True)
            .option("recursiveFileLookup", True).json(paths).withColumn("__path", F.col("_metadata.file_path"))
        )
    day = F.regexp_extract("__path", r"(\d{4}-\d{2}-\d{2})/(?:run=\w+/)?(?:part=\d+/)?[^/]*$", 1)
    dated = docs.withColumn("__day", day.cast("date"))
    return flatten_runs(dated, F.col("__day"))
