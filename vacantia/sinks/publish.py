"""Several tables that become visible together.

Each table is written into a folder of its own run. The last step writes one manifest row
that names the run; readers take the folders of published runs only. A job that dies between
its tables, or before the manifest, changes nothing a reader sees, and a repeated job
replaces its version with its own manifest row.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MANIFEST = "version string, run string, sequence long, tables array<string>"


def is_missing(exc: AnalysisException) -> bool:
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All publications; one row each, so a few thousand for years of days."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(f"{root}/published")
    except AnalysisException as exc:
        if is_missing(exc):
            return spark.createDataFrame([], MANIFEST)
        raise


def folder(root: str, table: str, column: str, version: str, run: str) -> str:
    return f"{root}/{table}/{column}={version}/run={run}"


class Publication:
    """A run: tables are written below `folder`, `commit` makes them visible."""

    def __init__(self, spark: SparkSession, root: str, version: str, column: str = "snapshot_date"):
        self.spark, self.root, self.version, self.column = spark, root, version, column
        self.run, self.tables = uuid.uuid4().hex, []

    def folder(self, table: str) -> str:
        self.tables.append(table)
        return folder(self.root, table, self.column, self.version, self.run)

    def write(self, table: str, df: DataFrame, by: str | None = None) -> str:
        """With ``by``, in folders of that column; a folder with many rows gets several files."""
        path = self.folder(table)
        writer = (df.hint("rebalance", by) if by else df).write.option("compression", "snappy")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return path

    def commit(self) -> None:
        """One row in one file, so it is there as a whole or not at all."""
        last = manifest(self.spark, self.root).agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
        row = self.spark.createDataFrame([(self.version, self.run, last + 1, self.tables)], MANIFEST)
        row.coalesce(1).write.parquet(f"{self.root}/published/{self.version}-{self.run}")


def published(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """The run that holds each version of a table: the last one published."""
    last = manifest(spark, root).filter(F.array_contains("tables", table)).groupBy("version").agg(
        F.max_by("run", F.struct("sequence", "run")).alias("run")
    )
    return dict(map(tuple, last.collect()))


def folders(
    spark: SparkSession, root: str, table: str, column: str = "snapshot_date", versions: list[str] | None = None
) -> list[str]:
    """Folders of the published versions, or of the named ones."""
    runs = published(spark, root, table)
    return [folder(root, table, column, v, r) for v, r in sorted(runs.items()) if versions is None or v in versions]


def read(
    spark: SparkSession, root: str, table: str, column: str = "snapshot_date", versions: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """Published rows with their version as a column; None where there are none.

    With a schema, folder columns included, no file is opened for its columns. Without one, a
    version partitioned further and without rows has no file that tells them.
    """
    paths = folders(spark, root, table, column, versions)
    if not paths:
        return None
    try:
        reader = spark.read.option("basePath", f"{root}/{table}")
        return (reader.schema(schema) if schema else reader).parquet(*paths).drop("run")
    except AnalysisException as exc:
        if is_missing(exc):
            return None
        raise
