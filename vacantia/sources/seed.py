"""Curated company seed: YAML documents to validated company rows."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia import schemas
from vacantia.functions.validation import company_violations

_RAW = "path string, slug string, copies bigint, problem string, body string"
_FIELDS = """name STRING, country STRING, categories ARRAY<STRING>,
  industry_tags ARRAY<STRING>, ats STRUCT<provider: STRING, handle: STRING>,
  career_url STRING, github_org STRING, funding_stage STRING, size_bucket STRING, notes STRING,
  oss_signal BOOLEAN, top_repo_stars BIGINT, primary_language STRING"""
_KNOWN = [
    "name", "country", "categories", "industry_tags", "ats", "career_url", "github_org",
    "funding_stage", "size_bucket", "notes", "oss_signal", "top_repo_stars", "primary_language",
]


class SeedError(ValueError):
    """A seed document is malformed, breaks the schema, or repeats a slug."""


def scan_seed(spark: SparkSession, root: str, glob: str = "*.yaml") -> DataFrame:
    """``(path, body)`` of every document below ``root``, drafts excluded.

    ``glob`` selects a subset by file name.
    """
    docs = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    )
    return docs.filter(
        ~F.contains("path", F.lit("/_drafts/")) & F.col("path").endswith(".yaml")
    )


def _to_json(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import json
    import re

    import yaml  # installed wherever a YAML seed is read

    # libyaml, where PyYAML was built with it, is several times faster; the two differ on tabs,
    # marks and characters beyond the basic plane, so a body that has some takes the plain one.
    fast = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    odd = re.compile("[^\n\r\x20-\x7e\xa0-\u2027\u2030-\ud7ff]")

    def one(body: str) -> tuple[str | None, str | None]:
        try:
            doc = yaml.load(body, yaml.SafeLoader if odd.search(body or "") else fast)
        except yaml.YAMLError:
            return "invalid_yaml", None
        if not isinstance(doc, dict):
            return "not_a_mapping", None
        if "slug" in doc:
            return "declares_slug", None
        if set(map(str, doc)) - set(_KNOWN):
            return "unknown_field", None
        return None, json.dumps(doc, default=str)

    for pdf in batches:
        decoded = [one(b) for b in pdf["body"]]
        yield pdf.assign(
            problem=[d[0] for d in decoded], body=[d[1] for d in decoded]
        )[["path", "slug", "copies", "problem", "body"]]


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)


def decode_seed(docs: DataFrame) -> DataFrame:
    """Companies with ``problems``, an array naming everything wrong with a document.

    Only the YAML decoding runs in Python, batched through Arrow; rules, slugs and
    duplicates are plain columns.
    """
    raw = docs.select("path", file_stem(F.col("path")).alias("slug"), "body")
    # The slug comes from the path, so repeats are counted without decoding anything.
    copies = raw.groupBy("slug").agg(F.count("*").alias("copies"))
    # Decoding costs far more than its bytes tell, so rows are dealt to all tasks of a shuffle.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    decoded = (
        raw.join(copies, "slug")
        .select("path", "slug", "copies", F.lit(None).cast("string").alias("problem"), "body")
        .repartition(tasks)
        .mapInPandas(_to_json, _RAW)
    )
    parsed = decoded.withColumn("doc", F.from_json("body", _FIELDS)).select(
        "path", "slug", "copies", "problem", "doc.*"
    )
    flat = parsed.select(
        "path", "copies", "problem", "slug", "name", "country",
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
        F.coalesce("industry_tags", F.array().cast("array<string>")).alias("industry_tags"),
        F.col("ats.provider").alias("ats_provider"), F.col("ats.handle").alias("ats_handle"),
        "career_url", "github_org", "funding_stage", "size_bucket", "notes", "oss_signal",
        "top_repo_stars", "primary_language",
    )
    rules = F.when(F.col("problem").isNotNull(), F.array("problem")).otherwise(
        company_violations()
    )
    repeated = F.array(F.when(F.col("copies") > 1, F.lit("duplicate_slug")))
    return flat.withColumn("problems", F.array_compact(F.concat(rules, repeated))).select(
        *schemas.COMPANIES.names, "path", "problems"
    )


def load_companies(spark: SparkSession, root: str, glob: str = "*.yaml") -> DataFrame:
    """Validated companies; raises on the first bad document in path order."""
    decoded = decode_seed(scan_seed(spark, root, glob))
    bad = decoded.filter(F.size("problems") > 0).orderBy("path").select("path", "problems").head()
    if bad:
        raise SeedError(f"{bad['path']}: {', '.join(bad['problems'])}")
    return decoded.select(*schemas.COMPANIES.names)


def tagger_companies(curated: DataFrame, stored: DataFrame) -> DataFrame:
    """Curated companies plus the valid stored ones they do not already have."""
    kept = (
        schemas.conform(stored, schemas.COMPANIES)
        .filter(F.coalesce("slug", F.lit("")) != "")
        .join(curated.select("slug"), "slug", "left_anti")
        .withColumns(
            {
                "name": F.coalesce(F.nullif("name", F.lit("")), "slug"),
                "country": F.coalesce(F.nullif("country", F.lit("")), F.lit("XX")),
            }
        )
    )
    half = (F.coalesce("ats_provider", F.lit("")) == "") | (F.coalesce("ats_handle", F.lit("")) == "")
    kept = kept.withColumns(
        {c: F.when(~half, F.col(c)) for c in ("ats_provider", "ats_handle")}
    ).filter(F.size(company_violations()) == 0)
    return curated.unionByName(kept.select(*curated.columns))
