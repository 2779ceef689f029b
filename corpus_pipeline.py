"""The corpus pipeline: five stages from raw documents to shards of training data.

Each stage takes what the one before kept, written as Parquet and read again. Nothing is
sampled or capped; all stages but the last return the columns of ``documents``.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.llm import contamination, hilbert, jaccard, mixing, toxicity
from vacantia.session import shared_dir


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels, does not call toxic."""
    return toxicity.reject(docs, _read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group joined by similar shingles."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than one word in twenty."""
    return contamination.decontaminate(docs, _read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the source mix."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot; in a shard they stay in the written order.

    That order, the mix, is the number of the file and the row in it.
    """
    part = "regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1)"
    written = {
        "__number": F.expr(f"coalesce(try_cast({part} AS long), -1)"), "__file": F.col("_metadata.file_path"),
        "__row": F.col("_metadata.row_index"),
    }
    return hilbert.shard(docs.withColumns(written), order=tuple(written))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Three stages rest on a trained model, on hashed candidates and on a schedule, which SQL
# cannot say; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs = _read(spark, sf_dir, "documents")
    place = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{place}/{k}-{name}")
            docs = spark.read.parquet(f"{place}/{k}-{name}")
    return docs
