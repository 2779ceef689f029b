"""Physical-plan expectations that keep the operators usable at scale."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from proofs import PROOFS, Tables
from vacantia.operators import merge, ranking
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Tables(spark, FOLDER)


@pytest.mark.parametrize("name", ["front_page_cap", "tenant_dedupe", "last_wins", "first_wins"])
def test_per_key_top_rows_are_limited_before_the_shuffle(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", sorted(PROOFS))
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER), "simple")
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_a_built_snapshot_exchanges_by_url_in_the_dedupe_alone(spark, tables):
    from proofs import jobs_io
    from vacantia.plans import daily

    found = jobs_io._collected(tables)
    assert "hashpartitioning(url" in plan(daily.deduped(found), "simple")
    path = jobs_io._scratch(tables, "unique")
    daily.deduped(found).write.parquet(path)
    run = daily.build_snapshot(jobs_io._curated(tables), found, unique=spark.read.parquet(path))
    for df in (run.jobs, run.dropped, run.companies, run.run_log, run.header):
        text = plan(df, "simple")
        assert "hashpartitioning(url" not in text
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_counts_are_combined_before_the_shuffle(tables):
    text = plan(merge.dedupe_by_source_priority(tables.jobs), "simple")
    assert "partial_min" in text and "Window [" not in text


def test_scans_read_only_what_is_asked(spark):
    text = plan(entry.queries()["snapshot_diff_events"](spark, FOLDER))
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert schema and all("o_totalprice" not in line for line in schema)
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in text


def test_full_ranking_has_no_single_task_window_over_rows(tables):
    order = ranking.recency("posted_at", "ingest_seq")
    slim = tables.jobs.select("ingest_seq", "company_slug", "posted_at")
    text = plan(ranking.pages(slim, order), "simple")
    # The only window runs over one row per partition of the sorted table.
    assert text.count("Window [") == 1
    assert text.index("Window [") < text.index("partial_count")


def test_a_hot_join_key_is_split(spark):
    """A third of all rows under one key: the adaptive plan splits that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
            (F.col("id") % 2).cast("int").alias("source_rank"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        out = merge.dedupe_by_source_priority(rows)
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in text
