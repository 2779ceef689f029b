"""Counts kept from day to day against a recount."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_operators import jobs
from vacantia import schemas
from vacantia.operators import changes, rollups
from vacantia.sinks import writers
from vacantia.sources import snapshots

START = datetime(2026, 5, 1, 10, 30)


def day_of(spark, k):
    """Forty postings of which some move to another company, date or bucket each day; one id comes twice."""
    rows = [
        {"id": str(i), "company_slug": f"c{(i + k) % 3 if i % 9 == 0 else i % 3}", "url": f"https://a.test/{i}",
         "posted_at": None if i % 13 == 0 else START + timedelta(hours=5 * i + (k if i % 10 == 0 else 0), minutes=i)}
        for i in range(40) if (i + k) % 6
    ]
    return jobs(spark, *rows, rows[0])


def test_counts_after_each_day(spark, tmp_path):
    root, firms = str(tmp_path / "data"), schemas.empty(spark, schemas.COMPANIES)
    for k, buckets in enumerate((4, 8, 4)):
        day = f"2026-05-0{k + 1}"
        writers.write_snapshot(day_of(spark, k), firms, root, day, buckets=buckets)
        rollups.update(spark, root, day)
        stored = snapshots.read_jobs(spark, root, [day])
        want = stored.groupBy("company_slug").count()
        assert sorted(map(tuple, rollups.company_counts(spark, root, day).collect())) == sorted(map(tuple, want.collect()))
        order = lambda df: sorted(map(tuple, df.collect()))
        assert order(rollups.weekly_velocity(spark, root, day)) == order(changes.weekly_velocity(stored))
        since = F.lit(START + timedelta(hours=60, minutes=12))
        recent = stored.filter(F.col("posted_at") > since).groupBy("company_slug").count()
        assert order(rollups.recent_counts(spark, root, day, since)) == order(recent)
    with pytest.raises(ValueError):
        rollups.counts(spark, root, "2026-06-01")
