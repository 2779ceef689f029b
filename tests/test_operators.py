from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.operators import changes, facets, merge, quality, ranking, search

DAY = datetime(2026, 5, 1)


def jobs(spark, *rows):
    full = [
        {"id": None, "company_slug": "acme", "title": "Dev", "url": "u", "location": "Paris", "source": "lever",
         "posted_at": DAY, "scraped_at": DAY, "description_md": "", **r}
        for r in rows
    ]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.JOBS) for r in full], schemas.JOBS)


def events(today, yesterday):
    return sorted((e["event"], e["id"], e["field"], e["old"], e["new"]) for e in changes.change_events(today, yesterday).collect())


def test_diff_cases(spark):
    a = jobs(spark, {"id": "1"}, {"id": "2"})
    none = schemas.empty(spark, schemas.JOBS)
    assert events(a, a) == []
    assert events(a, none) == [("new", "1", None, None, None), ("new", "2", None, None, None)]
    assert events(none, a) == [("removed", "1", None, None, None), ("removed", "2", None, None, None)]
    b = jobs(spark, {"id": "1", "title": "Lead", "description_md": "new text"}, {"id": "2", "location": None})
    assert events(b, a) == [("changed", "1", "title", "Dev", "Lead"), ("changed", "2", "location", "Paris", "")]
    paid = jobs(spark, {"id": "1", "salary_min": 1.0, "salary_max": 2.0, "salary_currency": "EUR"}, {"id": "2"})
    assert events(paid, a) == [("changed", "1", "salary", None, "1.0|2.0|EUR|year")]


def test_replaying_a_diff_gives_the_new_snapshot(spark):
    a = jobs(spark, {"id": "1"}, {"id": "2", "seniority": "mid"}, {"id": "3"})
    b = jobs(spark, {"id": "1", "title": "Lead"}, {"id": "2", "seniority": None}, {"id": "4"})
    replayed = changes.apply_changes(a, changes.change_events(b, a))
    texts = ["id", "title", "url", "location", "seniority"]
    assert sorted(map(tuple, replayed.select(*texts).collect()), key=str) == sorted(map(tuple, b.select(*texts).collect()), key=str)


def test_refusal_and_summary(spark):
    a, none = jobs(spark, {"id": "1"}), schemas.empty(spark, schemas.JOBS)
    with pytest.raises(changes.EmptySnapshotError):
        changes.refuse_if_broken(none, a)
    changes.refuse_if_broken(none, none)
    row = changes.change_summary(changes.change_events(none, none)).first()
    assert row["is_empty"] and row["summary"] == "+0 new · -0 removed · ~0 changed"
    many = jobs(spark, *[{"id": str(i), "company_slug": "a" if i < 5 else "b"} for i in range(7)])
    row = changes.change_summary(changes.change_events(many, none)).first()
    assert row["summary"] == "+7 new · -0 removed · ~0 changed\nTop: a(5), b(2)"


def test_source_priority_keeps_duplicates_inside_one_source(spark):
    rows = [("u1", 0, 1), ("u1", 0, 2), ("u1", 3, 3), ("u2", 3, 4), ("u2", 4, 5), ("u3", 4, 6), (None, 2, 7), (None, 3, 8)]
    df = spark.createDataFrame(rows, "url string, source_rank int, n int")
    kept = sorted(r["n"] for r in merge.dedupe_by_source_priority(df).collect())
    assert kept == [1, 2, 4, 6, 7, 8]


def test_source_priority_with_a_hot_key(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
        (F.col("id") % 2).cast("int").alias("source_rank"),
    )
    got = merge.dedupe_by_source_priority(rows).groupBy((F.col("url") == "hot").alias("hot")).count().collect()
    assert {r["hot"]: r["count"] for r in got} == {True: 5000, False: 20000}


def test_dimension_merge(spark):
    curated = spark.createDataFrame([("a", "Curated A")], "slug string, name string")
    found = spark.createDataFrame(
        [("a", "x", 5, 1), ("b", "first of early", 1, 1), ("b", "first of late", 2, 2), ("b", "second of late", 2, 3)],
        "slug string, name string, source_rank int, ingest_seq int",
    )
    got = {tuple(r) for r in merge.merge_dimension(curated, found).collect()}
    assert got == {("a", "Curated A"), ("b", "first of late")}


def test_carry_forward_takes_the_pair_only_for_untagged_rows(spark):
    now = jobs(spark, {"id": "1"}, {"id": "2", "seniority": "mid"}, {"id": "3"})
    prior = jobs(spark, {"id": "1", "role_family": "data"}, {"id": "2", "role_family": "hr"}, {"id": "3", "role_family": ""})
    got = {r["id"]: (r["role_family"], r["seniority"]) for r in merge.carry_tags_forward(now, prior).collect()}
    assert got == {"1": ("data", None), "2": (None, "mid"), "3": (None, None)}


def test_front_page_equals_the_greedy_walk(spark):
    rows = [(f"c{i % 3 if i % 2 else 0}", None if i % 7 == 0 else datetime(2026, 1, 1 + i % 28), i) for i in range(120)]
    df = spark.createDataFrame(rows, "company_slug string, posted_at timestamp, id int")
    order = ranking.recency("posted_at", "id")
    got = [r["id"] for r in ranking.front_page(df, order, per_company=5, size=12).collect()]
    walk = sorted(rows, key=lambda r: (r[1] is None, -(r[1].timestamp() if r[1] else 0), r[0], r[2]))
    taken, seen = [], {}
    for slug, _, i in walk:
        if seen.get(slug, 0) < 5 and len(taken) < 12:
            taken.append(i)
            seen[slug] = seen.get(slug, 0) + 1
    assert got == taken


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_positions_do_not_depend_on_partitioning(spark, partitions):
    # One value holds a third of the rows, so ties must spread over partitions.
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("g"))
        got = {r["id"]: r["position"] for r in ranking.positions(df, [F.col("g"), F.col("id")]).collect()}
        inside = {r["id"]: r["position"] for r in ranking.positions_within(df, ["g"], [F.col("id")]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted((("hot" if i % 3 == 0 else f"k{i % 50}"), i) for i in range(3000))
    assert got == {i: n for n, (_, i) in enumerate(rows, 1)}
    counts: dict[str, int] = {}
    expected = {}
    for g, i in rows:
        counts[g] = counts.get(g, 0) + 1
        expected[i] = counts[g]
    assert inside == expected


def brute_sample(rows, n, distinct):
    strata = {}
    for r in rows:
        strata.setdefault(r[1], []).append(r)
    half = max(1, max(1, n // max(len(strata), 1)) // 2)
    ordered = {s: sorted(b, key=lambda r: (-r[2], r[0])) for s, b in sorted(strata.items())}
    out = []
    for bucket in ordered.values():
        head = bucket[:half]
        tail = bucket[-half:] if len(bucket) > half else []
        out += head + ([r for r in tail if r not in head] if distinct else tail)
    seen = {r[0] for r in out}
    if len(out) < n:
        out += [r for b in ordered.values() for r in b if r[0] not in seen]
    return sorted(r[0] for r in out[:n])


@pytest.mark.parametrize("n,distinct", [(20, True), (20, False), (3, True), (200, True), (50, False)])
def test_stratified_sample_against_brute_force(spark, n, distinct):
    rows = [(f"{i:03}", f"s{min(i % 9, 4)}", (i * 37) % 11) for i in range(90)] + [("900", "s9", 1), ("901", "s8", 1), ("902", "s8", 0), ("903", "s8", 5)]
    df = spark.createDataFrame(rows, "id string, source string, n int")
    got = ranking.stratified_sample(df, n, size=F.col("n"), distinct=distinct)
    assert sorted(r["id"] for r in got.collect()) == brute_sample(rows, n, distinct)


def test_facets_sum_to_rows_and_skip_blanks(spark):
    df = jobs(spark, {"id": "1", "role_family": "hr"}, {"id": "2", "role_family": ""}, {"id": "3"})
    got = {tuple(r) for r in facets.facet_counts(df, {"role": "role_family", "source": "source"}).collect()}
    assert got == {("role", "hr", 1), ("source", "lever", 3)}


def test_success_rate(spark):
    empty = schemas.empty(spark, schemas.RUN_LOG)
    assert quality.success_summary(empty).first()["success_rate"] == 1.0
    log = spark.createDataFrame([(True,), (False,), (False,)], "success boolean")
    row = quality.success_summary(log).first()
    assert abs(row["success_rate"] - 1 / 3) < 1e-9 and row["below_half"]


def test_stale_needs_enough_observations(spark):
    log = spark.createDataFrame(
        [(d, s, n) for d in (1, 2, 3) for s, n in (("dead", 0), ("live", d), ("new", 0)) if not (s == "new" and d == 2)],
        "snapshot_date int, company_slug string, job_count int",
    )
    assert [r["company_slug"] for r in quality.stale_entities(log, 3).collect()] == ["dead"]
    assert sorted(r["company_slug"] for r in quality.stale_entities(log, 1).collect()) == ["dead", "new"]


def test_search(spark):
    rows = [(1, "Data engineer data", "a"), (2, "data analyst", None), (3, "Recruiter", "b"), (4, "data-data DATA", "b"), (5, "", "a")]
    df = spark.createDataFrame(rows, "id int, title string, kind string")
    ids = [r["id"] for r in search.search(df, F.col("title"), "Data").collect()]
    assert ids[0] == 4 and sorted(ids) == [1, 2, 4]
    assert [r["id"] for r in search.search(df, F.col("title"), "data engineer").collect()] == [1]
    facet = {"facets": {"kind": "kind"}}
    assert [r["id"] for r in search.search(df, F.col("title"), "data", selected={"kind": ["b"]}, **facet).collect()] == [4]
    # Every value selected is no filter: the row without one stays.
    assert len(search.search(df, F.col("title"), "data", selected={"kind": ["a", "b"]}, **facet).collect()) == 3
    assert len(search.search(df, F.col("title"), "", page=None).collect()) == 5
    assert [r["id"] for r in search.search(df, F.col("title"), "", page=2, page_size=2).collect()] == [3, 4]
