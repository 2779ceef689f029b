import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.operators import changes
from vacantia.plans import daily, read_model
from vacantia.sinks import publish, writers
from vacantia.sources import AGGREGATOR_READERS, BOARD_READERS, seed, snapshots
from vacantia.sources import payloads as P
from vacantia.streaming import incremental
from tests.test_operators import DAY, jobs


def landed(spark, source, body, handle=None, slug="acme"):
    text = body if isinstance(body, str) else json.dumps(body)
    return spark.createDataFrame([(source, slug, handle, 0, DAY, text)], schemas.PAYLOADS)


def read(spark, source, body, handle=None):
    return P.read_source(landed(spark, source, body, handle), source).collect()


@pytest.mark.parametrize("source", sorted({**BOARD_READERS, **AGGREGATOR_READERS}))
@pytest.mark.parametrize("body", ["", "{}", "[]", "null", "<rss/>", "not even close {"])
def test_odd_payloads_give_no_rows(spark, source, body):
    assert read(spark, source, body, "https://x.test/") == []


def test_missing_keys(spark):
    rows = read(spark, "greenhouse", {"jobs": [{"absolute_url": "https://a.test/1"}, {"title": "x"}]})
    assert [(r["title"], r["location"], r["description_md"], r["posted_at"]) for r in rows] == [("(untitled)", "", "", None)]
    rows = read(spark, "lever", [{"hostedUrl": "https://l.test/1", "text": " Dev "}])
    assert [(r["title"], r["url"]) for r in rows] == [("Dev", "https://l.test/1")]


def test_workday_repeats_are_dropped_within_a_tenant(spark):
    posting = {"title": "Dev", "externalPath": "/job/1"}
    rows = read(spark, "workday", {"jobPostings": [posting, posting]}, "https://a.wd3.myworkdayjobs.com/wday/cxs/a/S/jobs")
    assert [r["url"] for r in rows] == ["https://a.wd3.myworkdayjobs.com/S/job/1"]


def test_visa_style_mixed_types_do_not_break_a_page(spark):
    body = {"jobs": [{"data": {"slug": 7, "title": "Dev", "posted_date": 1700000000}}, {"data": None}]}
    rows = read(spark, "phenom", body, "https://c.test/api/jobs")
    assert [(r["url"], r["posted_at"]) for r in rows] == [("https://c.test/jobs/7", datetime(2023, 11, 14, 22, 13, 20))]


def write_seed(root, files):
    for name, body in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)


GOOD = "name: Acme\ncountry: FR\nats: {provider: lever, handle: acme}\ncategories: [ai]\n"


def test_seed_loads_and_skips_drafts(spark, tmp_path):
    write_seed(tmp_path, {"ai/acme.yaml": GOOD, "_drafts/bad.yaml": "slug: x", "tech/beta.yaml": "name: B\ncountry: DE\ncareer_url: https://b.test\n"})
    rows = {r["slug"]: r for r in seed.load_companies(spark, str(tmp_path)).collect()}
    assert set(rows) == {"acme", "beta"} and rows["acme"]["ats_handle"] == "acme"
    subset = seed.load_companies(spark, str(tmp_path), "ac*.yaml").collect()
    assert [r["slug"] for r in subset] == ["acme"]


@pytest.mark.parametrize(
    "files,problem",
    [
        ({"a/x.yaml": "a: [1"}, "invalid_yaml"), ({"a/x.yaml": "- 1"}, "not_a_mapping"),
        ({"a/x.yaml": GOOD + "slug: x\n"}, "declares_slug"), ({"a/x.yaml": GOOD + "mood: 1\n"}, "unknown_field"),
        ({"a/x.yaml": "name: A\ncountry: FR\n"}, "source"), ({"a/x.yaml": GOOD, "b/x.yaml": GOOD}, "duplicate_slug"),
        ({"a/X Y.yaml": GOOD}, "slug"),
    ],
)
def test_bad_seed_is_refused(spark, tmp_path, files, problem):
    write_seed(tmp_path, files)
    with pytest.raises(seed.SeedError, match=problem):
        seed.load_companies(spark, str(tmp_path))


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "data")
    firms = schemas.empty(spark, schemas.COMPANIES)
    assert snapshots.read_jobs(spark, root).count() == 0
    writers.write_snapshot(jobs(spark, {"id": "1", "title": "Développeur — 開発"}), firms, root, "2026-05-01")
    writers.write_snapshot(jobs(spark, {"id": "2"}), firms, root, "2026-05-02")
    stored = snapshots.read_jobs(spark, root)
    assert snapshots.on_date(stored, "2026-05-01").first()["title"] == "Développeur — 開発"
    assert [r["id"] for r in snapshots.latest(stored).collect()] == ["2"]
    writers.write_snapshot(jobs(spark), firms, root, "2026-05-02")
    assert snapshots.on_date(snapshots.read_jobs(spark, root), "2026-05-02").count() == 0
    assert snapshots.on_date(snapshots.read_jobs(spark, root), "2026-05-01").count() == 1
    assert snapshots.read_companies(spark, root).columns[:15] == schemas.COMPANIES.names


def test_a_run_becomes_visible_as_a_whole(spark, tmp_path):
    """A job that dies between its tables changes nothing that is read; its repetition does."""
    root = str(tmp_path / "data")
    firms = schemas.conform(spark.createDataFrame([("acme", "Acme")], "slug string, name string"), schemas.COMPANIES)
    broken = firms.withColumn("name", F.raise_error(F.lit("lost")).cast("string"))

    def seen():
        return (
            sorted((str(r["snapshot_date"]), r["id"]) for r in snapshots.read_jobs(spark, root).collect()),
            sorted((str(r["snapshot_date"]), r["name"]) for r in snapshots.read_companies(spark, root).collect()),
        )

    with pytest.raises(PySparkException):
        writers.write_snapshot(jobs(spark, {"id": "0"}), broken, root, "2026-05-01")
    assert seen() == ([], []) and snapshots.dates(spark, root) == []
    writers.write_snapshot(jobs(spark, {"id": "1"}), firms, root, "2026-05-01")
    before = seen()
    for day in ("2026-05-01", "2026-05-02"):
        with pytest.raises(PySparkException):
            writers.write_snapshot(jobs(spark, {"id": "9"}), broken, root, day)
        assert seen() == before
    writers.write_snapshot(jobs(spark, {"id": "2"}), firms, root, "2026-05-02")
    writers.write_snapshot(jobs(spark, {"id": "3"}), firms, root, "2026-05-01")
    assert seen() == ([("2026-05-01", "3"), ("2026-05-02", "2")], [("2026-05-01", "Acme"), ("2026-05-02", "Acme")])
    assert snapshots.dates(spark, root) == ["2026-05-01", "2026-05-02"]
    assert [r["id"] for r in snapshots.read_jobs(spark, root, ["2026-05-02"]).collect()] == ["2"]


def test_diff_opens_changed_buckets_only(spark, tmp_path):
    """Files of equal buckets may even be unreadable; other bucket counts add up."""
    root = str(tmp_path / "data")
    firms = schemas.empty(spark, schemas.COMPANIES)
    rows = [{"id": str(i), "title": f"t{i}", "url": f"https://a.test/{i}"} for i in range(40)]
    changed = [r | ({"title": "new title"} if r["id"] == "7" else {}) for r in rows if r["id"] != "9"]
    writers.write_snapshot(jobs(spark, *rows), firms, root, "2026-05-01", buckets=8)
    writers.write_snapshot(jobs(spark, *reversed(changed)), firms, root, "2026-05-02", buckets=32)
    writers.write_snapshot(jobs(spark, *changed), firms, root, "2026-05-03", buckets=4)
    digests = [snapshots.read_digests(spark, root, f"2026-05-0{d}") for d in (2, 1)]
    common, differ = changes.changed_buckets(*digests)
    want = {r[0] for r in spark.createDataFrame([("7",), ("9",)], "id string").select(F.pmod(F.hash("id"), F.lit(8))).collect()}
    assert common == 8 and set(differ) == want
    for file in (tmp_path / "data" / "jobs").rglob("*.parquet"):
        bucket = int(str(file).split("bucket=")[1].split("/")[0])
        if "2026-05-03" not in str(file) and bucket % 8 not in want:
            file.write_bytes(b"not parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    events = daily.diff(spark, root, "2026-05-02", "2026-05-01").collect()
    assert sorted((e["event"], e["id"], e["new"]) for e in events) == [("changed", "7", "new title"), ("removed", "9", None)]
    assert changes.changed_buckets(snapshots.read_digests(spark, root, "2026-05-03"), digests[0]) == (4, [])
    assert daily.diff(spark, root, "2026-05-03", "2026-05-02").count() == 0
    with pytest.raises(ValueError):
        writers.write_snapshot(jobs(spark), firms, root, "2026-05-04", buckets=3)


def test_a_diff_against_a_broken_run_is_refused(spark, tmp_path):
    root = str(tmp_path / "data")
    firms = schemas.empty(spark, schemas.COMPANIES)
    writers.write_snapshot(jobs(spark, {"id": "1"}), firms, root, "2026-05-01")
    writers.write_snapshot(jobs(spark), firms, root, "2026-05-02")
    with pytest.raises(changes.EmptySnapshotError):
        daily.diff(spark, root, "2026-05-02", "2026-05-01")
    assert [r["event"] for r in daily.diff(spark, root, "2026-05-01", "2026-05-02").collect()] == ["new"]


def test_a_written_table_stays_hidden_until_the_manifest(spark, tmp_path):
    root = str(tmp_path / "data")
    run = publish.Publication(spark, root, "v1", "day")
    run.write("a", spark.range(3))
    assert publish.read(spark, root, "a", "day") is None
    run.commit()
    again = publish.Publication(spark, root, "v1", "day")
    again.write("a", spark.range(5))
    assert publish.read(spark, root, "a", "day").count() == 3
    again.commit()
    assert publish.read(spark, root, "a", "day").count() == 5
    assert publish.read(spark, root, "b", "day") is None


def test_run_metadata_files(spark, tmp_path):
    for day, n in (("2026-05-01", 0), ("2026-05-02", 4)):
        (tmp_path / day).mkdir()
        result = {"extractor": "lever", "company_slug": "a", "success": True, "job_count": n, "duration_ms": 1, "error": None}
        (tmp_path / day / "metadata.json").write_text(json.dumps({"run_at": "2026-05-01T00:00:00Z", "pipeline_version": "1", "company_count": 1, "job_count": n, "extractor_results": [result]}, indent=2))
    rows = snapshots.read_run_log(spark, f"{tmp_path}/*/metadata.json").orderBy("snapshot_date").collect()
    assert [(r["snapshot_date"], r["job_count"]) for r in rows] == [(date(2026, 5, 1), 0), (date(2026, 5, 2), 4)]


def test_daily_run_then_diff(spark, tmp_path):
    root = str(tmp_path / "data")
    curated = schemas.conform(
        spark.createDataFrame([("acme", "Acme", "FR", "greenhouse", "h"), ("lost", "Lost", "FR", None, None)],
                              "slug string, name string, country string, ats_provider string, ats_handle string"),
        schemas.COMPANIES,
    )

    def board(*titles):
        return landed(spark, "greenhouse", {"jobs": [{"title": t, "absolute_url": f"https://a.test/{t}", "location": {"name": loc}} for t, loc in titles]})

    feed = landed(spark, "remoteok", [{"legal": "x"}, {"company": "Other", "url": "https://a.test/Dev", "position": "Dup"},
                                      {"company": "Other", "url": "https://o.test/1", "position": "Ops", "location": "Europe"}], slug=None)
    names = ["greenhouse", "remoteok"]
    daily.run(spark, curated, board(("Dev", "Paris"), ("US", "Boston")).union(feed), root, "2026-05-01", names)
    daily.run(spark, curated, board(("Dev", "Lyon"), ("New", "")).union(feed), root, "2026-05-02", names)
    stored = snapshots.read_jobs(spark, root)
    assert {r["title"] for r in snapshots.on_date(stored, "2026-05-01").collect()} == {"Dev", "Ops"}
    firms = snapshots.latest(snapshots.read_companies(spark, root)).collect()
    assert {r["slug"] for r in firms} == {"acme", "lost", "via-remoteok-other"}
    log = {(r["extractor"], r["company_slug"]): (r["success"], r["job_count"]) for r in spark.read.parquet(f"{root}/run_log/snapshot_date=2026-05-02").collect()}
    assert log[("greenhouse", "acme")] == (True, 2) and log[("remoteok", "(aggregator)")] == (True, 1)
    assert log[("none", "lost")] == (False, 0)
    events = daily.diff(spark, root, "2026-05-02", "2026-05-01")
    assert sorted((e["event"], e["field"], e["new"]) for e in events.select("event", "field", "new").collect()) == [
        ("changed", "location", "Lyon"), ("new", None, None)]
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{root}/diffs/2026-05-02").collect()]
    assert {line["event"] for line in lines} == {"new", "changed"}
    fresh = daily.new_postings(snapshots.on_date(stored, "2026-05-02"), events)
    assert [r["title"] for r in fresh.collect()] == ["New"]


def test_tag_round_trip(spark):
    rows = jobs(spark, {"id": "1", "title": "Data Engineer", "description_md": "We use Spark"}, {"id": "2", "seniority": "mid"}, {"id": "3", "title": " "})
    assert [r["id"] for r in daily.tag_requests(rows).collect()] == ["1"]
    answers = spark.createDataFrame([("1", '{"role_family": "data", "stack": ["spark", "Go"], "seniority": "boss"}')], "id string, body string")
    assert daily.tag_requests(rows, answers).count() == 0
    tagged = {r["id"]: r for r in daily.apply_answers(rows, answers).collect()}
    assert tagged["1"]["role_family"] == "data" and tagged["1"]["stack"] == ["spark"] and tagged["1"]["seniority"] is None
    assert tagged["2"]["seniority"] == "mid"


@pytest.mark.parametrize("n,expected", [(0, 0), (2, 2), (80, 50)])
def test_feed_size(spark, n, expected):
    items = writers.feed_items(jobs(spark, *[{"id": f"{i:02}", "title": "A & B"} for i in range(n)]))
    xml = writers.feed_document(items, title="t", link="l", description="d", built_at=F.lit(DAY)).first()["xml"]
    from xml.etree import ElementTree

    assert len(ElementTree.fromstring(xml.split("\n", 1)[1]).findall(".//item")) == expected


def test_read_model_prefers_stored_tags(spark):
    row = read_model.lite(jobs(spark, {"id": "1", "title": "Data Engineer (remote)", "role_family": "", "remote_policy": "onsite"})).first()
    assert (row["role_family"], row["remote_policy"], row["employment_type"], row["has_description"]) == ("data", "onsite", "permanent", False)


def test_streams_resume(spark, tmp_path):
    source, log, seen = (str(tmp_path / n) for n in ("in", "log", "seen"))
    base = spark.createDataFrame([("1", "none"), ("2", "none")], "id string, tag string")
    for i, rows in enumerate([[("1", "a", 1), ("1", "b", 2)], [("1", "c", 3), ("3", "d", 4)]]):
        spark.createDataFrame(rows, "id string, tag string, n int").coalesce(1).write.mode("append").parquet(source)
        for name, apply in (
            ("log", incremental.log_updates(log, key="id", sequence="n")),
            ("seen", incremental.first_seen_batches(spark, seen, key="id", order=[F.col("n")])),
        ):
            stream = spark.readStream.schema("id string, tag string, n int").parquet(source)
            incremental.upsert_batches(stream, apply, str(tmp_path / f"state-{name}")).awaitTermination()
    now = incremental.with_updates(base, log, ["tag"], key="id", sequence="n")
    assert {r["id"]: r["tag"] for r in now.collect()} == {"1": "c", "2": "none"}
    assert sorted((r["id"], r["tag"]) for r in spark.read.parquet(seen).collect()) == [("1", "a"), ("3", "d")]


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    source, log, seen = (str(tmp_path / n) for n in ("in", "log", "seen"))
    base = spark.createDataFrame([("1", "none"), ("2", "none")], "id string, tag string")
    for i, rows in enumerate([[("1", "a", 1)], [("2", "b", 2), ("1", "z", 0)]]):
        feed = f"{source}{i}"
        spark.createDataFrame(rows, "id string, tag string, n int").coalesce(1).write.parquet(feed)
        for name, apply in (
            ("log", incremental.log_updates(log, key="id", sequence="n")),
            ("seen", incremental.first_seen_batches(spark, seen, key="id", order=[F.col("n")])),
        ):
            stream = spark.readStream.schema("id string, tag string, n int").parquet(feed)
            incremental.upsert_batches(stream, apply, str(tmp_path / f"state-{name}-{i}")).awaitTermination()
    now = incremental.with_updates(base, log, ["tag"], key="id", sequence="n")
    assert {r["id"]: r["tag"] for r in now.collect()} == {"1": "a", "2": "b"}
    assert sorted((r["id"], r["tag"]) for r in spark.read.parquet(seen).collect()) == [("1", "a"), ("2", "b")]
    incremental.compact(spark, seen, str(tmp_path / "small"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "small")).collect()) == ["1", "2"]


def test_repeated_ids_do_not_multiply(spark, tmp_path):
    root = str(tmp_path / "out")
    curated = schemas.conform(spark.createDataFrame([("acme", "Acme", "greenhouse")], "slug string, name string, ats_provider string"), schemas.COMPANIES)
    job = '{"title": "%s", "absolute_url": "https://x.test/1", "location": {"name": "Paris"}}'
    for day, title in (("2026-05-01", "Dev"), ("2026-05-02", "Dev"), ("2026-05-03", "Lead")):
        body = '{"jobs": [%s, %s]}' % (job % title, job % title)
        landed = spark.createDataFrame([("greenhouse", "acme", "acme", 0, DAY, body)], schemas.PAYLOADS)
        daily.run(spark, curated, landed, root, day, ["greenhouse"])
        stored = snapshots.on_date(snapshots.read_jobs(spark, root), day)
        assert stored.count() == 2
        if day == "2026-05-01":
            tagged = stored.withColumns({"role_family": F.lit("data"), "seniority": F.lit("mid")}).collect()
            writers.write_snapshot(spark.createDataFrame(tagged, stored.schema), curated, root, day)
        else:
            assert {r["role_family"] for r in stored.collect()} == {"data"}
    events = daily.diff(spark, root, "2026-05-03", "2026-05-02").collect()
    assert [(e["event"], e["field"], e["new"]) for e in events] == [("changed", "title", "Lead")]
    log = spark.read.parquet(f"{root}/run_log/snapshot_date=2026-05-03").collect()
    assert [(r["extractor"], r["job_count"]) for r in log] == [("greenhouse", 2)]
    again = snapshots.read_run_log(spark, f"{root}/metadata").collect()
    assert sorted((str(r["snapshot_date"]), r["company_slug"], r["job_count"]) for r in again) == [
        (day, "acme", 2) for day in ("2026-05-01", "2026-05-02", "2026-05-03")]


def test_watermarked_first_seen(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("1", DAY), ("1", DAY), ("2", DAY)], "id string, ts timestamp").write.parquet(source)
    stream = spark.readStream.schema("id string, ts timestamp").parquet(source)
    incremental.drain(incremental.first_seen(stream, key="id", ts="ts", delay="1 day"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2"]


def feed_of(spark, folder, rows, schema):
    """A stream that gives one row set per micro-batch, in order."""
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/{i:03}")
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    )


def test_first_arrivals_keep_state(spark, tmp_path):
    """The first batch of a key decides, the order inside it; a later smaller row changes nothing."""
    rows = [[("a", 5, "x"), ("a", 4, "y"), ("b", 1, "z")], [("a", 1, "late"), ("c", 2, "c")], [("c", 0, "late")], [("d", 1, "d"), ("b", 0, "late")]]
    folder, root, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stream = feed_of(spark, folder, rows, "id string, n int, tag string")
    for _ in range(2):  # a second start finds nothing new
        query = incremental.start_first_arrivals(stream, root, state, key="id", order=[F.col("n")])
        query.awaitTermination()
    want = [("a", 4, "y"), ("b", 1, "z"), ("c", 2, "c"), ("d", 1, "d")]
    assert sorted((r["id"], r["n"], r["tag"]) for r in spark.read.parquet(root).collect()) == want
    spark.createDataFrame([("a", 0, "late"), ("e", 1, "e")], "id string, n int, tag string").coalesce(1).write.parquet(f"{folder}/100")
    incremental.start_first_arrivals(stream, root, state, key="id", order=[F.col("n")]).awaitTermination()
    assert sorted((r["id"], r["n"], r["tag"]) for r in spark.read.parquet(root).collect()) == [*want, ("e", 1, "e")]


def test_update_log_merges_itself(spark, tmp_path):
    """After any number of epochs few runs are live, replays and crashes change nothing."""
    log = incremental.UpdateLog(spark, str(tmp_path / "log"), key="id", sequence="n", ratio=2, range_rows=3)
    base = spark.createDataFrame([(str(i), "none") for i in range(6)], "id string, tag string")
    assert log.over(base, ["tag"]).collect() == base.collect()
    want = {str(i): "none" for i in range(6)}
    for epoch in range(11):
        rows = [(str((epoch * 2 + k) % 5), f"{epoch}-{k}", epoch * 10 + k) for k in range(3)]
        batch = spark.createDataFrame(rows, "id string, tag string, n int")
        log.apply(batch, epoch)
        log.apply(spark.createDataFrame([("0", "replay", 1000)], "id string, tag string, n int"), epoch)
        want |= {i: tag for i, tag, _ in rows}
        _, live, applied = log.state()
        assert len(live) <= 4 and applied == {"batch": epoch}
        assert [sum(n == level for _, n in live) <= 1 for level in range(5)] == [True] * 5
    spark.range(3).write.parquet(f"{log.root}/runs/left-by-a-crash")
    assert {r["id"]: r["tag"] for r in log.over(base, ["tag"]).collect()} == want
    assert all(r["tag"] != "replay" for r in log.newest().collect())
