"""Rows of several schema versions, what is set apart, and its replay."""

from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.functions import validation
from vacantia.sources import quarantine
from vacantia.sources.quarantine import Version

OLD = Version(1, {"id": "id", "company_slug": "company", "title": "title", "url": "url", "source": "source"})
NEW = Version(2, {"id": "id", "company_slug": "slug", "title": "title", "url": "url", "source": "source", "salary_min": "low",
                  "salary_currency": "money", "posted_at": "posted", "stack": "stack", "visa_sponsorship": "visa", "location": "nowhere"})
LANDED = "schema_version string, id string, company string, slug string, title string, url string, source string, low string, money string, posted string, stack string, visa string"


def test_read_and_replay(spark):
    rows = [
        ("1", "a", "acme", None, "T", "u", "s", "x", None, None, None, None),
        ("2", "b", None, "acme", "T", "u", "s", "10.5", "EUR", "2026-05-01 10:00:00", "go, rust", "true"),
        ("2", "c", None, "acme", "T", "u", "s", "ten", "EUR", "yesterday", None, "perhaps"),
        ("2", "d", None, None, "T", "u", "s", "", None, " ", "", None),
        ("3", "e", "acme", "acme", "T", "u", "s", None, None, None, None, None),
        (None, "f", None, None, None, None, None, None, None, None, None, None), ("two", None, *[None] * 10),
        ("2", "b", None, "acme", "T", "u", "s", "10.5", "EUR", "2026-05-01 10:00:00", "go, rust", "true"),
    ]
    landed = spark.createDataFrame(rows, LANDED)
    good, bad = quarantine.read(landed, schemas.JOBS, [OLD, NEW], validation.job_violations())
    assert good.schema.names == schemas.JOBS.names and [f.dataType for f in good.schema] == [f.dataType for f in schemas.JOBS]
    got = sorted((r["id"], r["company_slug"], r["salary_min"], str(r["posted_at"]), r["stack"], r["visa_sponsorship"]) for r in good.collect())
    second = ("b", "acme", 10.5, "2026-05-01 10:00:00", ["go", "rust"], True)
    assert got == [("a", "acme", None, "None", None, None), second, second]
    assert bad.columns == [*landed.columns, "reasons"]
    reasons = {r["id"]: sorted(r["reasons"]) for r in bad.collect()}
    assert reasons == {
        "c": ["salary", "type:posted_at", "type:salary_min", "type:visa_sponsorship"], "d": ["company_slug"],
        "e": ["unknown_version"], "f": ["unknown_version"], None: ["unknown_version"],
    }
    # All rows are on one side, and a replay under another version takes what passes by then.
    assert good.count() + bad.count() == len(rows)
    third = Version(3, OLD.columns)
    again, left = quarantine.replay(bad, schemas.JOBS, [OLD, NEW, third], validation.job_violations())
    assert [r["id"] for r in again.collect()] == ["e"] and left.count() == 4
    assert [df.count() for df in quarantine.read(landed.limit(0), schemas.JOBS, [OLD, NEW], F.array().cast("array<string>"))] == [0, 0]
