"""Work that costs far more than its bytes tell: spread over tasks, and done once per row."""

from pyspark.sql import functions as F

from proofs import PROOFS, Tables
from tests.test_plans import plan
from vacantia.functions import text
from vacantia.operators import changes
from vacantia.sources import AGGREGATOR_READERS, seed


def test_seed_is_decoded_by_all_tasks(spark):
    bodies = ["name: A\ncountry: FR\ncareer_url: https://c.test\n", "name: \tB\n", "name: \U0001F600\t\n", "- x\n"]
    rows = [(f"file:/seed/c{i}.yaml", bodies[i % 4]) for i in range(64)]
    decoded = seed.decode_seed(spark.createDataFrame(rows, "path string, body string"))
    shown = plan(decoded, "simple")
    assert "REPARTITION_BY_NUM" in shown.split("MapInPandas")[1]
    found = {r["path"]: (r["name"], r["problems"]) for r in decoded.select("path", "name", "problems").collect()}
    # As PyYAML reads them: libyaml would take the third one.
    assert found["file:/seed/c0.yaml"] == ("A", [])
    assert found["file:/seed/c2.yaml"] == (None, ["invalid_yaml"])
    assert found["file:/seed/c3.yaml"] == (None, ["not_a_mapping"])
    assert len(found) == 64


def test_html_is_read_without_row_by_row_expressions(spark):
    page = spark.createDataFrame([("<b>x</b>",)], "html string").select(text.page_text(F.col("html")).alias("m"))
    shown = plan(page, "extended")
    assert "lambdafunction" not in shown and "split(" not in shown


def test_html_sections_end_as_before(run):
    pages = [
        "a<script>x</script>b<script>c", "<script a<script b</script>c", "a<!--<!-->b", "a<!--<!--x-->b", "a<!--x--><!--y",
        "<head>t</head>u<header>v</header><head>w", "a </h2> b", "<li>a  </li><li>b</li>", "a\x01b",
    ]
    assert run(text.page_text, pages) == [
        "abc", "c", "a<!--<!-->b".replace("<!-->", ""), "ab", "a<!--y", "uvw", "a\n\nb", "* a\n* b", "ab",
    ]


def test_bof_link_is_sought_once(spark):
    rows = spark.createDataFrame(
        [("bof", "c", None, 0, '<a class="lister__item cf" id="item-1"><img alt="Acme logo"><i></i><a href=" /careers/job/7/x/ ">'
          '<span> Acme Lead </span></a><b class="lister__meta-item--location">Berlin, Germany</li></section><a href="/careers/job/8/y"><span>n</span></a>')],
        "source string, company_slug string, handle string, page int, body string",
    ).withColumn("fetched_at", F.lit("2002-01-01").cast("timestamp"))
    found = AGGREGATOR_READERS["bof"](rows)
    # The whole block is searched for the link once, the parts are read from the link.
    assert plan(found, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical")[0].count("regexp_extract(raw") == 3
    assert [(r["title"], r["url"], r["location"]) for r in found.collect()] == [
        ("Lead", "https://www.businessoffashion.com/careers/job/7/x/", "Berlin, Germany")
    ]


def test_payloads_of_one_file_are_read_by_all_tasks(spark, tmp_path):
    orders = spark.range(400).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'1-URGENT' AS o_orderpriority", "DATE '1997-01-02' AS o_orderdate", "id AS unused"
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = PROOFS["payload_wttj"].build(Tables(spark, str(tmp_path)))
    shown = plan(found, "simple")
    assert shown.count("REPARTITION_BY_NUM") >= 1 and "body" not in shown.split("REPARTITION_BY_NUM")[-1]
    # Orders move with the columns that bodies take, before these are built.
    assert "unused" not in shown
    assert found.groupBy("title").count().orderBy("title").collect() == [("Buyer", 200), ("Chef", 200), ("Data Lead", 200)]
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() >= 8


SNAPSHOT = (
    "id string, company_slug string, title string, url string, location string, source string, posted_at timestamp, "
    "remote_policy string, seniority string, salary_min double, salary_max double, salary_currency string, salary_period string"
)


def test_diff_moves_each_row_once(spark):
    def rows(*some):
        full = [(i, "c", title, "u\"\\\n\u00e9", None, "s", None, None, who, low, None, "EUR", None) for i, title, who, low in some]
        return spark.createDataFrame(full, SNAPSHOT).withColumn("posted_at", F.expr("TIMESTAMP '2001-07-20 06:00:00.123456'"))

    was = rows(("a", "x", None, 1.5), ("b", "x", "senior", None), ("c", "x", None, None), (None, "n", None, None), ("f", "x", None, -0.0))
    now = rows(("a", "x", None, 2.5), ("a", "w", None, 9.0), ("b", "x", None, None), ("d", "\u00fc \"q\"", None, None), (None, "n", None, None),
               ("f", "x", None, 0.0))
    found = changes.change_events(now, was)
    told = {(r["event"], r["id"], r["field"], r["old"], r["new"]) for r in found.collect()}
    assert told == {
        ("changed", "a", "salary", "1.5||EUR|year", "2.5||EUR|year"), ("changed", "b", "seniority", "senior", None),
        ("removed", "c", None, None, None), ("new", "d", None, None, None), ("new", None, None, None, None), ("removed", None, None, None, None),
    }
    new = found.filter("event = 'new' AND id = 'd'").selectExpr("title", "url", "location", "unix_micros(posted_at) % 1000000 AS us").first()
    assert tuple(new) == ("\u00fc \"q\"", "u\"\\\n\u00e9", "", 123456)
    pair = changes.pair_snapshots(now, was).filter("id = 'f'").selectExpr("unix_micros(now.posted_at) % 1000000", "was.title", "was.salary.min").first()
    assert tuple(pair) == (123456, "x", 0.0)
    # What moves is the text that breaks ties and the time, not the columns beside them.
    shown = found._jdf.queryExecution().optimizedPlan().toString()
    lines = shown.splitlines()
    below = [lines[i + 1].split("Project [")[-1] for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert len(below) == 2 and all("StructsToJson" in b and b.split("invoke(")[0].count("#") == 1 for b in below)
