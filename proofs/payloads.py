"""Payload readers over bodies derived row by row from ``orders``.

Every order becomes one landed payload holding several postings, some of them to
be refused; the check SQL states the rows that must come out.
"""

from pyspark.sql import Column, DataFrame, functions as F

from proofs.base import Tables, proof, stamp
from vacantia import fixed_values as V
from vacantia.sources import AGGREGATOR_READERS, BOARD_READERS

FETCHED = "2002-01-01 00:00:00"


def _s(**fields) -> Column:
    """JSON object; Python strings are literals."""
    return F.struct(
        *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]
    )


def _key(prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.col("o_orderkey").cast("string"))


def _landed(t: Tables, source: str, body: Column, handle: Column | None = None) -> DataFrame:
    # Bodies are many times larger than their orders, and reading them costs more still: a file
    # of a few megabytes, one task's input, is dealt to all tasks of a shuffle before they are built.
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t.orders.repartition(tasks).select(
        F.lit(source).alias("source"),
        F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("company_slug"),
        (F.lit(None).cast("string") if handle is None else handle).alias("handle"),
        F.lit(0).alias("page"),
        F.lit(FETCHED).cast("timestamp").alias("fetched_at"),
        body.alias("body"),
    )


_COLUMNS = [
    "id", "company_slug", "title", "url", "location", "remote_policy", "description_md", "source",
]


def _shown(rows: DataFrame) -> DataFrame:
    firm = [c for c in rows.columns if c.startswith("company_") and c != "company_slug"]
    lists = {"company_categories", "company_industry_tags"}
    return rows.select(
        *_COLUMNS, stamp(F.col("posted_at")).alias("posted"),
        stamp(F.col("scraped_at")).alias("scraped"),
        *[(F.array_join(c, ",") if c in lists else F.col(c)).alias(c) for c in firm],
    )


def _expect(source: str, *rows: dict[str, str]) -> str:
    """Check SQL: one SELECT per posting that must come out of every payload."""
    def one(r: dict[str, str]) -> str:
        slug = r.get("slug", "'c-' || o_custkey")
        firm = "".join(f", {v} AS company_{k}" for k, v in r.get("firm", {}).items())
        return (
            f"SELECT substr(sha256({slug} || ':' || {r['url']}), 1, 16) AS id, {slug} AS company_slug, "
            f"{r['title']} AS title, {r['url']} AS url, {r.get('location', chr(39) * 2)} AS location, "
            f"{r.get('policy', 'CAST(NULL AS VARCHAR)')} AS remote_policy, "
            f"{r.get('text', chr(39) * 2)} AS description_md, '{source}' AS source, "
            f"{r.get('posted', 'CAST(NULL AS VARCHAR)')} AS posted, '{FETCHED}' AS scraped{firm} "
            f"FROM orders{r.get('where', '')}"
        )

    return " UNION ALL ".join(one(r) for r in rows)


def _register(source: str, build, expected: str) -> None:
    readers = {**BOARD_READERS, **AGGREGATOR_READERS}
    proof(expected, name=f"payload_{source}")(lambda t: _shown(readers[source](build(t))))


_DAY_SQL = "strftime(o_orderdate, '%Y-%m-%d 00:00:00')"


def _iso() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _html() -> Column:
    return F.concat(
        F.lit("<h2>Role</h2><p>Hello <b>"), F.col("o_orderpriority"),
        F.lit("</b> &amp; co</p><ul><li>one</li><li>two</li></ul>"),
    )


_MD = "'## Role' || chr(10) || chr(10) || 'Hello **' || o_orderpriority || '** & co' || chr(10) || chr(10) || '* one' || chr(10) || '* two'"
_NL2 = "chr(10) || chr(10)"

# --- boards -------------------------------------------------------------------

_register(
    "greenhouse",
    lambda t: _landed(
        t, "greenhouse",
        F.to_json(
            _s(
                jobs=F.array(
                    _s(title=F.concat(F.lit("  Dev "), _key(), F.lit(" ")),
                       absolute_url=_key("https://g.test/"), content=_html(),
                       location=_s(name=" Paris "), first_published="", updated_at=_iso()),
                    _s(title="no link", absolute_url="", content="", location=_s(name=""),
                       first_published=_iso(), updated_at=_iso()),
                    _s(title=" ", absolute_url=_key("https://g.test/u/"), content="",
                       location=_s(name=""), first_published="junk", updated_at=_iso()),
                )
            )
        ),
    ),
    _expect(
        "greenhouse",
        {"title": "'Dev ' || o_orderkey", "url": "'https://g.test/' || o_orderkey",
         "location": "'Paris'", "posted": _DAY_SQL, "text": _MD},
        {"title": "'(untitled)'", "url": "'https://g.test/u/' || o_orderkey"},
    ),
)

_register(
    "lever",
    lambda t: _landed(
        t, "lever",
        F.to_json(
            F.array(
                _s(text="Dev", hostedUrl="", applyUrl=_key("https://l.test/a/"),
                   categories=_s(location=" Lyon"), description=_html(),
                   lists=F.array(_s(text=" You ", content="<p>do</p>"), _s(text="", content=""),
                                 _s(text="Us", content="")),
                   additional="<p>Bye</p>",
                   createdAt=F.unix_millis(F.col("o_orderdate").cast("timestamp"))),
                _s(text="gone", hostedUrl="", applyUrl="", categories=_s(location=""),
                   description="", lists=F.array(_s(text="", content="")), additional="",
                   createdAt=F.lit(0).cast("bigint")),
            )
        ),
    ),
    _expect(
        "lever",
        {"title": "'Dev'", "url": "'https://l.test/a/' || o_orderkey", "location": "'Lyon'",
         "posted": _DAY_SQL,
         "text": f"{_MD} || {_NL2} || '## You' || {_NL2} || 'do' || {_NL2} || '## Us' || {_NL2} || 'Bye'"},
    ),
)

_register(
    "ashby",
    lambda t: _landed(
        t, "ashby",
        F.to_json(
            _s(data=_s(jobBoard=_s(jobPostings=F.array(
                _s(id=_key(), title="ML", locationName=" Paris ",
                   secondaryLocations=F.array(_s(locationName="Berlin"), _s(locationName=""),
                                              _s(locationName="Rome"))),
                _s(id=_key("x"), title="Ops", locationName="",
                   secondaryLocations=F.array(_s(locationName="Oslo"))),
                _s(id="", title="none", locationName="",
                   secondaryLocations=F.array(_s(locationName=""))),
            ))))
        ),
        handle=F.lit("acme"),
    ),
    _expect(
        "ashby",
        {"title": "'ML'", "url": "'https://jobs.ashbyhq.com/acme/' || o_orderkey",
         "location": "'Paris (+ Berlin, Rome)'"},
        {"title": "'Ops'", "url": "'https://jobs.ashbyhq.com/acme/x' || o_orderkey",
         "location": "'Oslo'"},
    ),
)


def _sections(title: str, html: Column | str) -> Column:
    empty = _s(title="", text="")
    return _s(
        sections=_s(companyDescription=_s(title=title, text=html), jobDescription=empty,
                    qualifications=_s(title="Need", text=""),
                    additionalInformation=_s(title="", text="<p>end</p>"))
    )


_register(
    "smartrecruiters",
    lambda t: _landed(
        t, "smartrecruiters",
        F.to_json(
            _s(content=F.array(
                _s(id="", uuid=_key("u"), name="Dev", ref="", company=_s(identifier="Acme"),
                   location=_s(city="Lille", region="", country="fr"),
                   jobAd=_sections("About", _html()), releasedDate=_iso(), createdOn=""),
                _s(id=_key(), uuid="", name="", ref=_key("https://s.test/"),
                   company=_s(identifier=""), location=_s(city="", region="", country=""),
                   jobAd=_sections("", ""), releasedDate="", createdOn=_iso()),
                _s(id="", uuid="", name="x", ref="https://s.test", company=_s(identifier=""),
                   location=_s(city="", region="", country=""), jobAd=_sections("", ""),
                   releasedDate="", createdOn=""),
            ))
        ),
    ),
    _expect(
        "smartrecruiters",
        {"title": "'Dev'", "url": "'https://jobs.smartrecruiters.com/Acme/u' || o_orderkey",
         "location": "'Lille, fr'", "posted": _DAY_SQL,
         "text": f"'## About' || {_NL2} || {_MD} || {_NL2} || '## Need' || {_NL2} || 'end'"},
        {"title": "'(untitled)'", "url": "'https://s.test/' || o_orderkey", "posted": _DAY_SQL,
         "text": f"'## Need' || {_NL2} || 'end'"},
    ),
)

_register(
    "recruitee",
    lambda t: _landed(
        t, "recruitee",
        F.to_json(
            _s(offers=F.array(
                _s(title=" Dev ", careers_url="", careers_apply_url=_key("https://r.test/"),
                   city="", country="France", description="", requirements=_html(), created_at="",
                   published_at=_iso()),
                _s(title="x", careers_url="", careers_apply_url="", city="", country="",
                   description="", requirements="", created_at="", published_at=""),
            ))
        ),
    ),
    _expect(
        "recruitee",
        {"title": "'Dev'", "url": "'https://r.test/' || o_orderkey", "location": "'France'",
         "posted": _DAY_SQL, "text": _MD},
    ),
)

_register(
    "personio",
    lambda t: _landed(
        t, "personio",
        F.concat(
            F.lit("<workzag-jobs><position><id>"), _key(),
            F.lit("</id><name> Dev </name><office>Köln</office><createdAt>"), _iso(),
            F.lit("</createdAt><jobDescriptions><jobDescription><name>Task</name><value><![CDATA[<p>a</p>]]></value>"
                  "</jobDescription><jobDescription><name></name><value>b &amp; c</value></jobDescription>"
                  "</jobDescriptions></position><position><id>1</id><name></name></position>"),
            # A body cut off in the middle does not parse and yields nothing.
            F.when(F.col("o_orderkey") % 5 == 0, "<position>").otherwise("</workzag-jobs>"),
        ),
        handle=F.lit("acme"),
    ),
    _expect(
        "personio",
        {"title": "'Dev'", "url": "'https://acme.jobs.personio.com/job/' || o_orderkey",
         "location": "'Köln'", "posted": _DAY_SQL,
         "text": f"'## Task' || {_NL2} || '<p>a</p>' || {_NL2} || 'b & c'",
         "where": " WHERE o_orderkey % 5 <> 0"},
    ),
)

_register(
    "workday",
    lambda t: _landed(
        t, "workday",
        F.to_json(
            _s(jobPostings=F.array(
                _s(title="Dev", externalPath=_key("/job/"), locationsText=" Rome "),
                _s(title="Abs", externalPath=_key("https://w.test/"), locationsText=""),
                _s(title="Rel", externalPath=_key("job/"), locationsText=""),
                _s(title="", externalPath="/job/1", locationsText=""),
                _s(title="No path", externalPath="", locationsText=""),
            ))
        ),
        handle=F.when(
            F.col("o_orderkey") % 2 == 0, "https://a.wd3.myworkdayjobs.com/wday/cxs/a/Ext/jobs"
        ).otherwise("https://a.wd3.myworkdayjobs.com/other"),
    ),
    _expect(
        "workday",
        *[
            {"title": f"'{title}'", "location": loc,
             "url": (f"CASE WHEN o_orderkey % 2 = 0 THEN 'https://a.wd3.myworkdayjobs.com/Ext' "
                     f"ELSE 'https://a.wd3.myworkdayjobs.com' END || '/job/' || o_orderkey"
                     if title != "Abs" else "'https://w.test/' || o_orderkey")}
            for title, loc in (("Dev", "'Rome'"), ("Abs", "''"), ("Rel", "''"))
        ],
    ),
)


def _bare_numbers(doc: Column) -> Column:
    """JSON text with long quoted digit runs turned into numbers."""
    return F.regexp_replace(F.to_json(doc), '"([0-9]{10,})"', "$1")


def _phenom(**fields) -> Column:
    base = {
        "slug": "", "req_id": "", "title": "", "city": "", "state": "", "country": "",
        "description": "", "location": _s(city="", state="", country="", name=""),
        "posted_date": "", "postedAt": "", "postedDate": "",
    }
    return _s(data=_s(**{**base, **fields}))


_register(
    "phenom",
    lambda t: _landed(
        t, "phenom",
        _bare_numbers(
            _s(jobs=F.array(
                _phenom(slug=_key(), title=" Dev ", city=" Turin ", country="Italy",
                        description=_html(), posted_date=_iso()),
                _phenom(req_id=_key("r"), title="Ops",
                        location=_s(city="", state="", country="Spain", name="Madrid HQ"),
                        postedDate=F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")),
                _phenom(slug="x"), _phenom(title="x"),
            ))
        ),
        handle=F.lit("https://careers.p.test/api/jobs?x=1"),
    ),
    _expect(
        "phenom",
        {"title": "'Dev'", "url": "'https://careers.p.test/jobs/' || o_orderkey",
         "location": "'Turin, Italy'", "posted": _DAY_SQL, "text": _MD},
        # 1e12 ms is 2001-09-09: a smaller number counts as seconds, far beyond any date.
        {"title": "'Ops'", "url": "'https://careers.p.test/jobs/r' || o_orderkey",
         "location": "'Spain, Madrid HQ'",
         "posted": f"CASE WHEN epoch_ms(o_orderdate::TIMESTAMP) > 1000000000000 THEN {_DAY_SQL} END"},
    ),
)

_register(
    "custom_page",
    lambda t: _landed(
        t, "custom_page",
        F.to_json(
            _s(jobs=F.array(
                _s(title="Dev", location="", url=_key("/jobs/"), remote_policy="hybrid"),
                _s(title="Dup", location="", url=_key("https://careers.acme.test/jobs/"),
                   remote_policy="hybrid"),
                _s(title="Board", location=" Paris ", url=_key("//jobs.lever.co/acme/"),
                   remote_policy="on mars"),
                _s(title="Off", location="", url="https://evil.test/1", remote_policy=""),
                _s(title="", location="", url="/x", remote_policy=""),
                _s(title="No url", location="", url=" ", remote_policy=""),
            ))
        ),
        handle=F.lit("https://careers.acme.test/open"),
    ),
    _expect(
        "custom_page",
        {"title": "'Dev'", "url": "'https://careers.acme.test/jobs/' || o_orderkey",
         "policy": "'hybrid'"},
        {"title": "'Board'", "url": "'https://jobs.lever.co/acme/' || o_orderkey",
         "location": "'Paris'"},
    ),
)

# --- aggregators --------------------------------------------------------------


def _firm(name: str, country: str, categories: str, url: str, notes: str, tags: str = "''"):
    return {"name": name, "country": country, "categories": categories, "industry_tags": tags,
            "career_url": url, "notes": notes}


def _acme() -> Column:
    return F.concat(F.lit(" Acme & Co "), F.col("o_custkey").cast("string"))


_NAME = "'Acme & Co ' || o_custkey"


def _ok(**fields) -> Column:
    names = ("legal", "company", "url", "apply_url", "position", "location", "description", "date")
    given = {n: F.lit(None).cast("string") for n in names} | {"epoch": F.lit(None).cast("bigint")}
    return _s(**{**given, **fields})


_register(
    "remoteok",
    lambda t: _landed(
        t, "remoteok",
        F.to_json(
            F.array(
                _ok(legal="terms", company="Legal", url="https://x.test"),
                _ok(company=_acme(), url="", apply_url=_key("https://ok.test/"), position="Dev",
                    location="Reunion", description=_html(), date="",
                    epoch=F.unix_seconds(F.col("o_orderdate").cast("timestamp"))),
                _ok(company=_acme(), url=_key("https://ok.test/b/"), position=" ", location="",
                    date=_iso()),
                _ok(company=_acme(), url="https://ok.test/us", position="x", location="Texas"),
                _ok(company=" ", url="https://ok.test/n", position="x", location="Europe"),
            )
        ),
    ),
    _expect(
        "remoteok",
        # "Reunion" holds "eu", so it counts as a European signal.
        {"slug": "'via-remoteok-acme-co-' || o_custkey", "title": "'Dev'",
         "url": "'https://ok.test/' || o_orderkey", "location": "'Reunion'",
         "policy": "'remote-global'", "posted": _DAY_SQL, "text": _MD,
         "firm": _firm(_NAME, "'XX'", "'tech,remote-eu'", "'https://ok.test/' || o_orderkey",
                       "'Aggregated from RemoteOK (Reunion)'")},
        {"slug": "'via-remoteok-acme-co-' || o_custkey", "title": "'(untitled)'",
         "url": "'https://ok.test/b/' || o_orderkey", "location": "'Remote'",
         "policy": "'remote-global'", "posted": _DAY_SQL,
         "firm": _firm(_NAME, "'XX'", "'tech,remote-eu'", "'https://ok.test/b/' || o_orderkey",
                       "'Aggregated from RemoteOK (Remote)'")},
    ),
)

_register(
    "weworkremotely",
    lambda t: _landed(
        t, "weworkremotely",
        F.concat(
            F.lit("<rss><channel><item><title>Acme &amp; Co "), F.col("o_custkey").cast("string"),
            F.lit(": Dev: Senior</title><link> https://w.test/"), _key(),
            F.lit("</link><description>&lt;p&gt;x&lt;/p&gt;</description><region></region><pubDate>"),
            F.date_format(F.col("o_orderdate").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss Z"),
            F.lit("</pubDate></item><item><title>No colon</title><link>https://w.test</link></item>"
                  "<item><title>: Role</title><link>https://w.test</link></item></channel></rss>"),
        ),
    ),
    _expect(
        "weworkremotely",
        {"slug": "'via-wwr-acme-co-' || o_custkey", "title": "'Dev: Senior'",
         "url": "'https://w.test/' || o_orderkey", "location": "'Remote'",
         "policy": "'remote-global'", "posted": _DAY_SQL, "text": "'<p>x</p>'",
         "firm": _firm(_NAME, "'XX'", "'tech,remote-eu'", "'https://w.test/' || o_orderkey",
                       "'Aggregated from WeWorkRemotely (Remote)'")},
    ),
)


def _jji(**fields) -> Column:
    names = ("guid", "slug", "title", "companyName", "city", "country", "workplaceType",
             "publishedAt", "lastPublishedAt")
    return _s(**{**{n: F.lit(None).cast("string") for n in names}, **fields})


def _jji_offers() -> Column:
    return F.array(
        _jji(guid="g", slug=_key("dev-"), title="Dev", companyName=_acme(), city="Gdynia",
             workplaceType="Remote", publishedAt="", lastPublishedAt=_iso()),
        _jji(guid=_key("g-"), title="", companyName=_acme(), country="deu", workplaceType="office",
             publishedAt=_iso()),
        _jji(title="x", companyName=_acme()), _jji(slug="y", title="y", companyName=""),
    )


_register(
    "justjoinit",
    lambda t: _landed(
        t, "justjoinit",
        F.when(F.col("o_orderkey") % 3 == 0, F.to_json(_jji_offers()))
        .when(F.col("o_orderkey") % 3 == 1, F.to_json(_s(data=_jji_offers())))
        .otherwise(F.to_json(_s(data=F.filter(_jji_offers(), lambda j: j["title"] == "?"), offers=_jji_offers()))),
    ),
    _expect(
        "justjoinit",
        {"slug": "'via-justjoinit-acme-co-' || o_custkey", "title": "'Dev'",
         "url": "'https://justjoin.it/offers/dev-' || o_orderkey", "location": "'Gdynia, PL'",
         "policy": "'remote'", "posted": _DAY_SQL,
         "firm": _firm(_NAME, "'PL'", "'tech'", "'https://justjoin.it/offers/dev-' || o_orderkey",
                       "'Aggregated from JustJoin.it (Gdynia)'")},
        {"slug": "'via-justjoinit-acme-co-' || o_custkey", "title": "'(untitled)'",
         "url": "'https://justjoin.it/offers/g-' || o_orderkey", "location": "'DE'",
         "policy": "'onsite'", "posted": _DAY_SQL,
         "firm": _firm(_NAME, "'DE'", "'tech'", "'https://justjoin.it/offers/g-' || o_orderkey",
                       "'Aggregated from JustJoin.it (Remote)'")},
    ),
)

_OFFICE = [("Paris", "France", "FR"), ("Lyon", "", ""), ("", "Spain", "ES"), ("Rome", "Italy", "IT")]


def _hit(name: str, slug: Column | str, sector: str, offices: bool, **fields) -> Column:
    places = F.array(*[_s(city=a, country=b, country_code=c) for a, b, c in _OFFICE])
    base = dict(
        name=name, slug=slug, language="de", remote="partial", published_at=_iso(),
        organization=_s(slug="Acme Org", name="Acme", nb_employees=F.col("o_custkey")),
        offices=places if offices else F.slice(places, 1, 0),
        sectors_name=_s(en=F.array(F.create_map(F.lit(sector), F.lit("Other")))),
    )
    return _s(**{**base, **fields})


_FASHION = V.LANE_SECTORS[0]
_register(
    "wttj",
    lambda t: _landed(
        t, "wttj",
        F.to_json(
            _s(hits=F.array(
                _hit(" Data Lead ", _key("d-"), "Hotels", True),
                _hit("Chef", _key("c-"), "SaaS", False, language="fr", remote="fulltime"),
                _hit("Chef", _key("n-"), "Hotels", True),
                _hit("Buyer", _key("b-"), _FASHION, False, remote="no"),
                _hit("Data", "", "SaaS", True),
            ))
        ),
        handle=F.when(F.col("o_orderkey") % 2 == 1, "lane"),
    ),
    _expect(
        "wttj",
        {"slug": "'wttj-acme-org'", "title": "'Data Lead'", "where": " WHERE o_orderkey % 2 = 0",
         "url": "'https://www.welcometothejungle.com/en/companies/Acme Org/jobs/d-' || o_orderkey",
         "location": "'Paris, France; Lyon; Spain; Rome, Italy'", "policy": "'hybrid'", "posted": _DAY_SQL,
         "firm": _firm("'Acme'", "'FR'", "'tech'", "'https://www.welcometothejungle.com/en/companies/Acme Org'",
                       "'Aggregated from Welcome to the Jungle (' || o_custkey || ' employees)'")},
        {"slug": "'wttj-acme-org'", "title": "'Chef'", "where": " WHERE o_orderkey % 2 = 0",
         "url": "'https://www.welcometothejungle.com/fr/companies/Acme Org/jobs/c-' || o_orderkey",
         "policy": "'remote'", "posted": _DAY_SQL,
         "firm": _firm("'Acme'", "'XX'", "'tech'", "'https://www.welcometothejungle.com/en/companies/Acme Org'",
                       "'Aggregated from Welcome to the Jungle (' || o_custkey || ' employees)'")},
        {"slug": "'wttjc-acme-org'", "title": "'Buyer'", "where": " WHERE o_orderkey % 2 = 1",
         "url": "'https://www.welcometothejungle.com/en/companies/Acme Org/jobs/b-' || o_orderkey",
         "posted": _DAY_SQL,
         "firm": _firm("'Acme'", "'XX'", "''", "'https://www.welcometothejungle.com/en/companies/Acme Org'",
                       "'Aggregated from Welcome to the Jungle (' || o_custkey || ' employees) — fashion lane.'",
                       "'fashion'")},
    ),
)

_FJ = "'https://fr.fashionjobs.com/emploi/"
_register(
    "fashionjobs",
    lambda t: _landed(
        t, "fashionjobs",
        F.concat(
            F.lit('<ul><li><a href="https://fr.fashionjobs.com/emploi/Louis-vuitton/Acheteur-mode-H-f,'),
            _key(), F.lit('.html">x</a></li><li><a href="https://fr.fashionjobs.com/emploi/bad_slug/X,1.html">'
                          '</a><a href="https://fr.fashionjobs.com/other/a/b,1.html">'),
            F.lit('<a href="http://www.fashionjobs.com/emploi/ba-sh/chef,'), _key(), F.lit('.html">'),
        ),
    ),
    _expect(
        "fashionjobs",
        {"slug": "'fjr-louis-vuitton'", "title": "'Acheteur mode h f'", "location": "'France'",
         "url": f"{_FJ}Louis-vuitton/Acheteur-mode-H-f,' || o_orderkey || '.html'",
         "firm": _firm("'Louis Vuitton'", "'FR'", "''", "'https://fr.fashionjobs.com/recrutement/Louis-vuitton.html'",
                       "'Aggregated from fashionjobs.com (fashion lane).'", "'fashion'")},
        {"slug": "'fjr-ba-sh'", "title": "'Chef'", "location": "'France'",
         "url": "'http://www.fashionjobs.com/emploi/ba-sh/chef,' || o_orderkey || '.html'",
         "firm": _firm("'Ba Sh'", "'FR'", "''", "'https://fr.fashionjobs.com/recrutement/ba-sh.html'",
                       "'Aggregated from fashionjobs.com (fashion lane).'", "'fashion'")},
    ),
)


def _item(
    number: str, path: Column, title: str, place: str, brand: str | None, filler: int = 0
) -> list[Column]:
    logo = ("" if brand is None else f'<img alt="{brand} logo">') + "<i></i>" * filler
    return [
        F.lit(f'<li class="lister__item cf" id="item-{number}">{logo}<h3><a class="js" href=" /careers/job/'),
        path,
        F.lit(f'/dev/ "> <span>{title}</span></a></h3><ul><li class="lister__meta-item '
              f'lister__meta-item--location">{place}</li></ul></li>'),
    ]


_register(
    "bof",
    lambda t: _landed(
        t, "bof",
        F.concat(
            F.lit("<section>"),
            *_item("1", _key(), "ACME Paris - Buyer", " Paris, france ", "Acme Paris"),
            *_item("2", _key("9"), "Writer", "Fully remote", None),
            *_item("3", _key("8"), "Chef", "Texas", "Acme"),
            *_item("4", _key("7"), "Acme", "EMEA remote", "Acme"),
            *_item("5", _key("6"), "Acme Late", "Berlin, Germany", "Acme", filler=900),
            F.lit('</section><a href="/careers/job/1/x"><span>outside</span></a>'),
        ),
    ),
    _expect(
        "bof",
        *[
            {"slug": slug, "title": title, "location": place, "policy": policy,
             "url": f"'https://www.businessoffashion.com/careers/job/{n}' || o_orderkey || '/dev/'",
             "firm": _firm(brand, country, "''", "'https://www.businessoffashion.com/careers/'",
                           "'Aggregated from Business of Fashion Careers (fashion lane).'", "'fashion'")}
            for slug, title, place, policy, n, brand, country in (
                ("'bof-acme-paris'", "'Buyer'", "'Paris, france'", "CAST(NULL AS VARCHAR)", "", "'Acme Paris'", "'FR'"),
                ("'bof-unknown'", "'Writer'", "'Fully remote'", "'remote-global'", "9", "'Unknown'", "'XX'"),
                ("'bof-acme'", "'Acme'", "'EMEA remote'", "'remote-eu'", "7", "'Acme'", "'XX'"),
                ("'bof-acme'", "'Late'", "'Berlin, Germany'", "CAST(NULL AS VARCHAR)", "6", "'Acme'", "'DE'"),
            )
        ],
    ),
)
