import random
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vacantia import fixed_values as V
from vacantia.functions import classify as C
from vacantia.functions import ids, money, tagging, text, times, urls


def test_stable_id_depends_on_company_and_url(run):
    a, b, c = run(ids.stable_id, [("acme", "u"), ("acme", "v"), ("other", "u")])
    assert len({a, b, c}) == 3 and all(len(x) == 16 for x in (a, b, c))
    import hashlib

    assert a == hashlib.sha256(b"acme:u").hexdigest()[:16]


def test_slugs(run):
    long = "Very " * 20
    assert run(ids.slugify, ["  Acme & Co.", "", None, "!!!", long]) == [
        "acme-co", "unknown", "unknown", "unknown", ("very-" * 20)[:48],
    ]
    assert run(ids.path_slug, ["Développeur Sénior (H/F)", "ﬁne №5 ½", "ＦＵＬＬ width", "Łódź", ""]) == [
        "developpeur-senior-h-f", "fine-o5-1-2", "full-width", "odz", "",
    ]
    assert run(ids.job_path, [("acme", "", "0123456789abcdef")]) == ["acme/job-01234567"]
    assert run(ids.company_from_slug, ["louis-vuitton--malletier"]) == ["Louis Vuitton Malletier"]
    assert run(ids.title_from_slug, ["Alternance-assistant-PAP"]) == ["Alternance assistant pap"]


def test_path_slug_agrees_with_unicode_decomposition(run):
    import re
    import unicodedata

    def expected(s):
        s = unicodedata.normalize("NFKD", s.lower())
        s = re.sub("[̀-ͯ]", "", s)
        return re.sub("[^a-z0-9]+", "-", s).strip("-")[:60].rstrip("-")

    chars = [chr(c) for c in range(0xA0, 0x3400) if not 0xD800 <= c < 0xE000 and chr(c).isprintable()]
    words = [f"a{c}b" for c in chars]
    # Skip characters whose case mapping differs between the two Unicode versions.
    words = [w for w in words if len(w.lower()) == 3]
    got = run(ids.path_slug, words)
    wrong = [(w, g, expected(w)) for w, g in zip(words, got) if g != expected(w)]
    assert len(wrong) <= 2, wrong[:10]


def test_slug_candidates(run):
    got = run(ids.slug_candidates, ["mistralai", "acme-hq", "zinc", "google", "ab", "openteam"])
    assert [sorted(x) for x in got] == [
        ["mistral", "mistralai"], ["acme", "acme-hq"], ["zinc"], [], [], ["open", "openteam"],
    ]


def test_timestamps(run):
    assert run(times.iso_time, ["2026-04-15T10:30:00Z", "2026-04-15T10:30:00+02:00", "yesterday", "", None]) == [
        datetime(2026, 4, 15, 10, 30), datetime(2026, 4, 15, 8, 30), None, None, None,
    ]
    assert run(times.rfc822_time, ["Wed, 15 Apr 2026 10:30:00 +0000", "15 Apr 2026 10:30:00 +0200", "x"]) == [
        datetime(2026, 4, 15, 10, 30), datetime(2026, 4, 15, 8, 30), None,
    ]
    large = lambda c: times.iso_or_epoch(c, millis="large")
    assert run(large, ["1700000000000", "1700000000", "2026-01-01T00:00:00Z", "9e18"]) == [
        datetime(2023, 11, 14, 22, 13, 20), datetime(2023, 11, 14, 22, 13, 20),
        datetime(2026, 1, 1), None,
    ]


def test_age_labels(run):
    now = F.lit("2026-05-03 12:00:00").cast("timestamp")
    days = ["2026-05-03 01:00:00", "2026-05-02 11:00:00", "2026-04-28 12:00:00", "2026-04-20 12:00:00",
            "2026-01-01 00:00:00", "2026-05-04 00:00:00", "58000-01-01 00:00:00", None]
    got = run(lambda c: times.age_label(c.try_cast("timestamp"), now), days)
    assert got == ["TODAY", "1D", "5D", "2W", "4MO", "", "", ""]


@pytest.mark.parametrize(
    "cases",
    [
        {"San Francisco, CA": True, "New York": True, "USA": True, "Remote - US": True,
         "Toronto, Canada": True, "Bengaluru, India": True, "Tokyo": True, "Austin, TX": True},
        {"Paris, France": False, "Berlin, DE": False, "München": False, "MÜNCHEN": False,
         "Remote": False, "Worldwide": False, "": False, "   ": False, None: False},
        {"London or New York": False, "Europe / US": False, "Remote — Worldwide, USA": False},
        # A two-letter suffix counts as a US state unless the city is known as European.
        {"Leipzig, DE": True, "U.S.": False, "U.S.A": True, "Industry": False,
         "Österreich": False, "Zürich": False},
    ],
)
def test_non_eu_location(run, cases):
    assert dict(zip(cases, run(C.non_eu_location, list(cases)))) == cases


def test_keep_rule(run):
    rows = [
        ("Engineer", None, "San Francisco"), ("Engineer", "remote-global", "San Francisco"),
        ("Engineer", "remote-eu", "Texas, TX"), ("Barista", "remote-eu", "Paris"),
        ("Engineer", "remote", "Boston"), (None, None, None),
    ]
    assert run(C.keep_job, rows) == [False, True, True, False, False, True]


def test_eu_signal_uses_substrings(run):
    cases = {"": True, None: True, "Reunion": True, "Ukraine": True, "US remote": True, "Texas": False}
    assert run(C.eu_signal, list(cases)) == list(cases.values())


def test_eu_or_remote_priority(run):
    got = run(C.eu_or_remote, ["Worldwide, France", "remote in europe", "united kingdom", "Texas", "", None])
    assert [tuple(r) for r in got] == [
        (True, "XX", "remote-global"), (True, "XX", "remote-eu"), (True, "GB", None),
        (False, None, None), (False, None, None), (False, None, None),
    ]


def test_title_rules(run):
    assert run(C.employment_type, ["Marketing Intern", "Internal Auditor", "Werkstudent", "Freelancer", None, "Contract dev"]) == [
        "internship", "permanent", "apprenticeship", "freelance", "permanent", "permanent",
    ]
    assert run(C.role_of_title, ["ML Engineer", "HR Manager", "Data Analyst", "Product Designer", "Gardener", "", None]) == [
        "ml-ai", "hr", "data", "design", None, None, None,
    ]
    # ASCII word boundaries: the accent ends the word.
    assert run(C.role_of_title, ["éae", "SREé", "Ingénieur software"]) == ["sales", "engineering", "engineering"]
    remote = run(C.remote_of_text, [("Dev (Remote, EU)", ""), ("Dev", "Fully remote"), ("Dev hybrid", "Remote"), ("", None)])
    assert remote == ["remote-eu", "remote-global", "hybrid", None]


def test_where_bucket(run):
    cases = [
        (("remote-global", "Paris", "FR"), V.WHERE_WORLDWIDE),
        ((None, "Anywhere in the World", None), V.WHERE_WORLDWIDE),
        ((None, "Remote - EU", None), V.WHERE_EUROPE),
        ((None, "Venice, Italy", None), "Italy"),
        ((None, "Lyon or Berlin", None), "Germany"),  # table order, not text order
        ((None, "Kraków", "PL"), "Poland"),
        ((None, "Den Haag", None), V.WHERE_OTHER),
        ((None, "San Francisco, CA", "US"), "Canada"),
        ((None, "NAMER", "US"), V.WHERE_OTHER),
        ((None, "Hybrid", "EE"), "Estonia"),
        (("remote", "", None), V.WHERE_REMOTE),
        ((None, "remote / unknown", None), "Remote / unknown"),
        ((None, "Unterföhring, DE", None), "Germany"),
    ]
    assert run(C.where_bucket, [c for c, _ in cases]) == [w for _, w in cases]


def test_lane_rules(run):
    got = run(C.lane_title, ["Acheteuse", "Chef de produit", "Junior Buyer", "Head of Buying", "Assistant buyer", "Dev", "Stagiaire acheteur", None])
    assert got == [True, True, False, True, False, False, False, False]
    assert run(C.excluded_company, ["chanel", "wttjc-chanel-mode", "fjr-chanel", "chanelle", "co-chanel"]) == [
        True, True, True, False, False,
    ]
    assert run(C.france_or_remote, [("remote-eu", "", "DE"), (None, "Lille, FR", None), (None, "Rome", "FR"), (None, "Rome", "IT")]) == [
        True, True, True, False,
    ]


def test_boilerplate(run):
    doc = "Intro\n## About us\nWe are.\n## Role\nCode with benefits galore\n## Stack\nSpark"
    assert run(text.strip_boilerplate, [doc, "", None]) == [
        "Intro\n## ## Role\nCode with ## Stack\nSpark", "", "",
    ]


def test_boilerplate_anchor_is_newline_only(run):
    assert run(text.strip_boilerplate, ["x benefits a\r## kept out"]) == ["x"]


def test_grounding(run):
    got = run(text.grounded, [(["Python", "Rust", ""], "we use python"), (None, "x"), (["a"], None)],
              ["array<string>", "string"])
    assert got == [["Python"], [], []]


def test_html_to_markdown(run):
    html = "<h2>Role</h2>\n<p>Be <b>bold</b> &amp; <i>kind</i></p><ul><li>a</li><li>b</li></ul><a href='#'>x</a> <a href=\"/y\">y</a>"
    assert run(text.html_to_markdown, [html, "", None]) == [
        "## Role\n\nBe **bold** & *kind*\n\n* a\n* b\n\nx [y](/y)", "", "",
    ]
    page = "<p>a</p><script>if (a<b) {}</script><style>p{}</style><p>b</p>"
    assert run(text.page_text, [page, "<p>" + "x" * 40000]) == ["a\n\nb", "x" * 40000]
    assert run(lambda c: text.page_text(c, 32000), ["<p>" + "x" * 40000]) == ["x" * 32000]
    for blank in ("<br>", "<p></p>", "<br />\n", " \t<div> </div>"):
        assert run(text.page_text, ["a" + blank * 100_000 + "b"]) == ["a\n\nb"]


# What the tags of well-formed pages become, as a chain of rules over the whole text.
_CHAIN = [
    (r"(?is)<script\b.*?</script>", ""), (r"(?is)<style\b.*?</style>", ""),
    (r"(?is)<(?:!--.*?-->|head\b.*?</head>|!doctype[^>]*>)", ""), (r"[ \t\r\n]+", " "), (r"(?i) ?<br ?/?> ?", "  \n"),
    (r"(?i)<h([1-6])\b[^>]*>\s*", "\n\n\x01\\1 "),
    (r"(?i)(?:(?<!\s)\s+)?</h[1-6]>\s*|</?(?:ul|ol|p|div|section|article|table|tr|blockquote)\b[^>]*>", "\n\n"),
    (r"(?i)<li\b[^>]*>\s*", "\n* "), (r"(?i)</?(?:b|strong)\b[^>]*>", "**"), (r"(?i)</?(?:i|em)\b[^>]*>", "*"),
    (r"""(?i)<a\b[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>""", r"[\2](\1)"), (r"(?i)(?:(?<!\s)\s+)?</li>|<[^>]+>", ""),
]


def chain(page):
    for pattern, repl in _CHAIN:
        page = re.sub(pattern, repl, page)
    for n in range(1, 7):
        page = page.replace(f"\x01{n}", "#" * n)
    for old, new in text._ENTITIES:
        page = page.replace(old, new)
    return re.sub(r"[ \t]*\n[ \t\n]*\n", "\n\n", page).strip(" \t\n")


def test_scanned_tags_against_the_rules(run):
    """Random runs of tags and text give what the chain of rules gives."""
    rng = random.Random(11)
    parts = [
        "a", "b c", " ", "\n", "  x ", "&amp;", ">", "<br>", "<BR/>", "<br class=x>", "<h1>", "</h1>", "<h2 id=a> ", " </H2>", "<h7>", "</h2 >",
        "<p>", "</p>", "<div class='q'>", "<tr>", "<ul>", "<li>", "<li > ", " </li>", "</LI>", "<b>", "</strong>", "<em>", "</i>", "<bold>",
        '<a href="/u">', '<a class="z" HREF="v" x>', "<a>", "</a>", "<span>", "</span> ", "<!-- c <b> -->", "<script>if (a) {}</script>",
        "<style>p{}</style>", "<!DOCTYPE html>", "<head><title>t</title></head>", "<img src='i'>", "<>", "<header>", "<p/>", "</p-x>",
    ]
    pages = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(3000)]
    assert run(text.page_text, pages) == [chain(p) for p in pages]


def test_openings_without_an_end_are_text(run):
    pages = [
        "a < b <b>c</b>", "x <!-- y", "<!-- a <!-- b --> c <!-- d", "<script>a", "<SCRIPT>a</script>b<script>c", "1 < 2 > 3", "<",
        "a<", "<p", "--> a", "<!---->b", "x\x01\x08y<p>z", "<head>a<head>b</head>c", "</script>a",
    ]
    assert run(text.page_text, pages) == [
        "a < b **c**", "x <!-- y", "c <!-- d", "a", "bc", "1  3", "<", "a<", "<p", "--> a", "b", "x\x08y\n\nz", "c", "a",
    ]


@pytest.mark.parametrize("opening", ["<", "<!--", "<a ", "<head ", "<script ", "<p>", "</li>", '<a href="', "<h1> ", " <br>", "&lt;", "> ", "<li> "])
def test_hostile_pages_take_linear_time(spark, opening):
    """A megabyte of one opening: the work grows with the page, not with its square."""
    def seconds(n):
        pages = spark.range(0, 1, 1, 1).select(F.repeat(F.lit(opening), F.lit(n) + F.col("id").cast("int")).alias("html"))
        started = time.perf_counter()
        pages.select(F.length(text.page_text(F.col("html")))).collect()
        return time.perf_counter() - started

    n = (1 << 20) // len(opening)
    small, large = seconds(n // 8), seconds(n)
    assert large < 24 * max(small, 0.25) and large < 60


def test_links_and_names(run):
    md = "[Acme](https://acme.test) [gh](https://github.com/a) [ B c ](http://b.test/x) [x](https://a.test/#h)"
    assert [[tuple(p) for p in r] for r in run(text.markdown_links, [md])] == [
        [("Acme", "https://acme.test"), ("B c", "http://b.test/x")]
    ]
    assert run(text.leading_name, ["<p>Acme Inc | Dev</p>", "Hey - you", "lower | x", ""]) == ["Acme Inc", None, None, None]
    assert run(text.ascii_safe, ["a — é 😀"]) == ["a ? ? ?"]
    assert run(text.brand_in_body, [("L'Oréal", "…lo réal…"), ("Acme", "x a c-m e y")]) == [True, True]


def test_urls(run):
    base = "https://careers.acme.co.uk/jobs/list?x=1"
    assert run(lambda u: urls.absolute_url(u, F.lit(base)), ["https://x.test/1", "//x.test/1", "/a", "a/b"]) == [
        "https://x.test/1", "https://x.test/1", "https://careers.acme.co.uk/a", "https://careers.acme.co.uk/a/b",
    ]
    assert run(urls.registrable_domain, [base, "http://localhost:80/x", "mailto:a@b"]) == ["co.uk", "localhost", ""]
    ok = run(lambda u: urls.plausible_job_url(u, F.lit("acme.com")),
             ["https://jobs.acme.com/1", "https://jobs.lever.co/acme", "https://evil.test", "/rel", ""])
    assert ok == [True, True, False, False, False]
    boards = {
        "https://boards.greenhouse.io/acme/jobs/1": ("greenhouse", "acme"),
        "https://jobs.ashbyhq.com/acme": ("ashby", "acme"), "https://acme.ashbyhq.com/": ("ashby", "acme"),
        "https://jobs.lever.co/": None, "https://acme.jobs.personio.de/x": ("personio", "acme"),
        "https://a.wd3.myworkdayjobs.com/wday/cxs/a/S/jobs": ("workday", "https://a.wd3.myworkdayjobs.com/wday/cxs/a/S/jobs"),
        "https://a.wd3.myworkdayjobs.com/S": None, "https://acme.com": None,
    }
    got = run(urls.board_of, list(boards))
    assert [None if g is None else tuple(g) for g in got] == list(boards.values())


def test_country_requests(run):
    got = run(urls.country_requests, ["https://c.test/api?q=1&_phenom_countries=Germany,United%20Kingdom", "https://c.test/api"])
    assert got == [
        ["https://c.test/api?q=1&country=Germany", "https://c.test/api?q=1&country=United%20Kingdom"],
        ["https://c.test/api"],
    ]


def test_salary_band(run):
    kinds = ["double", "double", "string", "string"]
    got = run(money.band, [(1.0, 2.0, "EUR", None), (None, 2.0, "EUR", "day"), (3.0, 2.0, "EUR", "year"),
                           (None, None, "EUR", "year"), (1.0, 2.0, "EURO", "year"), (1.0, 2.0, None, None)], kinds)
    assert [None if g is None else tuple(g) for g in got] == [
        (1.0, 2.0, "EUR", "year"), (None, 2.0, "EUR", "day"), None, None, None, None,
    ]
    label = run(money.salary_label, [(80000.0, 110000.0, "EUR", "year"), (500.0, 500.0, "GBP", "day"),
                                     (None, 2500.0, "CZK", "month"), (1.0, 2.0, None, None), (None, None, "EUR", None)], kinds)
    assert label == ["€80k–110k", "£500/d", "CZK 3k/mo", "", ""]


def test_answer_normalising(run):
    body = ('{"seniority": " Senior", "role_family": "Software Engineering", "remote_policy": "moon", '
            '"visa_sponsorship": %s, "stack": ["Spark", "Go"], "salary_min": "100", "salary_currency": "pln", "salary_period": "Hour"}')

    def fields(c):
        n = tagging.normalised_answer(tagging.parse_answer(c), F.lit("we use SPARK"))
        return F.struct(*[v.alias(k) for k, v in n.items()])

    got = run(fields, [body % "true", body % '"yes"', body % '"true"', "not json"])
    assert got[0]["seniority"] == "senior" and got[0]["role_family"] == "engineering"
    assert got[0]["remote_policy"] is None and got[0]["stack"] == ["Spark"]
    assert tuple(got[0]["salary"]) == (100.0, 100.0, "PLN", "hour")  # no sign: always supported
    assert [g["visa_sponsorship"] for g in got] == [True, None, None, None]
    ungrounded = run(lambda a: money.canonical_band(a, a, F.lit("EUR"), F.lit("year"), F.lit("nothing")), ["90000"])
    assert ungrounded == [None]


def test_prompt_rows(run):
    got = run(lambda t, d: tagging.messages("v2_few_shot", t, d), [("Dev", "x" * 7000), ("Dev", "")])
    assert got[0][0]["role"] == "system" and got[0][1]["content"].endswith("\n" + "x" * 7000)
    cut = run(lambda t, d: tagging.messages("v2_few_shot", t, d, 5500), [("Dev", "x" * 7000)])
    assert cut[0][1]["content"].endswith("\n" + "x" * 5500)
    assert got[1][1]["content"].endswith(V.NO_DESCRIPTION)
    with pytest.raises(ValueError):
        tagging.messages("nope", F.col("a"), F.col("a"))
