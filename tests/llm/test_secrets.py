import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from vacantia.llm import secrets
from vacantia.llm.arrays import text_bytes
from vacantia.llm.automaton import Automaton

PLAIN = [
    (k, re.compile(p), n, g)
    for k, p, n, g in [
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
        ("access", r"AKIA[A-Z0-9]+", 18, 0),
        ("hex", r"[0-9a-f]+", 16, 0),
        ("github", r"gh[opsu]_[A-Za-z0-9]+", 24, 0),
        ("pem", r"-----BEGIN [A-Z ]+-----", 17, 0),
        ("slack", r"xox[abp]-[A-Za-z0-9-]+", 15, 0),
    ]
]


def plain(text):
    out = []
    for i, (kind, pattern, least, group) in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                out.append((m.start(), i, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def row(doc_id, text):
    spans = plain(text)
    base = [s for s in spans if s[0] in ("assign", "access", "hex")]
    join = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
    count = lambda k: sum(s[0] == k for s in spans)
    return (
        doc_id, count("assign"), count("access"), count("hex"),
        hashlib.sha256(join(base).encode()).hexdigest(), join(spans),
    )


PIECES = st.sampled_from(
    ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH12",
     "0123456789abcdef", "deadbeef", "é", "\n", ",", "xoxb-", "ghp_", "-----BEGIN ", "PRIVATE KEY", "-----",
     "aB3dE5gH7jK9", "zzzz", "\x00", "0" * 15, "/+_.", "漢字"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), max_size=6))
def test_scan_agrees_with_plain_expressions(texts):
    found = secrets.scan(*text_bytes(pa.array(texts, pa.string())))
    kinds = [r.kind for r in secrets.RULES]
    for i, text in enumerate(texts):
        assert [(kinds[k], a, b) for k, a, b in found.get(i, [])] == plain(text)


def test_automaton_is_minimal_and_equals_the_expression():
    one, same = Automaton([b"ab?c|abc|ac"]), Automaton([b"ab?c"])
    assert one.states == same.states == 4 and one.built >= one.states
    a = Automaton([b"[ab]{2}c+d"])
    for text in (b"abcd", b"abccccd", b"abd", b"aabcd", b"xabcdx", b"cd", b""):
        start, _ = a.pieces_with_match(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert bool(len(start)) == bool(re.search(b"[ab]{2}c+d", text))


def test_unknown_parts_of_the_language_are_refused():
    with pytest.raises(ValueError):
        Automaton([rb"a(?=b)"])


def test_query_on_documents(spark):
    from vacantia.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op7_secrets(spark, folder).collect()))
    want = sorted(row(*d) for d in docs)
    assert got == want and any(r[5] for r in got)


def test_edge_rows(spark):
    texts = [
        None, "", "token=" + "a" * 200_000, "x" * 100_000 + " secret : 'abcdefghijkl", "AKIA" * 6, "AKIA" * 6,
        "password = short", "token=secret=abcdefghijkl", "\n" * 5000 + "0123456789abcdef",
    ]
    df = spark.createDataFrame([(i, t, 1, "b") for i, t in enumerate(texts)], "doc_id long, text string, n_hex long, spans string")
    assert sorted(map(tuple, secrets.secrets(df).collect())) == [row(i, t) for i, t in enumerate(texts)]
    assert secrets.secrets(df.limit(0)).collect() == []
