from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from vacantia.llm import mixing, queries

SCHEMA = "doc_id long, source string, text string, slot string"


@settings(max_examples=80, deadline=None)
@given(
    st.dictionaries(st.sampled_from("abcdefgh"), st.tuples(st.integers(0, 300), st.floats(0.01, 100)), min_size=1),
    st.integers(1, 60),
)
def test_less_than_one_block_from_the_target(sources, run):
    blocks = {s: n for s, (n, _) in sources.items()}
    weights = {s: w for s, (_, w) in sources.items()}
    taken, seen = {}, Counter()
    old, mixing.RUN = mixing.RUN, run
    try:
        found = list(mixing.phases(blocks, weights))
        for phase in found:
            total = sum(Fraction(weights[s]) for s in phase.sources)
            held = Counter()
            for start, end in phase.runs(0, 10**9):
                for s, block, number, slot, release, due in phase.slots(start, end):
                    assert number == phase.number and block == seen[s] and release <= slot < due and slot not in taken
                    taken[slot] = s
                    seen[s] += 1
                    held[s] += 1
                    n = slot - phase.begin + 1
                    # Against the target itself, not against the shares made of it.
                    for x in phase.sources:
                        assert abs(held[x] - n * Fraction(weights[x]) / total) < 1 + Fraction(1, 10**9)
    finally:
        mixing.RUN = old
    assert sorted(taken) == list(range(sum(blocks.values())))
    assert seen == Counter({s: n for s, n in blocks.items() if n})
    assert len(found) <= len(blocks)


def test_no_drift_over_many_blocks():
    weights = {"a": 1.0, "b": 2**0.5, "c": 3**0.5, "rare": 0.001}
    blocks = {"a": 30_000, "b": 40_000, "c": 50_000, "rare": 40}
    phase = next(mixing.phases(blocks, weights))
    total = sum(map(Fraction, weights.values()))
    runs = list(phase.runs(0, 10**9))
    assert runs[0][1] > mixing.RUN and len(runs) > 10
    for t, _ in runs:
        for s, n in zip(phase.sources, phase.served(t)):
            assert abs(n - t * Fraction(weights[s]) / total) < 1


def test_runs_of_tasks_meet(monkeypatch):
    blocks, weights = {s: 40 + 17 * i for i, s in enumerate("abcde")}, {s: 1.0 + i * i for i, s in enumerate("abcde")}
    whole = [r for rows in mixing.placed(blocks, weights, 0, 10**9) for r in rows]
    monkeypatch.setattr(mixing, "RUN", 3)
    parts = [
        r for low in range(0, len(whole), 50) for rows in mixing.placed(blocks, weights, low, low + 50) for r in rows
    ]
    assert [r[3] for r in parts] == list(range(len(whole)))
    assert sorted(r[:2] for r in parts) == sorted(r[:2] for r in whole)


def test_many_sources():
    blocks = {f"s{i}": 1 + i % 7 for i in range(300)}
    slots = [r for rows in mixing.placed(blocks, {s: 1.0 + int(s[1:]) % 5 for s in blocks}, 0, 10**9) for r in rows]
    assert [r[3] for r in slots] == list(range(sum(blocks.values())))


def rows():
    out = [(i, "hot", f"text {i}", "x") for i in range(700)]
    out += [(1000 + i, f"s{i % 5}", "same", "x") for i in range(333)]
    return out + [(None, None, "a", "x"), (None, None, "b", "x"), (2, "", None, "x"), (3, "s1", "r", "x"), (3, "s1", "r", "x")]


@pytest.mark.parametrize("bucket", [10_000, 50])
def test_plan_holds_every_row_once(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    df = spark.createDataFrame(rows(), SCHEMA)
    got = mixing.plan(df, block_rows=8).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((r[0], r[1] or "") for r in rows())
    blocks = defaultdict(list)
    for r in got:
        assert r["release"] <= r["slot"] < r["deadline"]
        blocks[r["slot"]].append((r["source"], r["block"], r["place"]))
    assert sorted(blocks) == list(range(len(blocks)))
    for held in blocks.values():
        assert len({h[:2] for h in held}) == 1 and sorted(h[2] for h in held) == list(range(len(held)))
    assert sum(len(h) < 8 for h in blocks.values()) <= 7


def test_targets_are_met_from_the_start(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "t", "x") for i in range(2000)], SCHEMA)
    got = mixing.plan(df, {"a": 3.0, "b": 1.0, "unused": 5.0}, block_rows=10).collect()
    first = [r["source"] for r in got if r["slot"] < 100]
    assert abs(first.count("a") - 750) <= 10
    with pytest.raises(ValueError):
        mixing.plan(df, {"a": 1.0})


def test_mixed_keeps_rows_and_columns_in_slot_order(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    out = mixing.mixed(df, block_rows=8)
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, rows()))
    slots = {(r["doc_id"], r["source"]): r["slot"] for r in mixing.plan(df, block_rows=8).collect()}
    along = [slots[r[0], r[1] or ""] for r in got if r[0] is not None]
    assert along == sorted(along)
    assert mixing.plan(df.limit(0)).collect() == [] and mixing.mixed(df.limit(0)).collect() == []


def test_query_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = queries.op3_mixing(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
