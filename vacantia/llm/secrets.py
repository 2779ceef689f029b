"""Secret scans: all rules in one byte pass over a combined deterministic automaton.

The automaton (see ``automaton``) marks the pieces of text that hold a match of any rule;
the rules' own expressions then give the spans inside those few pieces. A piece lies
between bytes that no match of any rule can contain, so matches found in it are those of
the whole text: leftmost and non-overlapping per kind, those that are too short dropped.

Defined cases: a null or empty text has no findings; every row is scanned by itself, so
repeated rows give repeated results; a text of any length is scanned whole.
"""

import hashlib
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacantia.llm.arrays import parts, text_bytes
from vacantia.llm.automaton import Automaton

PART_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: bytes  # what a match looks like, whatever its length
    shortest: bytes  # how a match that is long enough begins, for the automaton
    least: int  # bytes that the match, or its group ``value``, has at least
    value: int = 0


# The base rules, in the order in which kinds are listed.
BASE = (
    Rule(
        "assign",
        rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12})""",
        12, 2,
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", rb"AKIA[A-Z0-9]{14}", 18),
    Rule("hex", rb"[0-9a-f]+", rb"[0-9a-f]{16}", 16),
)
# Rules that the method adds; their spans are listed besides the base ones.
ADDED = (
    Rule("github", rb"gh[opsu]_[A-Za-z0-9]+", rb"gh[opsu]_[A-Za-z0-9]{6}", 24),
    Rule("pem", rb"-----BEGIN [A-Z ]+-----", rb"-----BEGIN [A-Z ]+-----", 17),
    Rule("slack", rb"xox[abp]-[A-Za-z0-9-]+", rb"xox[abp]-[A-Za-z0-9-]{4}", 15),
)
RULES = BASE + ADDED


@cache
def compiled(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton([r.shortest for r in rules])


def scan(
    buf: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...] = RULES,
    automaton: Automaton | None = None,
) -> dict[int, list]:
    """(rule number, start, end) of all findings of each text that has any, in code points."""
    automaton = automaton or compiled(rules)
    patterns = [re.compile(r.pattern) for r in rules]
    found: dict[int, list] = {}
    starts, ends = automaton.pieces_with_match(buf, offsets)
    texts = np.searchsorted(offsets, starts, "right") - 1
    for t, a, b in zip(texts.tolist(), starts.tolist(), ends.tolist()):
        piece = buf[a:b].tobytes()
        for k, (rule, pattern) in enumerate(zip(rules, patterns)):
            for m in pattern.finditer(piece):
                if m.end(rule.value) - m.start(rule.value) >= rule.least:
                    found.setdefault(t, []).append((k, a + m.start(), a + m.end()))
    out = {}
    for t, spans in found.items():
        first = int(offsets[t])
        # Code points before a byte: all bytes but the continuing ones (10xxxxxx).
        points = np.r_[0, np.cumsum((buf[first : int(offsets[t + 1])] & 0xC0) != 0x80)]
        out[t] = sorted(
            ((k, int(points[a - first]), int(points[b - first])) for k, a, b in spans),
            key=lambda s: (s[1], s[0]),
        )
    return out


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """Findings of every document; the first ``base`` rules are counted and hashed."""
    kinds = [r.kind for r in rules]
    counts = [f"n_{k}" for k in kinds[:base]]
    schema = "doc_id long, " + "".join(f"{c} long, " for c in counts) + "base_sha256 string, spans string"
    # Built once; its size depends on the rules alone (about 1 MB for these).
    shared = docs.sparkSession.sparkContext.broadcast(compiled(rules))

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                found = scan(*text_bytes(part.column("text")), rules, shared.value)
                n = part.num_rows
                tally = np.zeros((base, n), np.int64)
                digest = [hashlib.sha256(b"").hexdigest()] * n
                listed = [""] * n
                for t, spans in found.items():
                    text = [f"{kinds[k]}:{a}:{b}" for k, a, b in spans]
                    listed[t] = ",".join(text)
                    of_base = ",".join(s for s, (k, _, _) in zip(text, spans) if k < base)
                    digest[t] = hashlib.sha256(of_base.encode()).hexdigest()
                    for k, _, _ in spans:
                        if k < base:
                            tally[k, t] += 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), *map(pa.array, tally), pa.array(digest), pa.array(listed)],
                    ["doc_id", *counts, "base_sha256", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
