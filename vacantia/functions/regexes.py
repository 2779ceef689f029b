"""Regex dialect rules, decided once.

The rule patterns come from two dialects. Both ignore case; they differ in what
``\\b``, ``\\w`` and ``\\s`` mean outside ASCII:

* ``unicode`` gives them their Unicode meaning;
* ``ascii`` spells out ASCII word boundaries (Java's own ``\\b`` is neither) and a
  wider ``\\s``.

On ASCII-only text, the usual case, the two agree with Java's plain
case-insensitive matching, which is several times cheaper. Whether a text is
ASCII-only is read off its byte length.
"""

from pyspark.sql import Column, functions as F

_ASCII_EDGE = (
    r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
)
_WIDE_SPACE = (
    r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)


def unicode_regex(pattern: str) -> str:
    return "(?iU)" + pattern


def ascii_regex(pattern: str) -> str:
    return "(?iu)" + pattern.replace(r"\b", _ASCII_EDGE).replace(r"\s", _WIDE_SPACE)


def plain_regex(pattern: str) -> str:
    return "(?i)" + pattern


def is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def has(col: Column, pattern: str, *, dialect: str = "unicode") -> Column:
    """Null-safe search: a null input does not match."""
    exact = unicode_regex(pattern) if dialect == "unicode" else ascii_regex(pattern)
    hit = F.when(is_ascii(col), col.rlike(plain_regex(pattern))).otherwise(col.rlike(exact))
    return F.coalesce(hit, F.lit(False))


def _chain(col: Column, rules: list[tuple[str, str]], spell, otherwise: Column) -> Column:
    chain = None
    for label, pattern in rules:
        hit = col.rlike(spell(pattern))
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(otherwise)


def first_rule(col: Column, rules: list[tuple[str, str]], otherwise: Column) -> Column:
    """The label of the first rule (ASCII dialect) whose pattern is found in ``col``."""
    return F.when(is_ascii(col), _chain(col, rules, plain_regex, otherwise)).otherwise(
        _chain(col, rules, ascii_regex, otherwise)
    )


def contains_any(col: Column, words: list[str]) -> Column:
    """True when any word is a plain substring (no boundaries) of ``col``."""
    return F.coalesce(col.rlike("|".join(_quote(w) for w in words)), F.lit(False))


def _quote(word: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|#&" else c for c in word)
