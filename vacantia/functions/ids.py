"""Identifiers, slugs and page paths."""

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V
from vacantia.functions.regexes import is_ascii
from vacantia.functions.text import or_else, strip_computed


def stable_id(slug: Column, url: Column) -> Column:
    """Same posting, same id on every run."""
    return F.substring(F.sha2(F.concat(slug, F.lit(":"), url), 256), 1, 16)


def slugify_uncapped(name: Column) -> Column:
    # Outer white space turns into dashes, which go at both ends.
    low = F.lower(F.coalesce(name, F.lit("")))
    return F.btrim(F.regexp_replace(low, "[^a-z0-9]+", "-"), F.lit("-"))


def slugify(name: Column) -> Column:
    """Slug cut to 48 characters (may end in ``-`` after the cut); empty gives ``unknown``."""
    return or_else(F.substring(slugify_uncapped(name), 1, V.SLUG_LIMIT), F.lit("unknown"))


def prefixed_slug(prefix: str, slug: Column) -> Column:
    return F.substring(F.concat(F.lit(prefix), slug), 1, V.PREFIXED_SLUG_LIMIT)


def is_slug(slug: Column) -> Column:
    return F.coalesce(slug.rlike(V.SLUG_PATTERN), F.lit(False))


@cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition minus U+0300..U+036F, generated once from Unicode data.

    Returns the one-to-one part as a translate pair (combining marks last, so they
    are deleted) and the one-to-many part as a dictionary.
    """
    sources, targets, many = [], [], {}
    for code in range(0x80, 0x20000):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or 0x0300 <= code <= 0x036F or char.lower() != char:
            continue
        folded = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not 0x0300 <= ord(c) <= 0x036F
        )
        if not any(c.isascii() and c.isalnum() for c in folded):
            continue
        if len(folded) == 1:
            sources.append(char)
            targets.append(folded)
        else:
            many[char] = folded
    marks = "".join(chr(c) for c in range(0x0300, 0x0370))
    return "".join(sources) + marks, "".join(targets), many


def fold_accents(low: Column) -> Column:
    """Lower-cased text with accents removed, as far as ASCII letters result."""
    sources, targets, many = _folding()
    table = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    spelled_out = F.array_join(
        F.transform(F.split(low, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), ""
    )
    expanded = F.when(low.rlike(_ranges(many)), spelled_out).otherwise(low)
    return F.when(is_ascii(low), low).otherwise(F.translate(expanded, sources, targets))


def _ranges(chars: dict[str, str]) -> str:
    """A short character class covering at least ``chars``."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and code - spans[-1][1] < 32:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


def path_slug(text: Column) -> Column:
    """Readable page slug: accents folded, cut to 60, no dash at either end."""
    folded = fold_accents(F.lower(F.coalesce(text, F.lit(""))))
    dashed = F.btrim(F.regexp_replace(folded, "[^a-z0-9]+", "-"), F.lit("-"))
    return F.rtrim(F.substring(dashed, 1, V.PATH_SLUG_LIMIT), F.lit("-"))


def job_path(company_slug: Column, title: Column, job_id: Column) -> Column:
    return F.concat(
        company_slug, F.lit("/"), or_else(path_slug(title), F.lit("job")), F.lit("-"),
        F.substring(job_id, 1, 8),
    )


def _capitalised(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def company_from_slug(slug: Column) -> Column:
    parts = F.filter(F.split(slug, "-"), lambda p: p != "")
    return F.array_join(F.transform(parts, _capitalised), " ")


def title_from_slug(slug: Column) -> Column:
    return _capitalised(strip_computed(F.replace(slug, F.lit("-"), F.lit(" "))))


def slug_candidates(org: Column) -> Column:
    """Distinct handle spellings worth probing for an organisation name."""
    slug = slugify_uncapped(org)

    def cut(suffix: str) -> Column:
        return F.when(
            F.endswith(slug, F.lit(suffix)),
            F.rtrim(F.substr(slug, F.lit(1), F.length(slug) - len(suffix)), F.lit("-")),
        )

    # The inc/co rule trims a character set, not a suffix: "zinc" gives "z".
    charset = F.when(
        F.endswith(slug, F.lit("inc")) | F.endswith(slug, F.lit("co")),
        F.rtrim(F.rtrim(slug, F.lit("-inc")), F.lit("-co")),
    )
    spelled = F.array_distinct(
        F.array_compact(F.array(slug, cut("ai"), cut("hq"), cut("team"), charset))
    )
    sized = F.filter(spelled, lambda s: (F.length(s) > 2) & (F.length(s) < 50))
    refused = slug.isin(V.MODEL_ORG_BLOCKLIST) | (F.length(slug) < 3)
    return F.when(refused, F.array().cast("array<string>")).otherwise(sized)
