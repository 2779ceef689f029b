"""Text columns: trimming, HTML to text, sections, grounding, extraction."""

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V

# All characters the reference semantics treat as white space when trimming.
WHITE_SPACE = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)


def strip(col: Column) -> Column:
    """Trim a field. Looks at both ends first: trimming against a set is slow.

    Mentions ``col`` several times, so give it a plain column; computed text goes
    through `strip_computed`.
    """
    def inner(char: Column) -> Column:
        return F.ascii(char).between(0x21, 0x84)

    trimmed = inner(col) & inner(F.substring(col, -1, 1))
    return F.when(trimmed, col).otherwise(F.btrim(col, F.lit(WHITE_SPACE)))


def strip_computed(col: Column) -> Column:
    """Trim an expression, evaluating it once."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def or_else(*cols: Column) -> Column:
    """First argument that is neither null nor empty, else the last one as it is.

    With a single argument, the empty string becomes null.
    """
    *first, last = cols
    if not first:
        return F.nullif(last, F.lit(""))
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in first], last)


def join_present(sep: str, *cols: Column) -> Column:
    """Join the arguments that are neither null nor empty, evaluating each once."""
    return F.array_join(F.filter(F.array(*cols), lambda c: c != ""), sep)


def head(col: Column, limit: int | None) -> Column:
    """The first ``limit`` characters; all of them without a limit."""
    return col if limit is None else F.substring(col, 1, limit)


# --- HTML ---------------------------------------------------------------------

_ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&amp;", "&"),
]
# Formatting white space collapses first; line structure then comes from the tags. A tag ends
# before the next "<", so a pattern that starts at one never looks beyond the other: each step
# reads a character a bounded number of times, whatever the page holds. For the same reason
# white space before a tag is taken from where it begins, and a link's address is not sought twice.
# A heading's level is kept behind a control character until its marks are spelled.
_HTML_STEPS = [
    (r"(?i)<!doctype[^<>]*>", ""),
    (r"[ \t\r\n]+", " "),
    (r"(?i) ?<br ?/?> ?", "  \n"),
    (r"(?i)<h([1-6])\b[^<>]*>\s*", "\n\n\x01$1 "),
    (r"(?i)</h[1-6]>\s*|</?(?:ul|ol|p|div|section|article|table|tr|blockquote)\b[^<>]*>|\s(?<!\s\s)\s*+</h[1-6]>\s*", "\n\n"),
    (r"(?i)<li\b[^<>]*>\s*", "\n* "),
    (r"(?i)</?(?:b|strong)\b[^<>]*>", "**"),
    (r"(?i)</?(?:i|em)\b[^<>]*>", "*"),
    (r"""(?i)<a\b(?>[^<>]*?href="([^"<>]*)")[^<>]*+>([^<]*+)</a>""", r"[$2]($1)"),
    (r"(?i)<[^<>]+>|\s(?<!\s\s)\s*+</li>", ""),
]
_HEADING_MARKS = [(f"\x01{n}", "#" * n) for n in range(1, 7)]


def _without(html: Column, opening: str, closing: str) -> Column:
    """Cuts from each opening to the first closing after it; without one, the opening stays.

    An opening that is never closed takes all that follows along, so nothing is read more than twice.
    """
    return F.regexp_replace(html, f"(?is){opening}.*?{closing}|({opening}.*)", "$1")


def drop_scripts(html: Column) -> Column:
    return _without(_without(html, r"<script\b", "</script>"), r"<style\b", "</style>")


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def html_to_markdown(html: Column) -> Column:
    """Markdown for the tag set postings use; null and empty give the empty string.

    Linear in the page, hostile pages included: a comment or head never closed is looked through
    once, and a "<" without a ">" before the next one is text.
    """
    out = F.replace(F.coalesce(html, F.lit("")), F.lit("\x01"), F.lit(""))
    out = _without(_without(out, "<!--", "(?<!<!)-->"), r"<head\b", "</head>")
    for pattern, repl in _HTML_STEPS:
        out = F.regexp_replace(out, pattern, repl)
    out = _replaced(_replaced(out, _HEADING_MARKS), _ENTITIES)
    # Character classes only: a repeated group takes a stack frame per repetition.
    return strip_computed(F.regexp_replace(out, r"[ \t]*\n[ \t\n]*\n", "\n\n"))


def page_text(html: Column, limit: int | None = None) -> Column:
    """Careers page as text: no scripts, no runs of blank lines; cut only on request."""
    return head(html_to_markdown(drop_scripts(html)), limit)


# --- sections and grounding ---------------------------------------------------


def strip_boilerplate(markdown: Column) -> Column:
    """Cut each marketing section from its trigger to the next ``##`` line or the end.

    The four patterns run in order. Triggers match mid-sentence, and the heading
    marker in front of a cut section stays.
    """
    out = F.coalesce(markdown, F.lit(""))
    for trigger in V.BOILERPLATE_TRIGGERS:
        out = F.regexp_replace(out, rf"(?ismdU){trigger}.*?(?=^##|\z)", "")
    return strip_computed(out)


def grounded(values: Column, source: Column) -> Column:
    """Elements of ``values`` that occur, ignoring case, in ``source``."""
    low = F.lower(F.coalesce(source, F.lit("")))
    kept = F.filter(values, lambda v: (v != "") & F.contains(low, F.lower(v)))
    return F.coalesce(kept, F.array().cast("array<string>"))


def ascii_safe(col: Column) -> Column:
    """One ``?`` per character outside ASCII."""
    return F.regexp_replace(col, r"[^\x00-\x7F]", "?")


# --- extraction ---------------------------------------------------------------


def markdown_links(markdown: Column) -> Column:
    """``array<struct<name, url>>`` of the links worth following, in text order."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(markdown, F.lit(V.MARKDOWN_LINK), 1).alias("name"),
        F.regexp_extract_all(markdown, F.lit(V.MARKDOWN_LINK), 2).alias("url"),
    )
    named = F.transform(
        pairs, lambda p: F.struct(strip(p["name"]).alias("name"), strip(p["url"]).alias("url"))
    )

    def wanted(p: Column) -> Column:
        skipped = [F.contains(p["url"], F.lit(part)) for part in V.SKIPPED_LINK_PARTS]
        host = F.regexp_extract(p["url"], r"^https?://(?:[^/?#@]*@)?([^/?#:]*)", 1)
        keep = (p["name"] != "") & (host != "")
        for hit in skipped:
            keep = keep & ~hit
        return keep

    return F.filter(named, wanted)


def leading_name(html: Column) -> Column:
    """Company name a hiring comment opens with, or null."""
    text = F.regexp_replace(html, r"<[^>]+>", " ")
    text = strip_computed(F.regexp_replace(text, r"(?U)\s+", " "))
    name = strip_computed(F.regexp_extract(text, V.LEADING_NAME, 1))
    name = F.rtrim(name, F.lit(".,;:"))
    usable = (F.length(name) >= 2) & ~F.lower(name).isin(V.GREETING_WORDS)
    return F.when(usable, name)


def brand_in_body(name: Column, body: Column, limit: int | None = None) -> Column:
    """Letters-only brand name occurs in the letters-only response, or its first letters."""
    def letters(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[^a-z]", "")

    return F.contains(head(letters(body), limit), letters(name))

