"""Faceted full-text search over posting titles and their synonyms."""

from pyspark.sql import Column, DataFrame, functions as F

from vacantia import fixed_values as V
from vacantia.functions.once import evaluate_once

WORD_SEPARATOR = r"[^\p{L}\p{N}]+"


def spaced_words(text: Column) -> Column:
    """Lower-cased words, each with a space of its own on either side.

    In this form ``" word "`` occurs exactly once per occurrence of the word, so
    counting is a byte search and no word array is ever built.
    """
    low = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(low, WORD_SEPARATOR, "  ")


def occurrences(spaced: Column, part: str) -> Column:
    removed = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(part), F.lit("")))
    return (removed / len(part.encode())).cast("int")


def word_count(spaced: Column) -> Column:
    return occurrences(spaced, "  ") - 1


def query_terms(text: str) -> list[str]:
    """Distinct lower-cased words of a query, in order."""
    import regex

    words = regex.split(WORD_SEPARATOR, text.lower())
    return list(dict.fromkeys(w for w in words if w))


def facet_filter(
    df: DataFrame,
    facets: dict[str, str],
    selected: dict[str, list[str]],
    *,
    index: DataFrame | None = None,
) -> DataFrame:
    """OR inside a facet, AND across facets.

    A facet with every existing value selected (or none) is no restriction, so its
    null rows stay. ``facets`` maps facet names to columns; the existing values are
    those of ``index`` (by default ``df`` itself).
    """
    chosen = {f: list(dict.fromkeys(v)) for f, v in selected.items() if v and f in facets}
    if not chosen:
        return df
    # Distinct values per facet: a handful of rows, counted inside the same plan.
    totals = (df if index is None else index).agg(
        *[F.count_distinct(F.col(facets[f])).alias(f"n_{i}") for i, f in enumerate(chosen)]
    )
    out = df
    for i, (facet, values) in enumerate(chosen.items()):
        total = totals.select(f"n_{i}").scalar()
        hit = F.coalesce(F.col(facets[facet]).isin(values), F.lit(False))
        out = out.filter((F.lit(len(values)) >= total) | hit)
    return out


def selection_of(params: DataFrame) -> DataFrame:
    """``(facet, value)`` rows of URL parameters named ``filter[x]`` or ``filter[x][]``."""
    rule = r"^filter\[([^\]]+)\](?:\[\])?$"
    return (
        params.filter(F.coalesce(F.col("key").rlike(rule), F.lit(False)))
        .select(F.regexp_extract("key", rule, 1).alias("facet"), F.col("value"))
        .distinct()
    )


def search(
    df: DataFrame,
    text: Column,
    query: str,
    *,
    key: str = "id",
    facets: dict[str, str] | None = None,
    selected: dict[str, list[str]] | None = None,
    page: int | None = 1,
    page_size: int = V.SEARCH_PAGE_SIZE,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """BM25-ranked matches that contain every query word, one page of them.

    Only the query's words are counted, so no term table is built or shuffled: one
    pass for the corpus statistics (a single row), one for the scores, and a top-k.
    An empty query matches everything, in key order.
    """
    terms = query_terms(query)
    spaced = evaluate_once(df, __words=spaced_words(text))
    counts = {f"__tf{i}": occurrences(F.col("__words"), f" {t} ") for i, t in enumerate(terms)}
    indexed = evaluate_once(spaced, __len=word_count(F.col("__words")), **counts).drop("__words")
    counted = [
        F.count_if(F.col(f"__tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))
    ]
    stats = indexed.agg(
        F.struct(F.count("*").alias("docs"), F.avg("__len").alias("mean"), *counted).alias("s")
    ).scalar()
    hits = indexed.withColumn("__s", stats) if terms else indexed
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, n = F.col(f"__tf{i}").cast("double"), F.col(f"__s.df{i}").cast("double")
        idf = F.log(F.lit(1.0) + (F.col("__s.docs") - n + 0.5) / (n + 0.5))
        norm = tf + k1 * (1 - b + b * F.col("__len") / F.col("__s.mean"))
        score = score + idf * tf * (k1 + 1) / norm
        hits = hits.filter(F.col(f"__tf{i}") > 0)
    hits = facet_filter(hits.withColumn("score", score), facets or {}, selected or {}, index=df)
    hits = hits.select(*df.columns, "score")
    if page is None:
        return hits
    ordered = hits.orderBy(F.round(F.col("score"), 9).desc(), F.col(key))
    return ordered.offset((page - 1) * page_size).limit(page_size)
