"""Evaluate expensive columns once per row."""

from pyspark.sql import Column, DataFrame, functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns that later filters and projections will not recompute.

    The optimizer substitutes a projected expression into every filter above it. A
    one-element ``inline`` keeps the value: it is an output of the generator, not an
    expression to substitute.
    """
    return df.select(
        "*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    )
