"""Typed reads of rows of several schema versions, violating rows set apart with their reasons.

Rows land as text columns with the number of their schema version. Each version says which
columns it has and under which names; values are cast to the declared types without failing.
A row of an unknown version, with a value that does not cast, or that breaks a rule of the
table goes to the quarantine table as it landed, with all its reasons. `replay` reads the
quarantine again, by then maybe under corrected versions or rules.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

UNKNOWN = "unknown_version"


@dataclass(frozen=True)
class Version:
    """Names of a version's text columns by column of the table; a column may be missing."""

    number: int
    columns: dict[str, str]
    separator: str = ","  # of the values of an array


def _typed(col: Column, kind: T.DataType, separator: str) -> tuple[Column, Column]:
    """The value, and whether the text says something the type cannot hold."""
    text = F.nullif(F.trim(col), F.lit(""))
    if isinstance(kind, T.ArrayType):
        return F.when(text.isNotNull(), F.transform(F.split(text, separator), lambda v: F.trim(v))), F.lit(False)
    if isinstance(kind, T.StringType):
        return col, F.lit(False)
    value = text.try_cast(kind)
    return value, text.isNotNull() & value.isNull()


def read(
    landed: DataFrame, schema: T.StructType, versions: list[Version], violations: Column, *, version: str = "schema_version"
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``schema`` that keep all rules, and the others as landed with ``reasons``.

    ``violations`` is an array of rule names over the columns of ``schema``. One scan of the
    landed rows feeds either result; nothing is shuffled.
    """
    known = {v.number: v for v in versions}
    number, have = F.col(version).try_cast("int"), set(landed.columns)
    values, broken = {}, []
    for field in schema:
        value, bad = F.lit(None).cast(field.dataType), F.lit(False)
        for v in known.values():
            name = v.columns.get(field.name)
            if name in have:
                typed, unfit = _typed(F.col(name), field.dataType, v.separator)
                value = F.when(number == v.number, typed).otherwise(value)
                bad = F.when(number == v.number, unfit).otherwise(bad)
        values[field.name] = value
        broken.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(f"type:{field.name}")))
    raw = F.struct(*landed.columns).alias("__raw")
    staged = landed.select(
        raw, F.coalesce(number.isin(list(known)), F.lit(False)).alias("__known"), F.array_compact(F.array(*broken)).alias("__types"),
        *[c.alias(n) for n, c in values.items()],
    )
    reasons = F.when(~F.col("__known"), F.array(F.lit(UNKNOWN))).otherwise(F.concat("__types", violations))
    judged = staged.withColumn("reasons", reasons)
    good = judged.filter(F.size("reasons") == 0).select(*schema.names)
    return good, judged.filter(F.size("reasons") > 0).select("__raw.*", "reasons")


def replay(
    quarantined: DataFrame, schema: T.StructType, versions: list[Version], violations: Column, *, version: str = "schema_version"
) -> tuple[DataFrame, DataFrame]:
    """Read quarantined rows again: those that now pass, and those that stay, with new reasons."""
    return read(quarantined.drop("reasons"), schema, versions, violations, version=version)
