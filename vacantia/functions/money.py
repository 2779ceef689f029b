"""Salary bands."""

from pyspark.sql import Column, functions as F

from vacantia import fixed_values as V
from vacantia.functions.text import strip
from vacantia.functions.times import round_half_up

BAND = "struct<min:double,max:double,currency:string,period:string>"


def band(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """Band of a stored row; null when it breaks the band rules."""
    period = F.coalesce(F.nullif(period, F.lit("")), F.lit("year"))
    valid = (
        (F.length(currency) == 3)
        & (low.isNotNull() | high.isNotNull())
        & F.coalesce(low <= high, F.lit(True))
        & period.isin(V.SALARY_PERIODS)
    )
    return F.when(
        valid,
        F.struct(
            low.cast("double").alias("min"), high.cast("double").alias("max"),
            currency.alias("currency"), period.alias("period"),
        ),
    )


def band_text(salary: Column) -> Column:
    """``min|max|currency|period``, the fixed text form used in change rows."""
    def part(name: str) -> Column:
        return F.coalesce(salary[name].cast("string"), F.lit(""))

    return F.when(
        salary.isNotNull(),
        F.concat_ws("|", part("min"), part("max"), part("currency"), part("period")),
    )


def canonical_band(
    low: Column, high: Column, currency: Column, period: Column, source: Column
) -> Column:
    """Band from an untrusted answer, or null.

    Numbers may arrive as text; a missing side copies the other; the band must be
    positive, ordered, in a known currency and period, and supported by the source
    text. A currency without a sign always counts as supported.
    """
    low, high = low.try_cast("double"), high.try_cast("double")
    low, high = F.coalesce(low, high), F.coalesce(high, low)
    code = F.upper(strip(currency))
    unit = F.lower(strip(period))
    text = F.lower(F.coalesce(source, F.lit("")))

    def digits(number: Column) -> Column:
        return F.substring(number.cast("bigint").cast("string"), 1, 3)

    signs = {"EUR": "€", "GBP": "£", "USD": "$"}
    sign = F.create_map(*[F.lit(x) for kv in signs.items() for x in kv])
    supported = (
        F.contains(text, F.lower(code))
        | F.contains(text, F.coalesce(F.try_element_at(sign, code), F.lit("")))
        | F.contains(text, digits(low))
        | F.contains(text, digits(high))
        | F.contains(text, F.lit("salary"))
        | F.contains(text, F.lit("compensation"))
    )
    valid = (
        (low > 0) & (high > 0) & (high >= low)
        & code.isin(V.SALARY_CURRENCIES)
        & unit.isin(V.SALARY_PERIODS)
        & supported
    )
    return F.when(
        valid,
        F.struct(
            low.alias("min"), high.alias("max"), code.alias("currency"), unit.alias("period")
        ),
    )


def salary_label(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """Compact display text such as ``€80k–110k`` or ``£500/d``; empty if unknown."""
    def short(number: Column) -> Column:
        whole = F.when(
            number == F.floor(number), number.cast("bigint").cast("string")
        ).otherwise(number.cast("string"))
        return F.when(
            number >= 1000, F.concat(round_half_up(number / 1000).cast("string"), F.lit("k"))
        ).otherwise(whole)

    is_range = low.isNotNull() & high.isNotNull() & (low != high)
    amount = F.when(is_range, F.concat(short(low), F.lit("–"), short(high))).otherwise(
        short(F.coalesce(low, high))
    )

    def lookup(table: dict[str, str], key: Column) -> Column:
        literal = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
        return F.try_element_at(literal, F.coalesce(key, F.lit("")))

    sign = F.coalesce(lookup(V.CURRENCY_SIGNS, currency), F.concat(currency, F.lit(" ")))
    suffix = F.coalesce(lookup(V.PERIOD_SUFFIXES, period), F.lit(""))
    known = (F.coalesce(currency, F.lit("")) != "") & F.coalesce(low, high).isNotNull()
    return F.when(known, F.concat(sign, amount, suffix)).otherwise("")
