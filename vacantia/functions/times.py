"""Timestamp parsing and labels. Session time zone is UTC throughout."""

from pyspark.sql import Column, functions as F

_RFC822_FORMATS = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z"]


def iso_time(text: Column) -> Column:
    """ISO 8601 with ``Z`` or an offset; anything else is null."""
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$")
    return F.when(iso, F.try_to_timestamp(text))


def rfc822_time(text: Column) -> Column:
    """Mail-style date; the weekday is optional and ignored."""
    bare = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", "")
    return F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in _RFC822_FORMATS])


def epoch_millis(number: Column) -> Column:
    return F.timestamp_millis(number.try_cast("bigint"))


def epoch_seconds(number: Column) -> Column:
    """Null outside the years 1 to 9999."""
    seconds = number.try_cast("double")
    known = (seconds >= -62135596800) & (seconds < 253402300800)
    return F.when(known, F.timestamp_micros((seconds * 1000000).cast("bigint")))


def iso_or_epoch(text: Column, *, millis: str) -> Column:
    """A JSON scalar read as text: a number is an epoch, anything else ISO.

    ``millis`` says when a number counts as milliseconds: ``"always"``,
    ``"never"``, or ``"large"`` (above 1e12).
    """
    number = F.when(text.rlike(r"^-?\d+(\.\d+)?([eE]\+?\d+)?$"), text.try_cast("double"))
    seconds = {
        "always": number / 1000,
        "never": number,
        "large": F.when(number > 1e12, number / 1000).otherwise(number),
    }[millis]
    return F.when(number.isNotNull(), epoch_seconds(seconds)).otherwise(iso_time(text))


def rfc822_text(ts: Column) -> Column:
    return F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss Z")


def european_date(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "dd/MM/yyyy"), F.lit("—"))


def credible(ts: Column, now: Column) -> Column:
    """Known, not in the future, and not from a far-future year."""
    return F.coalesce((ts <= now) & (F.year(ts) <= F.year(now)), F.lit(False))


def posted_within(ts: Column, now: Column, days: int) -> Column:
    since = now - F.expr(f"interval {days} days")
    return credible(ts, now) & (ts >= since)


def age_days(ts: Column, now: Column) -> Column:
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    return F.when(credible(ts, now), F.floor(micros / F.lit(86400000000)))


def round_half_up(number: Column) -> Column:
    return F.floor(number + 0.5).cast("bigint")


def age_label(ts: Column, now: Column) -> Column:
    """TODAY, 1D, nD, nW, nMO; the empty string without a credible date."""
    days = age_days(ts, now)

    def counted(number: Column, unit: str) -> Column:
        return F.concat(number.cast("string"), F.lit(unit))

    return (
        F.when(days.isNull(), "")
        .when(days <= 0, "TODAY")
        .when(days == 1, "1D")
        .when(days <= 7, counted(days.cast("bigint"), "D"))
        .when(days <= 31, counted(round_half_up(days / 7), "W"))
        .otherwise(counted(round_half_up(days / 30), "MO"))
    )


def is_new(ts: Column, now: Column) -> Column:
    return F.coalesce(age_days(ts, now) <= 1, F.lit(False))
