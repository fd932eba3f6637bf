"""Time expressions whose results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
#: The folder column of tables stored by month.
MONTH = "extracted_month"


def utc_date(timestamp: Column) -> Column:
    """The UTC calendar day of a TIMESTAMP, under any session time zone.

    ``to_date`` would use the session zone, which moves captures near midnight to
    the wrong day. Integer arithmetic on the instant cannot.
    """
    micros = F.unix_micros(timestamp)
    midnight = micros - F.pmod(micros, F.lit(MICROS_PER_DAY))
    return F.date_from_unix_date(F.call_function("div", midnight, F.lit(MICROS_PER_DAY)).cast("int"))


def month_of(day: Column) -> Column:
    """The first day of a day's month."""
    return F.trunc(day, "month")


def every_nth(day: Column, count: int, number: int, monthly: bool = False) -> Column:
    """Tells the days (or months) whose turn it is when they are dealt to ``count`` parts; days that are null come in part 0."""
    turn = F.year(day) * 12 + F.month(day) if monthly else F.unix_date(day)
    return F.coalesce(F.pmod(turn, F.lit(count)), F.lit(0)) == number


def duration_seconds(started_at: Column, ended_at: Column) -> Column:
    """Elapsed seconds with microsecond fractions."""
    return (F.unix_micros(ended_at) - F.unix_micros(started_at)) / F.lit(1e6)


def parse_utc(text: Column) -> Column:
    """An ISO time as TIMESTAMP: a zone in the text wins, no zone means UTC, unreadable is NULL.

    Seconds, or the whole time of day, may be missing. The usual zone-less forms are
    told by their length, so that only unusual ones pay for a pattern.
    """
    length = F.length(text)
    zone = r"(Z|[+-]\d{2}(:?\d{2})?)$"
    completed = (
        F.when(length == len("yyyy-mm-dd"), F.concat(text, F.lit("T00:00:00Z")))
        .when(length == len("yyyy-mm-ddThh:mm"), F.concat(text, F.lit(":00Z")))
        .when(length == len("yyyy-mm-ddThh:mm:ss"), F.concat(text, F.lit("Z")))
        .when(text.rlike(r"^\S{10}[T ]\d{2}:\d{2}" + zone), F.regexp_replace(text, zone, ":00$1"))
        .when(text.rlike(zone), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return completed.try_cast("timestamp")
