"""Parsing and calendar expressions. Sessions run with ``spark.sql.session.timeZone=UTC``.

Inside the library time is a BIGINT of microseconds since 1970 (UTC); local civil time appears only where a
calendar is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Kyiv"
SECOND = 1_000_000
DAY = 86_400 * SECOND


def micros(timestamp: Column) -> Column:
    return F.unix_micros(timestamp.cast("timestamp"))


def instant(us: Column) -> Column:
    return F.timestamp_micros(us)


def local_to_us(text: Column, zone: str = ZONE) -> Column:
    """Text of local civil time; text that carries a zone is taken as it says. Null if it cannot be read."""
    read = F.try_to_timestamp(text)
    zoned = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.when(zoned, F.unix_micros(read)).otherwise(F.unix_micros(F.to_utc_timestamp(read, zone)))


def utc_to_us(text: Column) -> Column:
    """Text whose zone is UTC where it has none; digits of a fraction beyond six are dropped. Null if unreadable."""
    return F.unix_micros(F.try_to_timestamp(F.regexp_replace(text, r"(\.\d{6})\d+", "$1")))


def has_zone(text: Column) -> Column:
    """Whether a strict clock text carries a zone."""
    return F.coalesce(text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:\d\d)$"), F.lit(False))


def iso(us: Column) -> Column:
    """ISO text of an instant in UTC, with ``Z``, and a fraction only where there is one."""
    whole = F.date_format(instant(us), "yyyy-MM-dd'T'HH:mm:ss")
    rest = F.pmod(us, F.lit(SECOND))
    return F.concat(whole, F.when(rest > 0, F.concat(F.lit("."), F.lpad(rest.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def local_day(us: Column, zone: str = ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant(us), zone))


def midnight(day: Column, zone: str = ZONE) -> Column:
    """The instant at which a local day begins; days have 23 to 25 hours."""
    return F.unix_micros(F.to_utc_timestamp(day.cast("timestamp"), zone))


def month(day: Column) -> Column:
    return F.trunc(day, "month")


def week(day: Column) -> Column:
    """The Monday of the day's week."""
    return F.to_date(F.date_trunc("week", day))


def days_in_month(day: Column) -> Column:
    return F.day(F.last_day(day))


def last_complete_day(newest_us: Column, zone: str = ZONE) -> Column:
    """The last local day that a source covers whole: the one before the day of its newest instant."""
    return F.date_sub(local_day(newest_us, zone), 1)


def ratio(a: Column, b: Column, scale: float = 1.0) -> Column:
    """``scale * a / b`` as a double; null where ``b`` is zero."""
    return F.when(b != 0, a.cast("double") * scale / b.cast("double"))


def round3(x: Column) -> Column:
    """Three decimals, halves up; null for null and NaN."""
    return F.when(~F.isnan(x), F.floor(x * 1000 + 0.5) / 1000)
