"""Timestamp parsing, durations and calendar expressions; all on zone-free timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86400e6

# Accepted text layouts: T-separated with or without fraction, blank-separated, date only.
TIMESTAMP_TEXT = (
    r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"(T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,6})?| [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?\z"
)


def parse_datetime(value: Column) -> Column:
    """Text to timestamp; anything outside the accepted layouts becomes null.

    The pattern guards the cast, which alone would also take years, months or zone suffixes. Extracting the whole
    match, empty where there is none, uses ``value`` once, so a costly input is not computed twice.
    """
    return F.regexp_extract(value, TIMESTAMP_TEXT, 0).try_cast("timestamp_ntz")


def from_epoch_millis(value: Column) -> Column:
    """Milliseconds since 1970 to a zone-free UTC timestamp."""
    millis = value.cast("bigint")
    days = F.floor(millis / F.lit(86400000)).cast("int")
    seconds = (F.pmod(millis, F.lit(86400000)) / F.lit(1000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from exact microseconds; negative when ``end`` is earlier."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(DAY_MICROS)


def resolution_days(created: Column, closed: Column, strict: bool = False) -> Column:
    """Days to close, signed; ``strict`` turns a close before creation into null."""
    days = days_between(created, closed)
    return F.when(closed >= created, days) if strict else days


def sla_compliant(created: Column, closed: Column, sla_days: Column, strict: bool = False) -> Column:
    return resolution_days(created, closed, strict) <= sla_days


def open_age_days(status: Column, created: Column, as_of: Column) -> Column:
    return F.when(status == "Open", days_between(created, as_of))


def _weekdays_before(day: Column) -> Column:
    """Weekdays between Monday 1969-12-29 and the day before ``day``."""
    offset = F.date_diff(day, F.lit("1969-12-29").cast("date"))
    return F.lit(5) * F.floor(offset / F.lit(7)) + F.least(F.pmod(offset, F.lit(7)), F.lit(5))


def business_days(created: Column, closed: Column, holidays: Sequence[str] = ()) -> Column:
    """Weekdays from the created to the closed date, both included, without the given holidays."""
    first, last = F.to_date(created), F.to_date(closed)
    count = _weekdays_before(F.date_add(last, 1)) - _weekdays_before(first)
    if holidays:
        days = F.array(*[F.lit(day).cast("date") for day in sorted(set(holidays))])
        off = F.size(F.filter(days, lambda day: day.between(first, last) & (F.weekday(day) < 5)))
        count = count - off
    return F.when(closed >= created, count.cast("int"))


def day_key(ts: Column) -> Column:
    return F.to_date(ts)


def week_key(ts: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(F.to_date(ts), "WEEK")


def month_key(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MONTH")
