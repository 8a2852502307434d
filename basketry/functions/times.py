"""Time expressions; all under a UTC session."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report order of the weekdays.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def as_utc(moment: datetime) -> datetime:
    """A naive time is taken as UTC; an aware one is kept."""
    return moment if moment.tzinfo is not None else moment.replace(tzinfo=timezone.utc)


def from_micros(micros: int | None) -> datetime | None:
    """Aware UTC time from ``unix_micros``: free of the driver machine's own time zone."""
    if micros is None:
        return None
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=rest)


def utc_day(col: Column) -> Column:
    return F.to_date(col)


def iso_day(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def weekday_name(col: Column) -> Column:
    return F.date_format(col, "EEEE")
