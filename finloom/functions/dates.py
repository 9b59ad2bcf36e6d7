"""Wall-clock and instant arithmetic.

Table timestamps are zone-less (timestamp_ntz) with the zone in its own column; the
session zone is UTC, so a zone-less value and its epoch milliseconds agree.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift_zone(source: str | Column, target: str | Column, wall: Column) -> Column:
    """The wall clock of `target` at the moment `wall` shows in `source`."""
    as_column = lambda z: F.lit(z) if isinstance(z, str) else z
    return F.convert_timezone(as_column(source), as_column(target), wall)


def parse_utc_stamp(text: Column, zone: str) -> Column:
    """'2025-03-25T12:30:00.000Z' -> wall clock in `zone`; NULL for any other text."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$")
    utc = F.when(shaped, F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz"))
    return shift_zone("UTC", zone, utc)


def clock_on(day: Column, clock: Column) -> Column:
    """Date and 'HH:MM' -> timestamp_ntz; NULL when the clock text is not a time."""
    joined = F.concat(day.cast("string"), F.lit(" "), clock)
    return F.when(clock.rlike(r"^\d{1,2}:\d{1,2}$"), joined.try_cast("timestamp_ntz"))


def to_epoch_ms(wall: Column) -> Column:
    return F.unix_millis(wall.cast("timestamp"))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def iso_text(wall: Column) -> Column:
    return F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")


def midnight_ms(day: Column) -> Column:
    return to_epoch_ms(day.cast("timestamp_ntz"))


def day_bounds(column: Column, day: dt.date) -> Column:
    """column falls on `day`, written as a range so the scan can use it."""
    start = dt.datetime.combine(day, dt.time())
    return (column >= _ntz(start)) & (column < _ntz(start + dt.timedelta(days=1)))


def recent_hours(column: Column, as_of_utc: dt.datetime, hours: int, zone: str) -> Column:
    """[full hour of as_of - hours, as_of) on the clock of `zone`; only the literals are shifted."""
    low = as_of_utc.replace(minute=0, second=0, microsecond=0) - dt.timedelta(hours=hours)
    return (column >= shift_zone("UTC", zone, _ntz(low))) & (
        column < shift_zone("UTC", zone, _ntz(as_of_utc))
    )


def _ntz(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
