"""Time expressions. The session zone is UTC; ``timestamp_ntz`` means UTC wall time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400
UTC = "UTC"

ColumnOrName = Column | str


def as_column(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_seconds(as_column(ts).cast("timestamp"))


def epoch_micros(ts: ColumnOrName) -> Column:
    return F.unix_micros(as_column(ts).cast("timestamp"))


def from_seconds(seconds: ColumnOrName) -> Column:
    """Inverse of :func:`epoch_seconds`, as ``timestamp_ntz``."""
    return F.timestamp_seconds(as_column(seconds)).cast("timestamp_ntz")


def floor_div(value: Column, width: int) -> Column:
    """Whole-number division that rounds down, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def local_wall(ts: ColumnOrName, tz: str = UTC) -> Column:
    """Wall-clock time in ``tz`` as ``timestamp_ntz``."""
    wall = as_column(ts).cast("timestamp_ntz")
    return wall if tz == UTC else F.convert_timezone(F.lit(UTC), F.lit(tz), wall)


def local_date(ts: ColumnOrName, tz: str = UTC) -> Column:
    return F.to_date(local_wall(ts, tz))


def micros_of_day(ts: ColumnOrName, tz: str = UTC) -> Column:
    """Time of day; Spark has no TIME column, so it is a number of microseconds."""
    return F.pmod(epoch_micros(local_wall(ts, tz)), F.lit(DAY * 1_000_000))


def day_start_seconds(day: ColumnOrName, tz: str = UTC) -> Column:
    """Epoch second at which local ``day`` starts."""
    day = as_column(day)
    if tz == UTC:
        return F.unix_date(day).cast("long") * DAY
    return F.unix_seconds(F.to_utc_timestamp(day.cast("timestamp"), tz))


def day_start(day: ColumnOrName, tz: str = UTC, like=None) -> Column:
    """Instant at which local ``day`` starts, of the type ``like`` so that a filter on a
    time column stays a plain comparison which the scan can use."""
    midnight = as_column(day).cast("timestamp")
    if tz != UTC:
        midnight = F.to_utc_timestamp(midnight, tz)
    return midnight.cast(like or "timestamp_ntz")


def clock_seconds(text: str) -> int:
    """``"01:30"`` or ``"01:30:15"`` → seconds of day."""
    parts = [int(p) for p in text.split(":")]
    hours, minutes, seconds = (parts + [0, 0])[:3]
    return hours * 3600 + minutes * 60 + seconds


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": DAY}


def span_seconds(span: str | int | timedelta) -> int:
    """``"3 hours"``, a timedelta or a number of seconds → seconds."""
    if isinstance(span, timedelta):
        return int(span.total_seconds())
    if isinstance(span, int):
        return span
    number, unit = span.split()
    return int(number) * _UNITS[unit.rstrip("s")]
