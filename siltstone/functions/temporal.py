"""Timestamps without time zone: parsing, month starts, day differences.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(text: Column | str) -> Column:
    """ISO-8601 text as TIMESTAMP_NTZ in UTC; unreadable text gives null."""
    text = _col(text)
    offset = ~text.endswith("Z") & text.rlike(r"T.*[+-]\d{2}:?\d{2}$")
    shifted = utc_wall_time(text.try_cast("timestamp"))
    return F.when(offset, shifted).otherwise(text.try_cast("timestamp_ntz"))


def utc_instant(ts: Column | str) -> Column:
    """A UTC wall time as TIMESTAMP, which event-time operators ask for."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(ts))
    return local.cast("timestamp")


def utc_wall_time(instant: Column | str) -> Column:
    """The inverse of :func:`utc_instant`."""
    return F.convert_timezone(None, F.lit("UTC"), _col(instant).cast("timestamp_ntz"))


def month_of(ts: Column | str) -> Column:
    """First instant of the month."""
    return F.trunc(_col(ts).cast("date"), "MM").cast("timestamp_ntz")


def days_between(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in fractional days, exact to the microsecond."""
    seconds = (_col(end) - _col(start)).cast("interval second").cast("decimal(24,6)")
    return (seconds * 1_000_000).cast("double") / F.lit(86_400e6)
