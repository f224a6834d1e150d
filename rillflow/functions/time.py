"""Event-time expressions and durations."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from rillflow.functions.text import ColumnOrName, as_column

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_us(text: str) -> int:
    """Microseconds in a fixed-length duration such as ``"5 minutes"``."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not found or found.group(2) not in _UNIT_US:
        raise ValueError(f"not a fixed-length duration: {text!r}")
    return int(found.group(1)) * _UNIT_US[found.group(2)]


def interval(text: str) -> Column:
    """A duration as a day-time interval that can be added to a timestamp."""
    return F.lit(timedelta(microseconds=duration_us(text)))


def event_time(epoch: ColumnOrName, unit: str = "s") -> Column:
    """Timestamp from an epoch number in seconds (``"s"``) or milliseconds (``"ms"``)."""
    if unit == "s":
        return F.timestamp_seconds(as_column(epoch))
    if unit == "ms":
        return F.timestamp_millis(as_column(epoch))
    raise ValueError(f"unknown epoch unit: {unit!r}")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _microsecond() -> Column:
    return F.lit(timedelta(microseconds=1))


def micros(ts: ColumnOrName, kind: DataType) -> Column:
    """Microseconds since 1970 of a column of type ``kind``; numbers are kept.

    Zone-less timestamps are counted as they read, whatever the session's zone.
    """
    ts = as_column(ts)
    if isinstance(kind, TimestampType):
        return F.unix_micros(ts)
    if isinstance(kind, TimestampNTZType):
        return F.call_function("div", ts - _epoch(), _microsecond())
    return ts.cast("bigint")


def from_micros(us: ColumnOrName, kind: DataType) -> Column:
    """The inverse of :func:`micros`."""
    us = as_column(us)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(us)
    if isinstance(kind, TimestampNTZType):
        return _epoch() + _microsecond() * us
    return us.cast(kind)


def window_start(epoch: ColumnOrName, size: int, offset: int = 0) -> Column:
    """Start of the aligned window ``[start, start + size)`` holding an epoch number."""
    epoch = as_column(epoch)
    return epoch - F.pmod(epoch - F.lit(offset), F.lit(size))


def day_of(ts: ColumnOrName, kind: DataType) -> Column:
    """UTC calendar day of a timestamp of type ``kind``, whatever the session's zone.

    Zone-less timestamps are taken as they read.
    """
    days = F.floor(micros(ts, kind) / F.lit(86_400_000_000))
    if isinstance(kind, TimestampNTZType):
        return F.to_date(as_column(ts))
    return F.date_from_unix_date(days.cast("int"))
