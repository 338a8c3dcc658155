"""Time stamps as columns. An instant is a ``TIMESTAMP`` (UTC microseconds)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def instant(ts: Column) -> Column:
    """A local date and time column read in the session's zone; an instant stays as it is."""
    return ts.cast("timestamp")


def millis(ts: Column) -> Column:
    """Epoch milliseconds, rounded towards the past."""
    return F.unix_millis(instant(ts))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_millis_precision(ts: Column) -> Column:
    """The instant without its microseconds."""
    return from_millis(millis(ts))


def local_to_utc(ts: Column, zone: str) -> Column:
    """A local date and time in ``zone`` as the UTC date and time of the same instant."""
    return F.to_utc_timestamp(ts, zone)
