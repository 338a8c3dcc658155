"""Bounds of a time-sliced read."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F, types as T

from ..functions.names import trim_backticks

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _epoch_ms(local: datetime, zone: str | None) -> int:
    if local.tzinfo is None:
        local = local.replace(tzinfo=ZoneInfo(zone)) if zone else local.astimezone()
    return (local - _EPOCH) // timedelta(milliseconds=1)


@dataclass(frozen=True)
class TimeRange:
    """The half-open range ``[start, end)`` of a time column, cut into windows of ``interval``.

    Every window is half-open; the last one ends with the range. Without an interval, or with
    one longer than the range, there is a single window. An empty range has none.
    """

    start_ms: int
    end_ms: int
    column: str = "ts"
    interval_ms: int = 0

    @staticmethod
    def of_millis(start_ms: int, end_ms: int, column: str, interval: timedelta) -> "TimeRange":
        return TimeRange(start_ms, end_ms, column, interval // timedelta(milliseconds=1))

    @staticmethod
    def of_local(
        start: datetime, end: datetime, column: str, interval: timedelta, zone: str | None = None
    ) -> "TimeRange":
        """Local dates and times in ``zone`` (the driver's own zone if none is given)."""
        return TimeRange.of_millis(_epoch_ms(start, zone), _epoch_ms(end, zone), column, interval)

    @staticmethod
    def of_text(
        start: str,
        end: str,
        column: str,
        interval: timedelta,
        pattern: str = "%Y-%m-%d %H:%M:%S.%f",
        zone: str | None = None,
    ) -> "TimeRange":
        """Texts in a ``strptime`` pattern. The zone holds unless the pattern reads an offset."""
        return TimeRange.of_local(
            datetime.strptime(start, pattern), datetime.strptime(end, pattern), column, interval, zone
        )

    @property
    def name(self) -> str:
        """The column without backticks."""
        return trim_backticks(self.column)

    @property
    def empty(self) -> bool:
        return not self.column or self.end_ms <= self.start_ms

    @property
    def start(self) -> datetime:
        return _EPOCH + timedelta(milliseconds=self.start_ms)

    @property
    def end(self) -> datetime:
        return _EPOCH + timedelta(milliseconds=self.end_ms)

    @property
    def step_ms(self) -> int:
        """Width of a full window."""
        length = self.end_ms - self.start_ms
        return self.interval_ms if 0 < self.interval_ms <= length else length

    def windows(self) -> list[tuple[int, int]]:
        """The windows as epoch milliseconds."""
        if self.empty:
            return []
        starts = range(self.start_ms, self.end_ms, self.step_ms)
        return [(start, min(start + self.step_ms, self.end_ms)) for start in starts]

    def window(self, start_ms: int, end_ms: int) -> "TimeRange":
        return TimeRange(start_ms, end_ms, self.column)

    def predicates(self) -> list[str]:
        """One condition per window for an external database, which slices its own scan."""
        return [f"{self.column} >= {start} and {self.column} < {end}" for start, end in self.windows()]

    def _place(self, data_type: T.DataType) -> Column:
        """The column as it compares with the bounds: whole numbers are epoch milliseconds, dates
        their midnights."""
        column = F.col(f"`{self.name}`")
        if isinstance(data_type, (T.IntegralType, T.TimestampType, T.TimestampNTZType)):
            return column
        if isinstance(data_type, T.DateType):
            return column.cast("timestamp")
        raise ValueError(f"column {self.name!r} of type {data_type.simpleString()} is no time column")

    def _bound(self, ms: int, data_type: T.DataType) -> Column:
        if isinstance(data_type, T.IntegralType):
            return F.lit(ms).cast("long")
        moment = F.timestamp_millis(F.lit(ms))
        return moment.cast(data_type) if isinstance(data_type, T.TimestampNTZType) else moment

    def contains(self, data_type: T.DataType) -> Column:
        """The range as a condition on the bare column, so that it reaches the file scan."""
        if self.empty:
            return F.lit(False)
        column = self._place(data_type)
        return (column >= self._bound(self.start_ms, data_type)) & (column < self._bound(self.end_ms, data_type))

    def window_index(self, data_type: T.DataType) -> Column:
        """Which window a row inside the range belongs to, counted from 0."""
        if self.empty:
            return F.lit(0).cast("long")
        column = self._place(data_type)
        if isinstance(data_type, T.IntegralType):
            offset, step = column - F.lit(self.start_ms), self.step_ms
        else:
            offset = F.unix_micros(column.cast("timestamp")) - F.lit(self.start_ms * 1000)
            step = self.step_ms * 1000
        return F.call_function("div", offset, F.lit(step).cast("long"))
