"""Options that open a table, checked before any job starts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from .request import ScanRequest
from .time_range import TimeRange

# Option names and their defaults (None: no default).
OPTION_DEFAULTS: dict[str, str | None] = {
    "connector": None,
    "td.jdbc.url": None,
    "td.jdbc.mode": None,
    "td.batch.mode": "false",
    "batch.size": "2000",
    "host": "localhost",
    "port": "6041",
    "user": None,
    "password": None,
    "dbname": None,
    "table.name": None,
    "timezone": "UTC-8",
    "charset": "UTF-8",
    "locale": "en_US.UTF-8",
    "enableAutoReconnect": "true",
    "reconnectIntervalMs": "2000",
    "reconnectRetryCount": "3",
    "scan.query": None,
    "bootstrap.servers": "localhost:6041",
    "url": "",
    "topic": None,
    "group.id": None,
    "client.id": None,
    "poll.interval_ms": "500",
    "auto.offset.reset": "latest",
    "enable.auto.commit": "false",
    "value.deserializer.encoding": "UTF-8",
    "auto.commit.interval.ms": "5000",
    "sink.supertable.name": "",
    "sink.table.name": "",
    "sink.db.name": "",
    "sink.batch.size": "500",
    "sink.parallelism": None,
}

# Options of our own that slice a bounded read: by windows of a time column (bounds as local times or
# epoch milliseconds, the interval in milliseconds), by predicates on tags, or by sub-tables.
SLICE_OPTIONS: dict[str, str | None] = {
    "scan.time.column": None,
    "scan.time.start": None,
    "scan.time.end": None,
    "scan.time.interval": "0",
    "scan.time.zone": "UTC",
    "scan.tags": None,  # separated by semicolons
    "scan.tables": None,  # separated by commas
    "scan.partitions": "64",
}

# Options that belong to the connection: a JDBC driver gets the ones the user set, untouched.
CONNECTION_OPTIONS = (
    "host",
    "port",
    "user",
    "password",
    "dbname",
    "timezone",
    "charset",
    "locale",
    "enableAutoReconnect",
    "reconnectIntervalMs",
    "reconnectRetryCount",
)

READ_MODES = ("source", "cdc")
START_POSITIONS = ("earliest", "latest")


@dataclass(frozen=True)
class TableOptions:
    """The options of one table. Unknown names are an error."""

    given: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        unknown = sorted(set(self.given) - set(OPTION_DEFAULTS) - set(SLICE_OPTIONS))
        if unknown:
            raise ValueError(f"unknown table options: {', '.join(unknown)}")

    def get(self, name: str) -> str | None:
        value = self.given.get(name)
        return (OPTION_DEFAULTS | SLICE_OPTIONS)[name] if value is None else str(value)

    def flag(self, name: str) -> bool:
        return (self.get(name) or "").strip().lower() == "true"

    def number(self, name: str) -> int | None:
        value = self.get(name)
        if value is None:
            return None
        try:
            return int(value)
        except ValueError:
            raise ValueError(f"option {name!r} must be a whole number, not {value!r}") from None

    def _require(self, *names: str) -> None:
        missing = [n for n in names if not self.get(n)]
        if missing:
            raise ValueError(f"table options missing: {', '.join(missing)}")

    @property
    def read_mode(self) -> str:
        mode = self.get("td.jdbc.mode")
        if mode not in READ_MODES:
            raise ValueError(f"option 'td.jdbc.mode' must be one of {', '.join(READ_MODES)} to read, not {mode!r}")
        return mode

    def check_read(self) -> None:
        if self.read_mode == "source":
            self.check_source()
        else:
            self.check_cdc()

    def check_source(self) -> None:
        self._require("td.jdbc.url", "scan.query")
        self._batch_size()
        self.request()

    def request(self) -> ScanRequest:
        """The bounded read: the query, and the slices it is read in, if the options ask for any."""
        ways = [way for way in ("scan.time.column", "scan.tags", "scan.tables") if self.get(way)]
        if len(ways) > 1:
            raise ValueError(f"a read is sliced one way, not by {' and '.join(ways)}")
        if (self.number("scan.partitions") or 0) < 1:
            raise ValueError("option 'scan.partitions' must be at least 1")
        time = tags = tables = None
        if self.get("scan.time.column"):
            self._require("scan.time.start", "scan.time.end")
            start, end = (self._bound(name) for name in ("scan.time.start", "scan.time.end"))
            time = TimeRange(start, end, self.get("scan.time.column"), self.number("scan.time.interval"))
        if self.get("scan.tags"):
            tags = tuple(tag.strip() for tag in self.get("scan.tags").split(";") if tag.strip())
        if self.get("scan.tables"):
            tables = tuple(name.strip() for name in self.get("scan.tables").split(",") if name.strip())
        return ScanRequest(sql=self.get("scan.query"), time=time, tags=tags, tables=tables)

    def _bound(self, name: str) -> int:
        """Epoch milliseconds of a bound."""
        text = self.get(name)
        if text.lstrip("-").isdigit():
            return int(text)
        moment = datetime.fromisoformat(text)
        return TimeRange.of_local(moment, moment, "", timedelta(0), self.get("scan.time.zone")).start_ms

    def check_cdc(self) -> None:
        self._require("topic", "group.id")
        if not self.get("url") and not self.get("bootstrap.servers"):
            raise ValueError("table options missing: url or bootstrap.servers")
        if self.get("auto.offset.reset") not in START_POSITIONS:
            raise ValueError(f"option 'auto.offset.reset' must be one of {', '.join(START_POSITIONS)}")
        if (self.number("poll.interval_ms") or 0) < 0:
            raise ValueError("option 'poll.interval_ms' must not be negative")
        self._batch_size()

    def check_sink(self) -> None:
        self._require("td.jdbc.url", "sink.db.name")
        if not self.get("sink.supertable.name") and not self.get("sink.table.name"):
            raise ValueError("table options missing: sink.supertable.name or sink.table.name")
        self.number("sink.batch.size")
        writers = self.number("sink.parallelism")
        if writers is not None and writers < 1:
            raise ValueError("option 'sink.parallelism' must be at least 1")

    def _batch_size(self) -> None:
        if self.flag("td.batch.mode") and self.number("batch.size") < 1:
            raise ValueError("option 'batch.size' must be at least 1")

    @property
    def sink_table(self) -> str:
        """The target's name; a super table wins if both names are given."""
        return self.get("sink.supertable.name") or self.get("sink.table.name")

    @property
    def connection(self) -> dict[str, str]:
        return {name: str(self.given[name]) for name in CONNECTION_OPTIONS if self.given.get(name) is not None}
