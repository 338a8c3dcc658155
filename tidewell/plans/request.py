"""A bounded read, as the user asks for it."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from .time_range import TimeRange


@dataclass(frozen=True)
class ScanRequest:
    """Either a whole ``sql`` text or its parts, and at most one way to slice the result.

    A whole text wins over the parts. ``order_by`` holds names, each with an optional
    ``" desc"``. With ``tables`` the order and the limit hold for each sub-table on its own; a limit
    without an order takes the first rows by ``time_column``.
    """

    sql: str = ""
    select: str = "*"
    table: str = ""
    where: str = ""
    order_by: tuple[str, ...] = ()
    limit: int | None = None
    time: TimeRange | None = None
    tags: tuple[str, ...] | None = None
    tables: tuple[str, ...] | None = None
    time_column: str = ""

    def __post_init__(self):
        ways = [w for w in (self.time, self.tags, self.tables) if w is not None]
        if len(ways) > 1:
            raise ValueError("slice by time, by tags or by tables, not by several of them")
        if not self.sql and not self.table:
            raise ValueError("a scan needs a sql text or a table name")

    def sql_text(self, ordered: bool = True) -> str:
        """The query that yields the rows before any slicing."""
        if self.sql:
            return self.sql
        text = f"select {self.select} from `{self.table}`"
        if self.where:
            text += f" where {self.where}"
        if ordered and self.order_by:
            text += " order by " + ", ".join(self.order_by)
        if ordered and self.limit is not None:
            text += f" limit {self.limit}"
        return text

    def predicates(self, partitions: int | None = None) -> list[str] | None:
        """Conditions that cut the read for an external database; None if it is not sliced there.

        There is one for each slice, or with ``partitions`` at most about so many: neighbouring windows are
        read as one, and sub-tables as lists. A sub-table listed again is in a condition of its own, since it
        is read again. Tag predicates may overlap, so they are never joined here.
        """
        if self.time is not None:
            windows = self.time.windows()
            parts = [(part[0][0], part[-1][1]) for part in dealt(windows, partitions)]
            return [f"{self.time.column} >= {start} and {self.time.column} < {end}" for start, end in parts]
        if self.tags is not None:
            return list(self.tags)
        if self.tables is not None:
            # a quote in a name is doubled, as in any SQL text
            left = Counter(self.tables)
            conditions = []
            while left:
                for names in dealt(["'" + name.replace("'", "''") + "'" for name in left], partitions):
                    listed = f"in ({', '.join(names)})" if len(names) > 1 else f"= {names[0]}"
                    conditions.append(f"tbname {listed}")
                left -= Counter(list(left))
            return conditions
        return None


def dealt(items: list, parts: int | None) -> list[list]:
    """Consecutive items in at most ``parts`` lists of about one length; one list each without a number."""
    count = len(items) if parts is None else min(len(items), max(1, parts))
    return [items[len(items) * i // count : len(items) * (i + 1) // count] for i in range(count)]
