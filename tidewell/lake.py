"""A lake: databases of stored tables and topics below one folder."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from . import fs
from .model import TableSpec
from .plans.request import ScanRequest
from .sinks.store import TableStore
from .sources.scan import names, run_sql, scan, split_sql
from .streaming.topics import Topic


@dataclass(frozen=True)
class Lake:
    """``<root>/<database>/<table>`` and ``<root>/topics/<topic>``."""

    spark: SparkSession
    root: str

    def _table_path(self, database: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{database}/{table}"

    def _topic_path(self, topic: str) -> str:
        return f"{self.root.rstrip('/')}/topics/{topic}"

    def create_table(self, database: str, spec: TableSpec) -> TableStore:
        return TableStore.create(self.spark, self._table_path(database, spec.name), spec)

    def table(self, database: str, table: str) -> TableStore:
        return TableStore.open(self.spark, self._table_path(database, table))

    def tables(self, database: str) -> dict[str, TableStore]:
        return {name: self.table(database, name) for name in self._table_names(database)}

    def _table_names(self, database: str) -> list[str]:
        found = fs.glob(self.spark, f"{self._table_path(database, '*')}/table.json")
        return [path.split("/")[-2] for path in found]

    def create_topic(self, topic: str, table: TableStore, select=("*",), where: str = "") -> Topic:
        return Topic.create(self.spark, self._topic_path(topic), table, select, where)

    def topic(self, topic: str) -> Topic:
        return Topic.open(self.spark, self._topic_path(topic))

    def _prepared(self, database: str, text: str) -> tuple[str, dict[str, DataFrame]]:
        """The rows of the tables a text names, and the text with their names unqualified. Literals
        and comments name nothing and stay as they are."""
        parts = split_sql(text)
        code = " ".join(part for part, is_code in parts if is_code)
        used = {name: self.table(database, name).read() for name in self._table_names(database) if names(code, name)}
        for name in used:
            database_name, table = re.escape(database), re.escape(name)
            qualified = rf"(?<![\w`.])(?:`{database_name}`|{database_name})\s*\.\s*(?:`{table}`|{table}(?![\w`]))"
            parts = [(re.sub(qualified, f"`{name}`", part) if is_code else part, is_code) for part, is_code in parts]
        return "".join(part for part, _ in parts), used

    def sql(self, database: str, text: str) -> DataFrame:
        """A query over the tables of a database, by their names alone or after the database's."""
        return run_sql(self.spark, *self._prepared(database, text))

    def scan(self, database: str, request: ScanRequest) -> DataFrame:
        """``scan`` over stored tables.

        A request by table name leaves out the folders its time range or sub-table list rules
        out. (A limit in the request applies before the time range, so then it cannot.) A
        request by text is pruned by the conditions in the text.
        """
        if request.sql:
            text, used = self._prepared(database, request.sql)
            return scan(self.spark, replace(request, sql=text), used)
        store = self.table(database, request.table)
        if not request.time_column:
            request = replace(request, time_column=f"`{store.spec.time}`")
        start = end = None
        time = request.time
        if time is not None and not time.empty and time.column == store.spec.time and request.limit is None:
            start, end = time.start, time.end
        # a limit applies before the predicates, which then must not narrow what is read
        tags = request.tags if request.limit is None else None
        return scan(self.spark, request, {request.table: store.read(start, end, request.tables, tags)})
