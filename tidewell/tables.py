"""Tables opened by options, as a Table-SQL user declares them.

``td.jdbc.url`` is either a ``jdbc:`` address, read and written through Spark's JDBC source, or
the root folder of a lake. After a lake address the database is the option ``dbname`` or the
last part of the address.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from .functions.decode import decode_rows
from .functions.names import trim_backticks
from .lake import Lake
from .operators.batches import pack_rows, unpack_rows
from .operators.binding import resolve_fields
from .operators.records import map_records
from .plans.options import TableOptions
from .sinks.jdbc import write_jdbc
from .sinks.store import TableStore
from .sources.jdbc import scan_jdbc
from .streaming.pipeline import start_stream, stream_into_table
from .streaming.topics import ConsumerGroup


# User code over rows, a batch of rows at a time.
Convert = Callable[[pd.DataFrame], pd.DataFrame]
# The column of a table whose elements are batches of rows.
ELEMENT = "rows"


def _is_jdbc(url: str) -> bool:
    return url.startswith("jdbc:")


def _lake_and_database(spark: SparkSession, url: str, database: str | None) -> tuple[Lake, str]:
    bare = url.split("?")[0].rstrip("/")
    if database:
        return Lake(spark, bare), database
    root, _, last = bare.rpartition("/")
    if not last or not urlsplit(bare).path:
        raise ValueError(f"option 'td.jdbc.url' names no database: {url}")
    return Lake(spark, root), last


def open_table(
    spark: SparkSession,
    options: Mapping[str, str],
    schema: T.StructType | None = None,
    view: str | None = None,
    convert: Convert | None = None,
) -> DataFrame:
    """The rows of a declared table: a batch frame in mode ``source``, a stream in mode ``cdc``.

    ``schema`` is the declared table; columns are matched by name and decoded to its types, or
    made by the user's ``convert``, if one is given. Options ``scan.time.*``, ``scan.tags`` or
    ``scan.tables`` slice a bounded read. With ``td.batch.mode`` an element is an
    array of up to ``batch.size`` rows. ``view`` names a view for ``spark.sql``.
    """
    opts = TableOptions(options)
    opts.check_read()
    rows = _open_source(spark, opts) if opts.read_mode == "source" else _open_topic(spark, opts)
    if convert is not None:
        if schema is None:
            raise ValueError("converted rows need a declared schema")
        rows = map_records(rows, convert, schema)
    elif schema is not None:
        rows = decode_rows(rows, schema, opts.get("value.deserializer.encoding"))
    if opts.flag("td.batch.mode"):
        rows = pack_rows(rows, opts.number("batch.size"), ELEMENT)
    if view is not None:
        rows.createOrReplaceTempView(view)
    return rows


def _open_source(spark: SparkSession, opts: TableOptions) -> DataFrame:
    url, request = opts.get("td.jdbc.url"), opts.request()
    if _is_jdbc(url):
        return scan_jdbc(spark, url, request, opts.connection, opts.number("scan.partitions"))
    lake, database = _lake_and_database(spark, url, opts.get("dbname"))
    rows = lake.scan(database, request)
    # the table is the slices one after the other: windows and predicates only say which rows
    return rows if request.time is None and request.tags is None else rows.drop("slice")


def _topic_group(spark: SparkSession, opts: TableOptions):
    lake = Lake(spark, opts.get("url") or opts.get("bootstrap.servers"))
    topic = lake.topic(opts.get("topic"))
    return topic, topic.group(opts.get("group.id"))


def _open_topic(spark: SparkSession, opts: TableOptions) -> DataFrame:
    topic, group = _topic_group(spark, opts)
    return topic.read(group, opts.get("auto.offset.reset"))


def consumer_group(spark: SparkSession, options: Mapping[str, str]) -> ConsumerGroup:
    """The group a stream table reads as; its checkpoint holds the group's progress."""
    opts = TableOptions(options)
    opts.check_cdc()
    return _topic_group(spark, opts)[1]


@dataclass(frozen=True)
class TableSink:
    """A declared target. The mode option does not matter to a target.

    With ``td.batch.mode`` the rows come as elements of a batched table and are unpacked.
    """

    spark: SparkSession
    options: TableOptions
    fields: tuple[str, ...] | None = None
    convert: Convert | None = None

    @property
    def store(self) -> TableStore:
        url, database = self.options.get("td.jdbc.url"), self.options.get("sink.db.name")
        root = url.split("?")[0].rstrip("/").removesuffix(f"/{database}")
        return Lake(self.spark, root).table(database, self.options.sink_table)

    def _prepared(self, rows: DataFrame) -> DataFrame:
        if self.options.flag("td.batch.mode"):
            rows = unpack_rows(rows, ELEMENT)
        if self.convert is not None:
            if _is_jdbc(self.options.get("td.jdbc.url")):
                raise ValueError("converted rows need a table of a lake, which declares their types")
            bound = resolve_fields(self.store.spec, self.fields)
            rows = map_records(rows, self.convert, T.StructType(bound))
        return rows

    def insert(self, rows: DataFrame, by: str = "position") -> None:
        """``INSERT INTO``: the columns of ``rows`` meet the bound columns by position or by name."""
        rows = self._prepared(rows)
        if _is_jdbc(self.options.get("td.jdbc.url")):
            self._send(rows, by)
        else:
            self.store.append(rows, fields=self.fields, by=by, writers=self.options.number("sink.parallelism"))

    def _send(self, rows: DataFrame, by: str) -> None:
        """Into the external database; ``sink.batch.size`` rows go in one round trip."""
        names = [trim_backticks(f) for f in self.fields or rows.columns]
        if by == "position":
            if len(rows.columns) != len(names):
                raise ValueError(f"rows have {len(rows.columns)} fields, but {len(names)} columns are bound")
            rows = rows.toDF(*names)
        table = f"{self.options.get('sink.db.name')}.{self.options.sink_table}"
        batch_rows = self.options.number("sink.batch.size")
        write_jdbc(
            rows.select(*[f"`{n}`" for n in names]),
            self.options.get("td.jdbc.url"),
            table,
            batch_rows,
            self.options.number("sink.parallelism"),
            self.options.connection,
        )

    def insert_stream(
        self,
        rows: DataFrame,
        source: Mapping[str, str],
        until_stopped: bool = False,
        output_mode: str = "append",
    ) -> StreamingQuery:
        """Start a stream into the table; columns are matched by name.

        ``source`` are the options of the stream table the rows come from: its group keeps the
        progress, and its poll interval is the pace of a stream that runs until it is stopped.
        Otherwise the stream ends when it has read what is there. An external database gets the rows
        at least once; its row key collapses those that are sent again.
        """
        poll_ms = TableOptions(source).number("poll.interval_ms") if until_stopped else None
        rows, checkpoint = self._prepared(rows), consumer_group(self.spark, source).checkpoint
        if _is_jdbc(self.options.get("td.jdbc.url")):
            return start_stream(rows, lambda part, _: self._send(part, "name"), checkpoint, poll_ms, output_mode)
        return stream_into_table(
            rows,
            self.store,
            checkpoint,
            self.fields,
            poll_ms=poll_ms,
            output_mode=output_mode,
            writers=self.options.number("sink.parallelism"),
        )


def open_sink(
    spark: SparkSession,
    options: Mapping[str, str],
    fields: Sequence[str] | None = None,
    convert: Convert | None = None,
) -> TableSink:
    """A target table, its options checked. ``fields`` lists the bound columns, in order;
    ``convert`` makes them from the user's own records."""
    opts = TableOptions(options)
    opts.check_sink()
    return TableSink(spark, opts, tuple(fields) if fields is not None else None, convert)
