"""Tables declared and filled in SQL.

``CREATE TABLE name (columns) USING tidewell OPTIONS (...)`` declares a table by the options of
``open_table`` and ``open_sink``; ``INSERT INTO name SELECT ...`` writes into it. Spark's own parser reads the
statements. A table that can be read becomes a temporary view over its frame, so queries on it are
planned like any others and read their files natively.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from .model import column_field
from .plans.options import TableOptions
from .tables import open_sink, open_table

PROVIDER = "tidewell"


@dataclass(frozen=True)
class Declared:
    options: dict[str, str]
    schema: T.StructType | None


@dataclass
class Statements:
    """The tables one session has declared."""

    spark: SparkSession
    tables: dict[str, Declared] = field(default_factory=dict)

    def run(self, text: str) -> DataFrame | StreamingQuery | None:
        """One statement. A query, and any statement on other tables, is Spark's. An INSERT from a stream
        table starts a stream, which ends when it has read what is there, and returns it."""
        plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(text.strip().rstrip(";"))
        kind = plan.nodeName()
        if kind == "CreateTable" and _text(plan.tableSpec().provider()).lower() == PROVIDER:
            return self._create(plan)
        if kind == "InsertIntoStatement" and _name(plan.table()) in self.tables:
            return self._insert(plan)
        return self.spark.sql(text)

    def _create(self, plan) -> None:
        name = _name(plan.name())
        if name in self.tables:
            if plan.ignoreIfExists():
                return
            raise ValueError(f"table {name!r} is declared already")
        options = _options(plan.tableSpec())
        columns = _items(plan.columns())
        schema = T.StructType([_declared(c) for c in columns]) if columns else None
        opts = TableOptions(options)
        if options.get("scan.query") or options.get("topic"):
            open_table(self.spark, options, schema, view=name)
        else:
            opts.check_sink()
        self.tables[name] = Declared(options, schema)

    def _insert(self, plan) -> StreamingQuery | None:
        if plan.overwrite():
            raise ValueError("rows are only appended: INSERT OVERWRITE is not possible")
        target = self.tables[_name(plan.table())]
        listed = [str(c) for c in _items(plan.userSpecifiedCols())]
        fields = listed or (target.schema.names if target.schema is not None else None)
        sink = open_sink(self.spark, target.options, [f"`{f}`" for f in fields] if fields else None)
        rows = self._frame(plan.query())
        if not rows.isStreaming:
            sink.insert(rows, by="name" if plan.byName() else "position")
            return None
        if not plan.byName():
            rows = rows.toDF(*(fields or [f.name for f in sink.store.spec.schema.fields]))
        return sink.insert_stream(rows, self._stream_options(plan.query()))

    def _frame(self, plan) -> DataFrame:
        frames = self.spark._jvm.org.apache.spark.sql.classic.Dataset
        return DataFrame(frames.ofRows(self.spark._jsparkSession, plan), self.spark)

    def _stream_options(self, plan) -> dict[str, str]:
        """The options of the one stream table a query reads: its group keeps the progress."""
        used = {_name(leaf) for leaf in _items(plan.collectLeaves()) if leaf.nodeName() == "UnresolvedRelation"}
        streams = [name for name in used if name in self.tables and self.tables[name].options.get("topic")]
        if len(streams) != 1:
            raise ValueError("a stream is inserted from one stream table")
        return self.tables[streams[0]].options


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _text(option) -> str:
    return option.get() if option.isDefined() else ""


def _name(node) -> str:
    """The name of a table that is not resolved yet."""
    parts = node.nameParts() if node.nodeName() == "UnresolvedIdentifier" else node.multipartIdentifier()
    return ".".join(_items(parts))


def _options(spec) -> dict[str, str]:
    """The OPTIONS of a declaration; their values are literals."""
    pairs = _items(spec.optionExpression().options())
    return {pair._1(): str(pair._2().eval(None)) for pair in pairs}


def _declared(column) -> T.StructField:
    """A declared column as one of the model, where the model has its type."""
    data_type = T._parse_datatype_json_value(json.loads(column.dataType().json()))
    for name in ("BOOL", "TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "VARCHAR", "TIMESTAMP", "VARBINARY"):
        if column_field("x", name).dataType == data_type:
            return column_field(column.name(), name)
    if isinstance(data_type, (T.VarcharType, T.CharType)):
        return column_field(column.name(), "VARCHAR")
    raise ValueError(f"no column type of the model holds {data_type.simpleString()}, the type of {column.name()!r}")
