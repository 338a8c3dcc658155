"""Bounded scans over DataFrames that stand for tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.slices import read_tables, slice_by_tags, slice_by_time, top_per_table
from ..plans.request import ScanRequest


SLICE = "_slice"

TIME = "_time"

#: Literals, comments and quoted names of SQL. Names are code, and so is what is between these.
_QUOTED = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|--[^\n]*|/\*.*?\*/|`(?:[^`]|``)*`)""", re.S)


def split_sql(sql: str) -> list[tuple[str, bool]]:
    """The text in parts, code and other ones in turn, each with whether it is code."""
    parts: list[tuple[str, bool]] = []
    for i, part in enumerate(_QUOTED.split(sql)):
        is_code = i % 2 == 0 or part.startswith("`")
        if parts and parts[-1][1] and is_code:
            parts[-1] = (parts[-1][0] + part, True)
        else:
            parts.append((part, is_code))
    return parts


def names(code: str, name: str) -> bool:
    """Whether the name stands in the code as a word."""
    return re.search(rf"(?<!\w){re.escape(name)}(?!\w)", code) is not None


def run_sql(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One query as one lazy frame; ``tables`` are the names it may use.

    The frames are seen under names of this call alone, which the query's own names refer to, so
    views of the session and other threads are not touched.
    """
    code = " ".join(part for part, is_code in split_sql(sql) if is_code)
    views = {name: f"_tidewell_{uuid.uuid4().hex}" for name in tables if names(code, name)}
    try:
        for name, view in views.items():
            tables[name].createOrReplaceTempView(view)
        listed = ", ".join(f"`{name}` AS (SELECT * FROM `{view}`)" for name, view in views.items())
        text = sql.strip().rstrip(";")
        return spark.sql(f"WITH {listed} SELECT * FROM (\n{text}\n)" if views else sql)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def scan(spark: SparkSession, request: ScanRequest, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows a request asks for. Sliced reads carry the number of their slice in ``slice``.

    The slices of a request by text cut that query's result. A request by parts is one query per
    time window, all in one pass: the windows lie below its columns, which need not hold the time, and an
    aggregate yields one row for each window. A limit applies before the slices. A sub-table list instead
    reads from the super table and applies order and limit per sub-table.
    """
    if request.tables is not None and request.sql:
        rows = read_tables(run_sql(spark, request.sql, tables), request.tables)
        order = request.order_by or (time_column(request, rows),)
        return rows if request.limit is None else top_per_table(rows, request.limit, order)
    if request.tables is not None:
        rows = read_tables(tables[request.table], request.tables)
        if request.where:
            rows = rows.where(request.where)
        if request.limit is not None:
            rows = top_per_table(rows, request.limit, request.order_by or (time_column(request, rows),))
        return run_sql(spark, f"select {request.select} from `{request.table}`", {request.table: rows})
    if request.time is not None and not request.sql:
        if request.limit is None:
            return _query_per_window(spark, request, tables[request.table])
        text = replace(request, select=f"{request.select}, {request.time.column} AS `{TIME}`").sql_text()
        limited = run_sql(spark, text, tables)
        return slice_by_time(limited, replace(request.time, column=TIME)).drop(TIME)
    rows = run_sql(spark, request.sql_text(), tables)
    if request.time is not None:
        return slice_by_time(rows, request.time)
    if request.tags is not None:
        return slice_by_tags(rows, request.tags)
    return rows


def time_column(request: ScanRequest, rows: DataFrame) -> str:
    """The time column of a table: the one the request names, ``ts``, or the first of its type."""
    if request.time_column:
        return request.time_column
    kinds = (T.TimestampType, T.TimestampNTZType)
    moments = [f.name for f in rows.schema.fields if isinstance(f.dataType, kinds)]
    if "ts" in rows.columns or not moments:
        return "ts"
    return f"`{moments[0]}`"


def _query_per_window(spark: SparkSession, request: ScanRequest, frame: DataFrame) -> DataFrame:
    """The request's query on the rows of every window, as one query."""
    sliced = slice_by_time(frame, request.time, SLICE)
    bare = replace(request, order_by=(), time=None)
    if not _is_aggregate(run_sql(spark, bare.sql_text(), {request.table: frame})):
        text = replace(request, select=f"{request.select}, `{SLICE}` AS slice").sql_text()
        return run_sql(spark, text, {request.table: sliced}).drop(SLICE)
    text = replace(bare, select=f"{request.select}, `{SLICE}` AS slice").sql_text() + f" group by `{SLICE}`"
    found = run_sql(spark, text, {request.table: sliced})
    # an aggregate over a window without rows is a row, too: that of an empty table
    count = len(request.time.windows())
    if not count:
        return found
    nothing = run_sql(spark, bare.sql_text(), {request.table: frame.where(F.lit(False))})
    every = nothing.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    return found.unionByName(every.join(found.select("slice"), "slice", "left_anti").select(*found.columns))


def _is_aggregate(df: DataFrame) -> bool:
    """Whether a query without GROUP BY has an aggregate for its columns."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "SubqueryAlias", "WithCTE") and plan.children().size():
        plan = plan.children().apply(plan.children().size() - 1 if plan.nodeName() == "WithCTE" else 0)
    return plan.nodeName() == "Aggregate"
