"""External databases through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..model import TBNAME
from ..operators.slices import top_per_table
from ..plans.request import ScanRequest, dealt
from .scan import time_column


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    predicates: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A query run by the database; with predicates, one Spark partition per predicate.

    Filters and column choices on the result are pushed into the database by Spark.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**dict(options or {}))
    reader = reader.option("fetchsize", str(fetch_rows))
    if predicates is None:
        return reader.option("query", query).load()
    if not predicates:
        return reader.option("query", f"select * from ({query}) q where 1 = 0").load()
    settings = {**dict(options or {}), "fetchsize": str(fetch_rows)}
    return spark.read.jdbc(url, f"({query}) q", predicates=list(predicates), properties=settings)


#: Partitions, and so connections at a time, of a sliced read.
PARTITIONS = 64


def scan_jdbc(
    spark: SparkSession,
    url: str,
    request: ScanRequest,
    options: Mapping[str, str] | None = None,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """The rows a request asks for, from a database that cuts them into the request's slices.

    Any number of windows, tag predicates or sub-tables is read in about ``partitions`` partitions, each
    of which asks for several of them. A row that matches two predicates comes twice. With a list of
    sub-tables ``order_by`` and ``limit`` hold for each of them, on the columns of the request and the
    sub-table name.
    """
    if request.tags is not None and len(request.tags) > partitions:
        query = request.sql_text()
        parts = [
            " union all ".join(f"select * from ({query}) q where {tag}" for tag in tags)
            for tags in dealt(list(request.tags), partitions)
        ]
        return reduce(DataFrame.union, [read_jdbc(spark, url, part, options=options) for part in parts])
    if request.tables is None:
        return read_jdbc(spark, url, request.sql_text(), request.predicates(partitions), options)
    if request.sql:
        query = request.sql
    else:
        query = f"select {TBNAME}, {request.select} from {request.table}" if request.select != "*" else (
            f"select * from {request.table}"
        )
        if request.where:
            query += f" where {request.where}"
    rows = read_jdbc(spark, url, query, request.predicates(partitions), options)
    if request.limit is not None:
        rows = top_per_table(rows, request.limit, request.order_by or (time_column(request, rows),))
    return rows if request.sql or request.select == "*" else rows.drop(TBNAME)
