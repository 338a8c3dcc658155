"""Bounded reads cut by time, by tag predicate or by sub-table.

Each is one pass over its input. Whether the slices run in parallel is up to the file splits;
the slice number is only a column.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..model import TBNAME
from ..plans.time_range import TimeRange
from .numbering import number_rows, sort_columns

# Up to here a list of names is a plain IN condition, which the file scan can use.
IN_LIST_NAMES = 1_000
# Up to here a list is sent to every task; beyond it both sides are shuffled.
LISTED_NAMES = 100_000
# Up to here Spark itself cuts every group before the shuffle.
GROUP_LIMIT_ROWS = 1_000
# Into how many parts a large sub-table falls in a shuffled join.
SALTS = 64


def slice_by_time(df: DataFrame, time_range: TimeRange, out: str = "slice") -> DataFrame:
    """The rows inside the range, with the index of their window in ``out``.

    One range condition on the bare column reaches the scan, however many windows there are.
    """
    if time_range.empty:
        return df.where(F.lit(False)).withColumn(out, F.lit(0).cast("long"))
    if time_range.name not in df.columns:
        raise ValueError(f"there is no column {time_range.column!r} to slice by time")
    data_type = df.schema[time_range.name].dataType
    return df.where(time_range.contains(data_type)).withColumn(out, time_range.window_index(data_type))


def slice_by_tags(df: DataFrame, predicates: Sequence[str], out: str = "slice") -> DataFrame:
    """For every predicate the rows that match it, with the predicate's index in ``out``.

    A row that matches several predicates comes several times, one that matches none is left
    out. All predicates are tried in the same pass over the rows.
    """
    if not predicates:
        return df.where(F.lit(False)).withColumn(out, F.lit(0))
    conditions = [F.expr(f"({p})") for p in predicates]
    any_match = conditions[0]
    for condition in conditions[1:]:
        any_match = any_match | condition
    matches = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
    return df.where(any_match).withColumn(out, F.explode(matches))


def read_tables(
    df: DataFrame, tables: Sequence[str] | DataFrame, name: str = TBNAME
) -> DataFrame:
    """The rows of the listed sub-tables. A sub-table listed twice is read twice.

    ``tables`` is a list of names, or a frame with a column ``name`` when the list itself is
    data; it is then joined, and run-time sizes decide how.
    """
    if isinstance(tables, DataFrame):
        # as in any equality, NULL is no name
        listed = tables.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_times"))
        return _join_listed(df, listed, name)
    times = Counter(tables)
    if len(times) <= IN_LIST_NAMES:
        chosen = df.where(F.col(name).isin(list(times)) if times else F.lit(False))
        repeated = {n: c for n, c in times.items() if c > 1}
        if not repeated:
            return chosen
        lookup = F.create_map(*[F.lit(x) for pair in repeated.items() for x in pair])
        return _repeat(chosen, F.coalesce(lookup[F.col(name)], F.lit(1)))
    listed = df.sparkSession.createDataFrame(list(times.items()), f"`{name}` string, _times long")
    if len(times) > LISTED_NAMES:
        return _join_listed(df, listed, name)
    return _repeat(df.join(F.broadcast(listed), name), F.col("_times")).select(*df.columns)


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).drop("_copy")


def _join_listed(df: DataFrame, listed: DataFrame, name: str) -> DataFrame:
    """A list of any length. At run time a short one is sent to every task; else both sides are shuffled
    by name and salt, so that one large sub-table spreads over many tasks."""
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    if not hashed:
        hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(SALTS)).cast("int"))
    copies = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return _repeat(salted.join(copies, [name, "_salt"]), F.col("_times")).select(*[F.col(f"`{c}`") for c in df.columns])


def top_per_table(df: DataFrame, limit: int, order_by: Sequence[str], name: str = TBNAME) -> DataFrame:
    """The first ``limit`` rows of every sub-table in the order given.

    Small limits cut every sub-table before the shuffle (the plan shows a partial group
    limit). For large ones the rows are numbered piece by piece, and pieces past the limit are
    dropped before they are sorted. Both ways take any order.
    """
    if limit <= GROUP_LIMIT_ROWS:
        window = Window.partitionBy(name).orderBy(*sort_columns(order_by))
        return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= limit).drop("_rank")
    return number_rows(df, [name], order_by, out="_rank", up_to=limit).drop("_rank")
