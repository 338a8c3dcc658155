"""Collapse of rows with an equal key: the latest one survives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

_LEAST = -(2**63)
_FIXED_WIDTH = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)
_WHOLE_NUMBER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def collapse_rows(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), distinct_order: bool = False
) -> DataFrame:
    """One row per key: the one with the largest ``order_by``; the other columns break ties.

    An aggregate, not a window: copies of a row die on the map side, so any number of copies
    of one key shuffles as one row per map task.

    ``distinct_order`` promises that no two different rows of a key share their (single,
    whole-number) ``order_by``. If all other columns have a fixed width, the aggregate then
    stays in a hash table and neither side sorts.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    fields = {f.name: f.dataType for f in df.schema.fields}
    if (
        distinct_order
        and len(order_by) == 1
        and isinstance(fields[order_by[0]], _WHOLE_NUMBER)
        and all(isinstance(fields[c], _FIXED_WIDTH) for c in rest)
    ):
        order = F.coalesce(F.col(order_by[0]).cast("long"), F.lit(_LEAST))
        columns = [F.max(order_by[0]).alias(order_by[0])] + [F.max_by(c, order).alias(c) for c in rest]
        return df.groupBy(*key).agg(*columns).select(*df.columns)
    winner = F.max(F.struct(*order_by, *rest)).alias("_winner")
    return df.groupBy(*key).agg(winner).select(*[c if c in key else f"_winner.{c}" for c in df.columns])
