"""Rows as batches, and batches as rows again."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def pack_rows(df: DataFrame, size: int = 2000, out: str = "rows") -> DataFrame:
    """Up to ``size`` rows per element of ``out`` (an array of rows), in the order they come.

    Partition-local: nothing is shuffled, and a task holds one Arrow batch plus less than one
    element of rows.
    """
    if size < 1:
        raise ValueError("a batch holds at least 1 row")
    packed = T.StructType([T.StructField(out, T.ArrayType(df.schema, False), False)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_over: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if left_over is not None and left_over.num_rows:
                rows = pa.concat_tables([left_over, rows])
            full = rows.num_rows // size * size
            if full:
                yield _as_elements(rows.slice(0, full), size, out)
            left_over = rows.slice(full)
        if left_over is not None and left_over.num_rows:
            yield _as_elements(left_over, size, out)

    return df.mapInArrow(pack, packed)


def _as_elements(rows: pa.Table, size: int, out: str) -> pa.RecordBatch:
    columns = [column.combine_chunks() for column in rows.columns]
    structs = pa.StructArray.from_arrays(columns, fields=list(rows.schema))
    ends = [*range(0, rows.num_rows, size), rows.num_rows]
    elements = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
    return pa.RecordBatch.from_arrays([elements], names=[out])


def unpack_rows(df: DataFrame, column: str = "rows") -> DataFrame:
    """The rows of all batches. A batch that is NULL or empty is an error."""
    bad = F.raise_error(F.lit(f"a batch in column {column} is NULL or empty"))
    batch = F.when(F.size(F.coalesce(F.col(column), F.array())) > 0, F.col(column)).otherwise(bad)
    return df.select(F.inline(batch))
