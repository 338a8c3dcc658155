"""Rows as INSERT statements of bounded length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..functions.literals import row_tuple
from ..model import TableSpec

# Fixed value: a statement stays below this many characters.
STATEMENT_CHARS = 1_000_000


def insert_statements(df: DataFrame, spec: TableSpec, database: str, limit: int = STATEMENT_CHARS) -> DataFrame:
    """One row per statement: its text and the number of row tuples in it.

    Tuples are packed greedily inside each partition, across its Arrow batches, without a
    shuffle. A statement reaches the limit only if a single tuple does: it then stands alone.
    The literals are rendered by column expressions; Python only joins the texts.
    """
    names = ",".join(f"`{c}`" for c in df.columns)
    prefix = f"INSERT INTO `{database}`.`{spec.name}` ({names}) VALUES "

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_texts: list[str] = []
        open_chars = len(prefix)
        for batch in batches:
            texts = batch.column(0)
            chars = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
            values = texts.to_pylist()
            closed, start, done = [], 0, 0
            while start < len(values):
                # as many tuples as keep the open statement below the limit
                stop = int(np.searchsorted(chars, limit - open_chars + done, side="left"))
                stop = max(stop, start + (0 if open_texts else 1))
                open_texts.extend(values[start:stop])
                if stop < len(values):
                    closed.append((prefix + "".join(open_texts), len(open_texts)))
                    open_texts, open_chars = [], len(prefix)
                elif stop > start:
                    open_chars += int(chars[-1]) - done
                done = int(chars[stop - 1]) if stop else 0
                start = stop
            if closed:
                yield _statements(closed)
        if open_texts:
            yield _statements([(prefix + "".join(open_texts), len(open_texts))])

    return df.select(row_tuple(df.schema).alias("tuple")).mapInArrow(pack, "statement string, tuples int")


def _statements(closed: list[tuple[str, int]]) -> pa.RecordBatch:
    texts, counts = zip(*closed)
    return pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=["statement", "tuples"]
    )


def write_statements(statements: DataFrame, path: str) -> None:
    """The statements as text files, each ended by a semicolon and a line break."""
    statements.select("statement").write.mode("overwrite").option("lineSep", ";\n").text(path)
