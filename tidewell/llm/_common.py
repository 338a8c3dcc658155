"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fs
from ..session import shared_folder

#: The letters that are folded, nothing beyond ASCII.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word is a run of anything but the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(column: str | Column) -> Column:
    """The text as a string; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text as an array, in order."""
    return F.filter(F.split(text, SPACE, -1), lambda word: word != "")


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def finite_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector is not null and holds finite numbers only, the vector as doubles."""
    whole = F.forall(column, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    return vectors.withColumn(column, F.col(column).cast("array<double>")).where(whole)


_OWNED: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is deleted at the end; a result that needs it must be written by then."""
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            fs.delete(spark, path)


def stored(df: DataFrame, label: str, kept: bool = False) -> DataFrame:
    """``df`` written once below the shared folder and read from there.

    This cuts the lineage: a lost executor costs the tasks it ran, not the jobs before them, and
    what follows reads files without an inherited partitioning, so that skewed joins can be split.
    It goes with the scratch it is made in, unless it is ``kept`` for the one around that.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    owners = _OWNED[:-1] if kept else _OWNED
    if owners:
        owners[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: list[tuple] = []


def kept_in_process(key: tuple, make):
    """What ``make`` yields, kept for later tasks of this worker process. A process keeps one thing at
    a time, so that the models of different operators do not add up in an executor's memory."""
    if not _KEPT or _KEPT[0][0] != key:
        _KEPT.clear()
        gc.collect()
        _KEPT.append((key, make()))
    return _KEPT[0][1]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_in_groups(
    batches: Iterable[pa.RecordBatch], key: str, most: int = 1 << 16
) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys, from batches that are sorted by the key.

    A table is passed on once it has ``most`` rows and its last run has ended.
    """
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        size += batch.num_rows
        if size < most:
            continue
        table = pa.Table.from_batches(kept)
        keys = table.column(key).combine_chunks().to_numpy(zero_copy_only=False)
        cut = int(keys.searchsorted(keys[-1], side="left"))
        if cut:
            yield table.slice(0, cut)
            kept = table.slice(cut).combine_chunks().to_batches()
            size = table.num_rows - cut
    if kept:
        yield pa.Table.from_batches(kept)
