"""Exact dedup: two passes over a Bloom filter decide which rows have to be shuffled at all.

Pass 1 sets two bits per text in a filter of bounded size, separately in every task, and keeps the
bits that were set at least twice. Pass 2 tests every row against these bits: a text that occurs
twice always passes the test, so rows that fail it are unique and go straight through. Only the
rest is shuffled and compared by the whole SHA-256.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._common import ascii_lower, stored, whole_text

#: Bits of one piece of the filter, the unit in which filters are merged.
PIECE_BITS = 1 << 20
#: Filters that one merging task takes.
MERGED = 256


def text_digest(text: str | Column) -> Column:
    """SHA-256 in lowercase hex of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(whole_text(text)), 256)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Two slots per key."""
    raw = keys.astype(np.int64).view(np.uint64)
    mask = np.uint64(bits - 1)
    return np.concatenate([raw & mask, (raw >> np.uint64(32)) & mask]).astype(np.int64)


def _pieces(bits: int):
    """One filter per task: for each piece the slots set, and those set twice or more."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, once, twice = 0, np.zeros(bits, bool), np.zeros(bits, bool)
        for batch in batches:
            if batch.num_rows:
                task = batch.column("task")[0].as_py()
                slots, counts = np.unique(_slots(batch.column("key").to_numpy(), bits), return_counts=True)
                twice[slots] |= once[slots] | (counts > 1)
                once[slots] = True
        size = min(bits, PIECE_BITS)
        for piece in range(bits // size):
            part = slice(piece * size, (piece + 1) * size)
            if once[part].any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "task": pa.array([task], pa.int32()),
                        "piece": pa.array([piece], pa.int32()),
                        "once": pa.array([_packed(once[part])], pa.binary()),
                        "twice": pa.array([_packed(twice[part])], pa.binary()),
                    }
                )

    return fill


def _packed(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    once = twice = None
    for one, two in zip(group["once"], group["twice"]):
        one, two = _unpacked(one), _unpacked(two)
        if once is None:
            once, twice = one.copy(), two.copy()
        else:
            twice |= two | (once & one)
            once |= one
    first = group.iloc[0]
    return pd.DataFrame(
        {
            "task": [first["task"]],
            "piece": [first["piece"]],
            "once": [zlib.compress(once.tobytes(), 1)],
            "twice": [zlib.compress(twice.tobytes(), 1)],
        }
    )


_PIECE = "task int, piece int, once binary, twice binary"


class RepeatFilter:
    """The bits set twice or more over all keys. Never misses a repeated key."""

    def __init__(self, spark: SparkSession, bits: int, twice: np.ndarray):
        self.bits = bits
        self._shared = spark.sparkContext.broadcast(twice)

    @classmethod
    def build(cls, keys: DataFrame, column: str, max_bits: int = 1 << 28) -> "RepeatFilter":
        """``keys`` has a long column of hashes. The filter has 16 bits per row, at most ``max_bits``
        (32 MB): beyond that more rows pass the test, and the result stays the same."""
        spark = keys.sparkSession
        bits = 1 << 16
        rows = keys.count()
        while bits < 16 * rows and bits < max_bits:
            bits *= 2
        found = keys.select(
            F.spark_partition_id().alias("task"), F.col(column).alias("key")
        ).mapInArrow(_pieces(bits), _PIECE)
        tasks = max(1, keys.rdd.getNumPartitions())
        while True:
            found = (
                found.withColumn("task", F.expr(f"task div {MERGED}").cast("int"))
                .groupBy("task", "piece")
                .applyInPandas(_merge, _PIECE)
            )
            tasks = -(-tasks // MERGED)
            if tasks <= 1:
                break
        twice = np.zeros(bits // 8, np.uint8)
        size = min(bits, PIECE_BITS) // 8
        for row in found.select("piece", "twice").toLocalIterator():
            twice[row.piece * size : (row.piece + 1) * size] = _unpacked(bytes(row.twice))
        return cls(spark, bits, twice)

    def may_repeat(self, key: Column) -> Column:
        shared, bits = self._shared, self.bits

        @F.pandas_udf("boolean")
        def test(keys: pd.Series) -> pd.Series:
            slots = _slots(keys.to_numpy(), bits).reshape(2, -1)
            hit = shared.value[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1
            return pd.Series(hit.all(axis=0))

        return test(key)


def group_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest id stays (``kept``); a null id is smaller than any other. Rows
    that repeat both id and text are the same document: they count in ``group_size`` and share the
    verdict. Other columns are not read. An empty table gives no rows.
    """
    digests = stored(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256")), "digests")
    key = F.xxhash64("text_sha256")
    repeats = RepeatFilter.build(digests.select(key.alias("key")), "key")
    rows = digests.withColumn("again", repeats.may_repeat(key))
    single = rows.filter(~F.col("again")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    several = rows.filter("again").drop("again")
    groups = stored(
        several.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "groups",
    )
    joined = several.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return single.unionByName(joined)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each group of equal texts, all columns as they were.

    The row with the largest id stays; of rows that repeat id and text, any one. Rows whose text is
    certainly unique are passed on without a shuffle.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        text_digest(text_col).alias("digest"),
    )
    keys = stored(rows.select("id", "digest"), "digests")
    repeats = RepeatFilter.build(keys.select(F.xxhash64("digest").alias("key")), "key")
    again = repeats.may_repeat(F.xxhash64("digest"))
    keepers = stored(keys.filter(again).groupBy("digest").agg(F.max("id").alias("keep")), "keepers")
    tagged = rows.withColumn("again", again)
    several = tagged.filter("again").join(keepers, "digest").filter(F.col("id").eqNullSafe(F.col("keep")))
    return tagged.filter(~F.col("again")).select("row.*").unionByName(
        several.dropDuplicates(["digest"]).select("row.*")
    )
