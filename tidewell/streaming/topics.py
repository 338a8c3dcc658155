"""A topic is a stored SELECT over the log of a table, read as a stream.

The log is append-only, so the stream is insert-only. Every row carries its sub-table in
``tbname`` if the SELECT asks for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import fs
from ..sinks.store import BATCH, COMMIT, TableStore


@dataclass(frozen=True)
class ConsumerGroup:
    """Where a group keeps its progress: the checkpoint of its stream and its first start."""

    folder: str

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    @property
    def start_file(self) -> str:
        return f"{self.folder}/start.json"


@dataclass(frozen=True)
class Topic:
    spark: SparkSession
    path: str

    @staticmethod
    def create(
        spark: SparkSession, path: str, table: TableStore, select: Sequence[str] = ("*",), where: str = ""
    ) -> "Topic":
        """Store the SELECT: columns as SQL expressions, and an optional condition."""
        if fs.exists(spark, f"{path.rstrip('/')}/topic.json"):
            raise ValueError(f"there is a topic at {path} already")
        stored = {"table": table.path, "select": list(select), "where": where}
        fs.write_json(spark, f"{path.rstrip('/')}/topic.json", stored)
        return Topic(spark, path.rstrip("/"))

    @staticmethod
    def open(spark: SparkSession, path: str) -> "Topic":
        if not fs.exists(spark, f"{path.rstrip('/')}/topic.json"):
            raise ValueError(f"there is no topic at {path}")
        return Topic(spark, path.rstrip("/"))

    def group(self, name: str) -> ConsumerGroup:
        return ConsumerGroup(f"{self.path}/groups/{name}")

    def read(
        self,
        group: ConsumerGroup,
        reset: str = "latest",
        files_per_batch: int | None = None,
        bytes_per_batch: str | None = None,
        with_positions: bool = False,
    ) -> DataFrame:
        """The topic as a streaming frame.

        ``reset`` matters only the first time a group starts: ``earliest`` reads all history,
        ``latest`` only batches written after that moment. The choice is stored, and later
        starts go on from the group's checkpoint. ``files_per_batch`` or ``bytes_per_batch``
        (such as ``"500g"``) bounds a micro-batch, so that a long history comes in steps that
        are recorded one by one.

        ``with_positions`` adds where each row of a numbered table stands: its ``vgroup``, the bucket that
        all rows of its sub-table share, and its ``position`` there. Positions count every row that was
        written from 0, without gaps, later writes after earlier ones; a topic with a condition shows
        some of them.
        """
        stored = fs.read_json(self.spark, f"{self.path}/topic.json")
        table = TableStore.open(self.spark, stored["table"])
        if with_positions and not table.spec.numbered:
            raise ValueError(f"table {table.spec.name!r} is not numbered, so its rows have no positions")
        after = self._start(group, reset, table)

        layout = [T.StructField(COMMIT, T.LongType()), T.StructField(BATCH, T.StringType())]
        types = {"period": T.DateType(), "bucket": T.IntegerType()}
        layout += [T.StructField(name, types[name]) for name in table.spec.layout]
        reader = self.spark.readStream.schema(T.StructType([*table.spec.schema.fields, *layout]))
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        if bytes_per_batch is not None:
            reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
        rows = reader.parquet(f"{table.path}/log")
        if after:
            rows = rows.where(F.col(COMMIT) > after)
        columns = [F.col(f"`{name}`") for name in table.spec.schema.names]
        if with_positions:
            vgroup = F.col("bucket") if table.spec.super_table else F.lit(0)
            columns += [vgroup.alias("_vgroup"), _position().alias("_position")]
        rows = rows.select(*columns)
        if stored["where"]:
            rows = rows.where(stored["where"])
        every = [f"`{name}`" for name in table.spec.schema.names]
        chosen = [c for item in stored["select"] for c in (every if item.strip() == "*" else [item])]
        places = ["_vgroup AS vgroup", "_position AS position"] if with_positions else []
        return rows.selectExpr(*chosen, *places)

    def _start(self, group: ConsumerGroup, reset: str, table: TableStore) -> int:
        """The commit a group starts after: 0 for all history, the last one at its first start for the latest."""
        if reset not in ("earliest", "latest"):
            raise ValueError(f"a topic starts at 'earliest' or 'latest', not at {reset!r}")
        if not fs.exists(self.spark, group.start_file):
            after = table.last_commit() if reset == "latest" else 0
            fs.publish_json(self.spark, group.start_file, {"reset": reset, "after": after})
        return fs.read_json(self.spark, group.start_file)["after"]


def _position() -> Column:
    """Where a row stands: its file's first row, as the name says, and its place in the file."""
    first = F.regexp_extract("_metadata.file_name", r"^at(\d+)-", 1).cast("long")
    return first + F.col("_metadata.row_index")
