"""Streams into stored tables, replay-safe."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fs
from ..operators.batches import unpack_rows
from ..sinks.store import TableStore


def stream_into_table(
    stream: DataFrame,
    table: TableStore,
    checkpoint: str,
    fields: Sequence[str] | None = None,
    packed: str | None = None,
    poll_ms: int | None = None,
    output_mode: str = "append",
    after_write: Callable[[int], None] | None = None,
    writers: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Start a stream that writes each micro-batch as one batch of the table.

    The batch id joins the stream's own id, kept in its checkpoint, with the micro-batch
    number. A micro-batch that runs again after a crash therefore replaces what it wrote, and
    Spark records progress only once the write is committed. A new checkpoint has a new id and
    never replaces the batches of an older stream.

    ``packed`` names a column of row batches to unpack. With ``poll_ms`` the stream runs until
    it is stopped; without, it reads what is there and ends. ``after_write`` is called between
    the write and the record of progress. ``writers`` is the number of tasks that write a micro-batch. With ``rejects`` rows that
    don't convert go below that folder instead of stopping the stream.
    """
    def write(rows: DataFrame, number: int) -> None:
        stream_id = fs.read_json(table.spark, f"{checkpoint}/metadata")["id"]
        if packed is not None:
            rows = unpack_rows(rows, packed)
        batch = f"{stream_id}-{number}"
        if table.folded(batch):  # a replay of what a compaction has taken already
            pass
        elif rejects is not None:
            table.append_checked(rows, rejects, batch, writers)
        else:
            table.append(rows, batch=batch, fields=fields, writers=writers)
        if after_write is not None:
            after_write(number)

    return start_stream(stream, write, checkpoint, poll_ms, output_mode)


def start_stream(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    poll_ms: int | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a stream that hands each micro-batch of appended rows to ``write``."""
    if not stream.isStreaming:
        raise ValueError("the rows are not a stream; write them with TableStore.append")
    if output_mode != "append":
        raise ValueError(f"a table takes appended rows only, not output mode {output_mode!r}")
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if poll_ms is None else writer.trigger(
        processingTime=f"{poll_ms} milliseconds"
    )
    return writer.start()


def run_into_table(stream: DataFrame, table: TableStore, checkpoint: str, **settings) -> None:
    """As ``stream_into_table``, for all rows that are there now; returns when they are written."""
    stream_into_table(stream, table, checkpoint, **settings).awaitTermination()


def positions(df: DataFrame) -> DataFrame:
    """What was read of a topic with positions: per vgroup its last position and the number of rows."""
    return df.groupBy("vgroup").agg(F.max("position").alias("position"), F.count(F.lit(1)).alias("row_count"))
