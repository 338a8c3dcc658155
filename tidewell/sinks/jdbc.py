"""Write to an external database through Spark's JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame, url: str, table: str, batch_rows: int = 500, writers: int | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Append rows, ``batch_rows`` per round trip (one row if it is not positive).

    At least once: a task that is retried sends its rows again, and the database's row key
    collapses them.
    """
    if writers is not None:
        df = df.repartition(writers)
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(max(1, batch_rows)))
        .options(**dict(options or {}))
        .mode("append")
        .save()
    )
