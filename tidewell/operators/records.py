"""User code over rows, when column expressions cannot say it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, types as T


def map_records(
    df: DataFrame, convert: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Rows through user code, a batch of rows at a time; the result is bound by column name.

    For a plain choice of columns use ``decode_rows``, which stays out of Python.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = target.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield convert(batch)[names]

    return df.mapInPandas(run, target)
