"""Typed decoding of raw rows as column expressions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..model import type_name_of

_TEXT = {"VARCHAR", "BINARY", "NCHAR", "JSON"}
_RAW = {"VARBINARY", "GEOMETRY"}


def decode_column(source: Column, source_type: T.DataType, target: T.StructField, charset: str = "UTF-8") -> Column:
    """One raw value as the type of ``target``; NULL stays NULL, a bad value is an error.

    Texts may come as bytes in ``charset``, time stamps as epoch milliseconds. Other values convert as
    in a write: without loss or not at all, whatever the session's ANSI setting.
    """
    kind = type_name_of(target)
    if kind in _TEXT and isinstance(source_type, T.BinaryType):
        return F.decode(source, charset)
    if kind in _RAW and isinstance(source_type, T.StringType):
        return F.encode(source, charset)
    if kind == "TIMESTAMP" and isinstance(source_type, T.IntegralType):
        return F.timestamp_millis(source)
    from ..operators.binding import checked  # these modules build on each other

    return checked(source, source_type, target)


def decode_rows(df: DataFrame, schema: T.StructType, charset: str = "UTF-8") -> DataFrame:
    """Rows as the declared ``schema``, matched by column name.

    Works on batch and streaming frames alike; both decode through these same expressions.
    """
    source = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in source]
    if missing:
        raise ValueError(f"the rows have no column {', '.join(missing)}")
    return df.select(
        *[decode_column(F.col(f"`{f.name}`"), source[f.name], f, charset).alias(f.name) for f in schema.fields]
    )


def json_field(text: Column, path: str, type_name: str) -> Column:
    """One field of a JSON text as a typed column, e.g. ``json_field(props, "$.k", "int")``."""
    return F.get_json_object(text, path).cast(type_name)
