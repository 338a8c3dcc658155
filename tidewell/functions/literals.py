"""Rows as the literals of an INSERT statement, rendered by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..model import type_name_of
from .timestamps import millis

_QUOTE = "'"


def _quoted(text: Column) -> Column:
    doubled = F.replace(text, F.lit(_QUOTE), F.lit(_QUOTE * 2))
    return F.concat(F.lit(_QUOTE), doubled, F.lit(_QUOTE))


def literal(column: Column, struct_field: T.StructField) -> Column:
    """The SQL literal of a value: NULL as ``NULL``, text quoted with its quotes doubled,
    time stamps as epoch milliseconds, raw bytes as a quoted ``\\x`` hex text."""
    kind = type_name_of(struct_field)
    if kind in ("VARCHAR", "BINARY", "NCHAR", "JSON"):
        text = _quoted(column)
    elif kind in ("VARBINARY", "GEOMETRY"):
        text = F.concat(F.lit("'\\x"), F.hex(column), F.lit(_QUOTE))
    elif kind == "TIMESTAMP":
        text = millis(column).cast("string")
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def row_tuple(schema: T.StructType) -> Column:
    """A whole row as ``(literal,literal,...)``."""
    literals = [literal(F.col(f"`{f.name}`"), f) for f in schema.fields]
    return F.concat(F.lit("("), F.concat_ws(",", *literals), F.lit(")"))
