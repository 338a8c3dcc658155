"""Operators: each takes DataFrames and returns a DataFrame, lazily."""

from .batches import pack_rows, unpack_rows
from .binding import bind_rows, check_rows, split_rejects
from .collapse import collapse_rows
from .numbering import number_rows
from .records import map_records
from .slices import read_tables, slice_by_tags, slice_by_time, top_per_table

__all__ = [
    "bind_rows",
    "check_rows",
    "collapse_rows",
    "map_records",
    "number_rows",
    "pack_rows",
    "read_tables",
    "slice_by_tags",
    "slice_by_time",
    "split_rejects",
    "top_per_table",
    "unpack_rows",
]
