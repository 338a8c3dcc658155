"""Column functions: time stamps, decoding, literals and names."""

from .decode import decode_rows, json_field
from .literals import literal, row_tuple
from .names import trim_backticks
from .timestamps import from_millis, instant, local_to_utc, millis, to_millis_precision

__all__ = [
    "decode_rows",
    "from_millis",
    "instant",
    "json_field",
    "literal",
    "local_to_utc",
    "millis",
    "row_tuple",
    "to_millis_precision",
    "trim_backticks",
]
