"""Tools for time-series super tables on Spark."""

from .lake import Lake
from .model import TableSpec, column_field
from .plans import ScanRequest, TableOptions, TimeRange
from .session import build_session, shared_folder
from .sinks import TableStore
from .sources import scan
from .statements import Statements
from .streaming import Topic
from .tables import consumer_group, open_sink, open_table

__all__ = [
    "Lake",
    "ScanRequest",
    "Statements",
    "TableOptions",
    "TableSpec",
    "TableStore",
    "TimeRange",
    "Topic",
    "build_session",
    "column_field",
    "consumer_group",
    "open_sink",
    "open_table",
    "scan",
    "shared_folder",
]
