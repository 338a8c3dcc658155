"""Sinks: stored tables, external databases, INSERT texts, and a resumable copy."""

from .copy import copy_slices
from .inserts import insert_statements, write_statements
from .jdbc import write_jdbc
from .store import TableStore

__all__ = ["TableStore", "copy_slices", "insert_statements", "write_jdbc", "write_statements"]
