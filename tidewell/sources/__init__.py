"""Bounded sources: SQL over stored tables, and external databases over JDBC."""

from .jdbc import read_jdbc, scan_jdbc
from .scan import run_sql, scan

__all__ = ["read_jdbc", "run_sql", "scan", "scan_jdbc"]
