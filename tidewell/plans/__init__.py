"""What to read, as small values on the driver: time ranges, scan requests, table options."""

from .options import TableOptions
from .request import ScanRequest
from .time_range import TimeRange

__all__ = ["ScanRequest", "TableOptions", "TimeRange"]
