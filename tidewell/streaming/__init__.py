"""Topics (append-only streams over a stored table) and pipelines that write streams."""

from .pipeline import positions, run_into_table, stream_into_table
from .topics import ConsumerGroup, Topic

__all__ = ["ConsumerGroup", "Topic", "positions", "run_into_table", "stream_into_table"]
