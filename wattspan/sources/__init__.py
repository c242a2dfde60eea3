"""Sources: keyed messages and the lake table."""

from wattspan.sources.lake import read_lake
from wattspan.sources.messages import SourceSpec, read_messages, read_stream

__all__ = ["SourceSpec", "read_lake", "read_messages", "read_stream"]
