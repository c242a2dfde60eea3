"""Sinks: messages, console, lake table, keyed upserts."""

from wattspan.sinks.fanout import FanOut, commit_batch, pack, read_target, write_fan_out
from wattspan.sinks.lake import (
    lake_table,
    read_rejects,
    with_partition_columns,
    write_lake,
    write_lake_and_rejects,
)
from wattspan.sinks.merge_table import (
    MergeTable,
    add_batch,
    latest_table,
    read_merged,
    runs_of,
    write_merged,
)
from wattspan.sinks.messages import SinkSpec, write_console, write_messages
from wattspan.sinks.upsert import (
    UpsertSpec,
    compact_upserts,
    index_spec,
    read_upserts,
    write_batch,
    write_upsert,
)
from wattspan.sinks.versions import read_version, write_versions

__all__ = [
    "FanOut",
    "MergeTable",
    "SinkSpec",
    "UpsertSpec",
    "add_batch",
    "commit_batch",
    "compact_upserts",
    "index_spec",
    "lake_table",
    "latest_table",
    "pack",
    "read_merged",
    "read_rejects",
    "read_target",
    "read_upserts",
    "read_version",
    "runs_of",
    "with_partition_columns",
    "write_batch",
    "write_console",
    "write_fan_out",
    "write_lake",
    "write_lake_and_rejects",
    "write_merged",
    "write_messages",
    "write_upsert",
    "write_versions",
]
