"""Keyed-message sink and console sink."""

from __future__ import annotations

import sys
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import TextIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattspan.functions.metrics import ColumnOrName
from wattspan.operators.parse import JSON_TIMESTAMP, to_messages
from wattspan.streaming.control import Run


@dataclass(frozen=True)
class SinkSpec:
    """Where messages go: a Kafka topic, or a folder of message files."""

    location: str
    kind: str = "kafka"
    servers: str | None = None
    key: ColumnOrName = "region"
    extra: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind == "kafka" and not self.servers:
            raise ValueError("a Kafka sink needs its bootstrap servers")

    def options(self) -> dict[str, str]:
        if self.kind == "kafka":
            own = {"kafka.bootstrap.servers": str(self.servers), "topic": self.location}
        else:
            own = {"path": self.location}
        return {**own, **self.extra}


def write_messages(
    df: DataFrame, spec: SinkSpec, run: Run | None = None
) -> StreamingQuery | None:
    """Republish rows as keyed JSON; a stream needs ``run`` and appends."""
    messages = to_messages(df, spec.key)
    if df.isStreaming:
        if run is None:
            raise ValueError("a streaming write needs a Run")
        return run.start(messages, lambda w: w.format(spec.kind).options(**spec.options()))
    messages.write.format(spec.kind).options(**spec.options()).mode("append").save()
    return None


def print_batch(batch: DataFrame, batch_id: int, out: TextIO) -> None:
    """A heading, then every row as a line of JSON, a partition at a time."""
    out.write(f"# batch {batch_id}\n")
    lines = batch.select(F.to_json(F.struct("*"), {"timestampFormat": JSON_TIMESTAMP}).alias("line"))
    for row in lines.toLocalIterator():
        out.write(f"{row['line']}\n")
    out.flush()


def write_console(
    df: DataFrame, run: Run, rows: int | None = 20, out: TextIO | None = None
) -> StreamingQuery:
    """Print each batch untruncated; ``Run.mode`` is usually ``complete``.

    By default Spark's console shows the first ``rows``. With ``rows=None``, or another text
    file than the console's in ``out``, all rows are printed as JSON.
    """
    if rows is None or out is not None:
        target = out or sys.stdout
        return run.start(df, lambda w: w.foreachBatch(lambda batch, number: print_batch(batch, number, target)))
    return run.start(
        df, lambda w: w.format("console").option("truncate", False).option("numRows", rows)
    )
