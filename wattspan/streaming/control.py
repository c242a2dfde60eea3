"""Starting, naming, checkpointing and awaiting streaming queries."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wattspan.session import STATE_CONF, session_conf


def checkpoint_for(base: str, query_name: str) -> str:
    """The checkpoint folder of one query. Spark creates it."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", query_name):
        raise ValueError(f"query name {query_name!r} is no plain folder name")
    return f"{base.rstrip('/')}/{query_name}"


@dataclass(frozen=True)
class Run:
    """How a query runs: its name, checkpoint base, trigger and output mode.

    Without ``interval`` the query processes what is there and ends. With
    ``state_partitions`` a stateful query gets that many state stores, fixed
    by its first run; windowed aggregates have few groups and need few.
    """

    name: str
    checkpoints: str
    mode: str = "append"
    interval: str | None = None
    state_partitions: int | None = None

    @property
    def checkpoint(self) -> str:
        return checkpoint_for(self.checkpoints, self.name)

    def writer(self, df: DataFrame) -> DataStreamWriter:
        writer = (
            df.writeStream.queryName(self.name)
            .outputMode(self.mode)
            .option("checkpointLocation", self.checkpoint)
        )
        if self.interval:
            return writer.trigger(processingTime=self.interval)
        return writer.trigger(availableNow=True)

    def start(
        self, df: DataFrame, target: Callable[[DataStreamWriter], DataStreamWriter]
    ) -> StreamingQuery:
        """Start ``df`` into the sink that ``target`` sets on the writer."""
        conf = dict(STATE_CONF)
        if self.state_partitions:
            conf["spark.sql.shuffle.partitions"] = str(self.state_partitions)
        with session_conf(df.sparkSession, conf):
            return target(self.writer(df)).start()


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for every query; when one fails, stop the others and raise."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
