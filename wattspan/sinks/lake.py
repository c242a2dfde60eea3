"""Partitioned Parquet lake sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.operators.quality import LAKE, REASON, REJECTS
from wattspan.schemas import PARTITION_COLUMNS, PARTITION_FIELDS, READING_SCHEMA, struct_of
from wattspan.session import session_conf
from wattspan.sinks.fanout import FanOut, read_target, write_fan_out
from wattspan.streaming.control import Run


def with_partition_columns(df: DataFrame) -> DataFrame:
    """Calendar columns of the event time, in the session time zone (UTC)."""
    return df.withColumns(
        {
            "year": F.year("timestamp"),
            "month": F.month("timestamp"),
            "day": F.dayofmonth("timestamp"),
            "hour": F.hour("timestamp"),
        }
    )


def write_lake(
    df: DataFrame,
    path: str,
    run: Run | None = None,
    mode: str = "append",
    partitions: int | None = None,
    target_size: str = "256MB",
) -> StreamingQuery | None:
    """Append readings below ``path`` by year, month, day, hour and region.

    Rows are rebalanced by their partition columns: AQE joins small hours and
    splits a hot one, towards ``target_size`` of shuffle data per task. Give
    ``partitions`` (by default the session's shuffle partitions) as at least
    the number of folders written, so that a split task writes few of them.

    A stream needs ``run``; its native sink commits every file exactly once,
    also after a restart. AQE rebalances stateless streams only. Rows without
    an event time belong in the rejects and are not written.

    Do not append batches to a folder that a stream writes: readers of such a
    folder follow the stream's commit log.
    """
    initial = [] if partitions is None else [partitions]
    placed = with_partition_columns(df.where("timestamp IS NOT NULL"))
    balanced = placed.hint("rebalance", *initial, *PARTITION_COLUMNS)
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_size,
        # Many small folders cost time by their number, not by their bytes.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    with session_conf(df.sparkSession, sizes):
        if df.isStreaming:
            if run is None:
                raise ValueError("a streaming write needs a Run")
            return run.start(
                balanced,
                lambda w: w.format("parquet")
                .option("path", path)
                .partitionBy(*PARTITION_COLUMNS),
            )
        # Sorted by time, so row groups of an hour can be skipped.
        ordered = balanced.sortWithinPartitions(*PARTITION_COLUMNS, "timestamp")
        ordered.write.partitionBy(*PARTITION_COLUMNS).mode(mode).parquet(path)
    return None


def lake_table(path: str, pack_every: int | None = 64, target_bytes: int = 256 << 20) -> FanOut:
    """A lake and its rejects as one table of two targets."""
    calendar = {name: kind for name, kind in PARTITION_FIELDS.items() if name != "region"}
    extra = struct_of({**calendar, "value": "string", REASON: "string"})
    schema = StructType([*READING_SCHEMA.fields, *extra.fields])
    return FanOut(path, schema, PARTITION_COLUMNS, pack_every=pack_every, target_bytes=target_bytes)


def write_lake_and_rejects(tagged: DataFrame, table: FanOut, run: Run) -> StreamingQuery:
    """Stream messages tagged by :func:`~wattspan.operators.quality.tag_for_lake`, in one pass."""
    return write_fan_out(with_partition_columns(tagged), table, run)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Messages that a one-pass lake could not file, with their fault."""
    return read_target(spark, lake_table(path), REJECTS).select("value", REASON)


def read_lake_target(spark: SparkSession, path: str) -> DataFrame:
    """Readings of a one-pass lake with their partition columns."""
    return read_target(spark, lake_table(path), LAKE).drop("value", REASON)
