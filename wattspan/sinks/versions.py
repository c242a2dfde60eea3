"""A table that every batch replaces as a whole: the sink of complete mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.sinks.commits import DATA, current, expire, is_new, publish
from wattspan.streaming.control import Run

VERSION = "version"


def _folder(batch_id: int) -> str:
    return f"{VERSION}={batch_id:012d}"


def replace_table(rows: DataFrame, batch_id: int, location: str, writer: str = "") -> None:
    """Write a whole version and commit it. The version before stays, older ones go."""
    spark = rows.sparkSession
    state = current(spark, location)
    if not is_new(state, batch_id, writer):
        return
    rows.write.mode("overwrite").parquet(f"{location}/{DATA}/{_folder(batch_id)}")
    publish(spark, location, {"batch": batch_id, "writer": writer})
    expire(spark, location, {_folder(batch_id), _folder(state["batch"])})


def write_versions(df: DataFrame, location: str, run: Run) -> StreamingQuery:
    """Stream a complete result into a replaced table."""
    writer = run.checkpoint
    return run.start(
        df, lambda w: w.foreachBatch(lambda rows, number: replace_table(rows, number, location, writer))
    )


def read_version(spark: SparkSession, location: str, schema: StructType) -> DataFrame:
    """The newest whole version; no rows before the first."""
    state = current(spark, location)
    if state["batch"] < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{location}/{DATA}/{_folder(state['batch'])}")
