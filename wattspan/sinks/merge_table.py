"""A keyed table as a few sorted-by-age runs: a large base and ever smaller deltas.

Each micro-batch adds a run. As soon as a run is less than ``ratio`` times the size of all later
ones, they are merged into one, so sizes fall at least by that ratio from run to run and a read
opens a number of runs that grows with the logarithm of the table. A row is rewritten about as
often. A commit names the runs of the table.

How rows of one key are merged is given: the last write wins (:func:`latest_table`), or partial
aggregates are added up (:class:`~wattspan.streaming.rollup.Rollup`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.operators.documents import DOCUMENT_ID, latest_by_key
from wattspan.sinks.commits import DATA, current, expire, is_new, publish, size_of
from wattspan.streaming.control import Run

RUN_NAME = "run"
BUCKET = "bucket"


@dataclass(frozen=True)
class MergeTable:
    """A keyed table below ``location``.

    ``merge`` takes rows with the column ``run``, greater for later runs, and returns one row
    per key. Rows lie in ``buckets`` folders by a hash of their key, so that a read of some
    keys opens few files.
    """

    location: str
    schema: StructType
    keys: Sequence[str]
    merge: Callable[[DataFrame], DataFrame]
    ratio: int = 2
    buckets: int = 8

    def path(self, run: str) -> str:
        return f"{self.location}/{DATA}/{RUN_NAME}={run}"

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))


def latest_table(
    location: str, schema: StructType, keys: Sequence[str] = (DOCUMENT_ID,), **options
) -> MergeTable:
    """A table in which the last write of each key wins."""
    return MergeTable(location, schema, keys, lambda rows: latest_by_key(rows, keys, [RUN_NAME]), **options)


def _run_name(first: int, last: int) -> str:
    """Runs cover disjoint ranges of batches, so names order them by age."""
    return f"{last:012d}-{first:012d}"


def _read(spark: SparkSession, table: MergeTable, runs: Sequence[str]) -> DataFrame:
    schema = StructType([*table.schema.fields]).add(RUN_NAME, "string").add(BUCKET, "integer")
    if not runs:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{table.location}/{DATA}")
    return reader.parquet(*map(table.path, runs))


def _save(rows: DataFrame, table: MergeTable, run: str) -> int:
    placed = table.with_bucket(rows.select(*table.schema.names))
    placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(table.path(run))
    return max(1, size_of(rows.sparkSession, table.path(run)))


def add_batch(rows: DataFrame, batch_id: int, table: MergeTable, writer: str = "") -> DataFrame:
    """Add the rows of a batch, one per key, merge runs that are due, and commit.

    Returns the batch as written. A batch that is committed already is not written again.
    """
    spark = rows.sparkSession
    state = current(spark, table.location)
    delta = _run_name(batch_id, batch_id)
    if is_new(state, batch_id, writer):
        runs = [*state.get("runs", []), {"name": delta, "first": batch_id, "bytes": _save(rows, table, delta)}]
        due, later = len(runs) - 1, runs[-1]["bytes"]
        while due > 0 and runs[due - 1]["bytes"] < table.ratio * later:
            due -= 1
            later += runs[due]["bytes"]
        if due < len(runs) - 1:
            merged = _run_name(runs[due]["first"], batch_id)
            old = _read(spark, table, [run["name"] for run in runs[due:]])
            size = _save(table.merge(old.drop(BUCKET)), table, merged)
            runs[due:] = [{"name": merged, "first": runs[due]["first"], "bytes": size}]
        publish(spark, table.location, {**state, "batch": batch_id, "writer": writer, "runs": runs})
        # What the commit before named stays for current readers, this batch for its writer.
        named = {delta, *(run["name"] for run in (*runs, *state.get("runs", [])))}
        expire(spark, table.location, {f"{RUN_NAME}={name}" for name in named})
    return _read(spark, table, [delta]).select(*table.schema.names)


def runs_of(spark: SparkSession, table: MergeTable) -> list[str]:
    """Names of the runs that a read opens, the oldest first."""
    return [run["name"] for run in current(spark, table.location).get("runs", [])]


def read_merged(spark: SparkSession, table: MergeTable, where_key: dict[str, object] | None = None) -> DataFrame:
    """The current row of every key, or of the key with the values ``where_key``."""
    rows = _read(spark, table, runs_of(spark, table))
    if where_key is not None:
        own = [F.lit(where_key[key]).cast(table.schema[key].dataType) for key in table.keys]
        number = F.pmod(F.xxhash64(*own), F.lit(table.buckets)).cast("int")
        rows = rows.where(F.col(BUCKET) == number)
        for key, value in zip(table.keys, own):
            rows = rows.where(F.col(key) == value)
    return table.merge(rows.drop(BUCKET)).select(*table.schema.names)


def write_merged(
    df: DataFrame, table: MergeTable, run: Run, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Stream rows into ``table``; ``prepare`` makes one row per key of a batch."""
    writer = run.checkpoint

    def add(batch: DataFrame, batch_id: int) -> None:
        add_batch(prepare(batch) if prepare else batch, batch_id, table, writer)

    return run.start(df, lambda w: w.foreachBatch(add))
