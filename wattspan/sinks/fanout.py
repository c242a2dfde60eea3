"""One pass of a stream into several targets, committed together, and their compaction.

A column names the target of each row. A micro-batch is one write job into its own folder, so
the source is read and parsed once; then one commit shows all its targets to readers. Small
files of many batches are packed into a generation, which a commit puts in their place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.session import session_conf
from wattspan.sinks.commits import DATA, NO_BATCH, current, expire, is_new, publish, size_of
from wattspan.streaming.control import Run

TARGET = "target"
PART = "part"
BIN = "_bin"


@dataclass(frozen=True)
class FanOut:
    """A table of several targets.

    ``schema`` has the columns of all targets, without ``target``; those a target does not
    use are NULL and take no room. ``partition_by`` names columns that become folders below
    the target. Every ``pack_every`` batches are packed as the stream goes, into files of about
    ``target_bytes``; generations of like size are packed together, so that there are few and a
    row is rewritten about as often as the logarithm of the table's size. ``None`` packs none.
    """

    location: str
    schema: StructType
    partition_by: Sequence[str] = ()
    pack_every: int | None = 64
    ratio: int = 2
    target_bytes: int = 256 << 20
    order_by: Sequence[str] = field(default=("timestamp",))

    @property
    def folders(self) -> list[str]:
        return [TARGET, *self.partition_by]

    def path(self, part: str) -> str:
        return f"{self.location}/{DATA}/{PART}={part}"


def _save(rows: DataFrame, table: FanOut, part: str) -> None:
    rows.write.partitionBy(*table.folders).mode("overwrite").parquet(table.path(part))


def commit_batch(batch: DataFrame, batch_id: int, table: FanOut, writer: str = "") -> None:
    """Write one batch and commit it; one that is committed already is left alone."""
    spark = batch.sparkSession
    state = current(spark, table.location)
    if not is_new(state, batch_id, writer):
        return
    # AQE joins small folders and splits large ones.
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(table.target_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    with session_conf(spark, sizes):
        _save(batch.hint("rebalance", *table.folders), table, f"b{batch_id:012d}")
    parts = [*state.get("parts", []), f"b{batch_id:012d}"]
    state = publish(spark, table.location, {**state, "batch": batch_id, "writer": writer, "parts": parts})
    if table.pack_every and len(_batches(parts)) >= table.pack_every:
        pack(spark, table, whole=False)


def _batches(parts: Sequence[str]) -> list[str]:
    return [part for part in parts if part.startswith("b")]


def write_fan_out(df: DataFrame, table: FanOut, run: Run) -> StreamingQuery:
    """Stream rows with a ``target`` into ``table``, each exactly once."""
    writer = run.checkpoint
    return run.start(
        df, lambda w: w.foreachBatch(lambda batch, number: commit_batch(batch, number, table, writer))
    )


def _read(spark: SparkSession, table: FanOut, parts: Sequence[str], *extra: Column) -> DataFrame:
    names = [f.name for f in table.schema.fields if f.name not in table.partition_by]
    schema = StructType([table.schema[n] for n in names]).add(PART, "string").add(TARGET, "string")
    for name in table.partition_by:
        schema.add(table.schema[name])
    if not parts:
        return spark.createDataFrame([], schema).select(*table.schema.names, TARGET)
    reader = spark.read.schema(schema).option("basePath", f"{table.location}/{DATA}")
    return reader.parquet(*map(table.path, parts)).select(*table.schema.names, TARGET, *extra)


def read_target(spark: SparkSession, table: FanOut, target: str | None = None) -> DataFrame:
    """Committed rows of a target, or of all with their ``target``.

    The files are those of one commit: later batches and packing do not show in this frame.
    """
    rows = _read(spark, table, current(spark, table.location).get("parts", []))
    if target is None:
        return rows
    return rows.where(F.col(TARGET) == target).drop(TARGET)


def _bins(table: FanOut) -> Column:
    """Which of ``files`` of a folder a row goes to: by time within the hour, else by a hash."""
    files = F.col("files")
    spread = F.pmod(F.xxhash64(*(F.to_json(F.struct(n)) for n in table.schema.names)), files)
    if "timestamp" not in table.schema.names or "hour" not in table.partition_by:
        return spread
    micros = F.unix_micros("timestamp") - F.unix_micros(F.date_trunc("hour", "timestamp"))
    return F.coalesce(F.floor(micros * files / 3_600_000_000), spread)


def _due(spark: SparkSession, table: FanOut, parts: Sequence[str]) -> list[str]:
    """The batches not packed yet, and the generations before them that are not much larger."""
    first = len(parts) - len(_batches(parts))
    later = sum(size_of(spark, table.path(part)) for part in parts[first:])
    while first > 0:
        size = size_of(spark, table.path(parts[first - 1]))
        if size >= table.ratio * later:
            break
        first, later = first - 1, later + size
    return list(parts[first:])


def pack(spark: SparkSession, table: FanOut, whole: bool = True) -> None:
    """Pack committed parts into one generation and commit it in their place.

    A folder of ``b`` bytes in these parts gets at most ``ceil(b / target_bytes)`` files. All
    parts are packed, or without ``whole`` those that are due. Parts replaced by the generation
    before this one are removed; the ones replaced now stay for current readers.
    """
    state = current(spark, table.location)
    before = state.get("parts", [])
    parts = before if whole else _due(spark, table, before)
    if state["batch"] == NO_BATCH or len(parts) < 2:
        return
    file = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")
    folders = table.folders
    sizes = _read(spark, table, parts, *file).select(*folders, "_file", "_size").distinct()
    files = sizes.groupBy(*folders).agg(
        F.ceil(F.sum("_size") / table.target_bytes).cast("int").alias("files")
    )
    rows = _read(spark, table, parts).alias("rows")
    same = [F.col(f"rows.{name}").eqNullSafe(F.col(f"files.{name}")) for name in folders]
    sized = rows.join(files.alias("files"), same).select("rows.*", "files.files")
    binned = sized.withColumn(BIN, _bins(table)).drop("files")
    order = [name for name in table.order_by if name in table.schema.names]
    # All of a bin goes to one task, which writes one file for each of its folders.
    dealt = binned.repartition(*folders, BIN).sortWithinPartitions(*folders, BIN, *order).drop(BIN)
    generation = f"g{state['batch']:012d}-{state['commit']:012d}"
    _save(dealt, table, generation)
    after = [*before[: len(before) - len(parts)], generation]
    publish(spark, table.location, {**state, "parts": after})
    expire(spark, table.location, {f"{PART}={part}" for part in (*after, *parts)})
