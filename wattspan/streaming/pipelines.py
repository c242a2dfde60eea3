"""The standing jobs: processor, document indexer, lake writer, alerts, spikes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.operators.alerts import ALERT_FIELDS, critical_alerts
from wattspan.operators.documents import (
    DOCUMENT_ID,
    document_id,
    epoch_ms,
    flatten_readings,
    latest_by_key,
    with_epoch_ms,
)
from wattspan.operators.parse import parse_readings, with_processed_at
from wattspan.operators.quality import split_for_lake, tag_for_lake
from wattspan.operators.windows import (
    WINDOW_FIELDS,
    flat_window,
    hourly_trend,
    regional_window,
)
from wattspan.schemas import MESSAGE_SCHEMA, READING_SCHEMA
from wattspan.sinks.fanout import TARGET, FanOut, commit_batch, read_target
from wattspan.sinks.lake import lake_table, write_lake, write_lake_and_rejects
from wattspan.sinks.merge_table import MergeTable, add_batch, latest_table, read_merged
from wattspan.sinks.messages import SinkSpec, write_console, write_messages
from wattspan.sinks.upsert import UpsertSpec, read_upserts, write_batch, write_upsert
from wattspan.sinks.versions import read_version, write_versions
from wattspan.sources.messages import SourceSpec, read_stream
from wattspan.streaming.control import Run
from wattspan.streaming.live_spikes import write_live_spikes
from wattspan.streaming.rollup import write_rollup

WINDOW_KEYS = ("window_start", "region")

# Windowed state is a few rows per region, so a few state stores are enough.
WINDOW_STATE_PARTITIONS = 8

# States of hours are 16 per region and hour, each with its readings.
SPIKE_STATE_PARTITIONS = 32
SPIKE_FIELDS = ("timestamp", "region", "grid_id", "demand_mw")

REJECTED = "rejected"


@dataclass(frozen=True)
class Jobs:
    """Shared settings of the standing jobs."""

    spark: SparkSession
    source: SourceSpec
    checkpoints: str
    interval: str | None = None
    cfg: EngineConfig = DEFAULT_CONFIG

    def run(self, name: str, mode: str = "append", state_partitions: int | None = None) -> Run:
        return Run(name, self.checkpoints, mode, self.interval, state_partitions)

    def messages(self) -> DataFrame:
        return read_stream(self.spark, self.source)

    def readings(self, fields: Sequence[str] | None = None) -> DataFrame:
        return parse_readings(self.messages(), fields=fields)

    def republish(self, sink: SinkSpec, name: str = "processed") -> StreamingQuery:
        """Typed readings with their processing time, as messages again."""
        return write_messages(with_processed_at(self.readings()), sink, self.run(name))

    def windows(
        self, location: str | None = None, mode: str = "append"
    ) -> list[StreamingQuery]:
        """Five-minute and hourly aggregates, to tables or to the console.

        ``append`` writes a window once, when the watermark has passed it, and
        keeps only open windows as state. ``complete`` never drops a late row,
        but its state grows for as long as the query runs.
        """
        aggregates = {
            "windows_5min": regional_window(self.readings(WINDOW_FIELDS)),
            "windows_hourly": hourly_trend(self.readings(WINDOW_FIELDS)),
        }
        started = []
        for name, aggregate in aggregates.items():
            run = self.run(name, mode, WINDOW_STATE_PARTITIONS)
            if location is None:
                started.append(write_console(aggregate, run))
            else:
                started.append(write_windows(aggregate, f"{location}/{name}", run))
        return started

    def rollup(self, location: str) -> StreamingQuery:
        """Both aggregates by one query and one read of the topic; late rows are merged in."""
        return write_rollup(self.readings(WINDOW_FIELDS), location, self.run("windows"))

    def spikes(self, location: str) -> StreamingQuery:
        """Demand spikes of every hour once it is over, and late readings."""
        run = self.run("spikes", state_partitions=SPIKE_STATE_PARTITIONS)
        return write_live_spikes(self.readings(SPIKE_FIELDS), location, run, cfg=self.cfg)

    def index_all(self, spec: UpsertSpec, rejects: str) -> StreamingQuery:
        """Flat documents by id and messages without one, by one query.

        Both targets take a batch once, whatever is repeated after a stop. With ``parquet`` the
        index is the table of :func:`document_table`, rejects that of :func:`reject_table`.
        """
        return write_index(self.messages(), spec, rejects, self.run("documents"))

    def index(self, spec: UpsertSpec, name: str = "documents") -> StreamingQuery:
        """Flat documents, upserted by id."""
        return write_documents(self.messages(), spec, self.run(name))

    def index_rejects(self, path: str) -> StreamingQuery:
        """Messages whose readings have no id, as they came, to a folder."""
        messages = self.messages()
        identity = document_id("region", "grid_id", epoch_ms("timestamp"))
        bad = parse_readings(messages, messages.columns).where(identity.isNull())
        return self.run("index-rejects").start(
            bad.select(messages.columns), lambda w: w.format("parquet").option("path", path)
        )

    def lake(self, path: str, rejects: str | None = None) -> list[StreamingQuery]:
        """Readings to the lake, messages that cannot be filed there to the rejects.

        Every message goes to one of them. Readings with a soft fault, such as an unknown
        region, are in the lake. By default one query writes both below ``path``; read them
        with ``read_lake`` and ``read_rejects``. With a folder for ``rejects`` each is a query
        of its own, into plain folders of Spark's file sink.
        """
        if rejects is None:
            tagged, table = tag_for_lake(self.messages(), self.cfg), lake_table(path)
            return [write_lake_and_rejects(tagged, table, self.run("lake"))]
        good, bad = split_for_lake(self.messages(), self.cfg)
        return [
            write_lake(good, path, self.run("lake")),
            self.run("rejects").start(bad, lambda w: w.format("parquet").option("path", rejects)),
        ]

    def alerts(self, path: str) -> StreamingQuery:
        """Critical alerts as they arrive, one JSON line each."""
        return self.run("alerts").start(
            critical_alerts(self.readings(ALERT_FIELDS)), lambda w: w.format("json").option("path", path)
        )


def beside(path: str) -> str:
    """The folder for what is not written to ``path``."""
    return f"{path.rstrip('/')}_rejects"


def write_windows(
    aggregate: DataFrame, location: str, run: Run, keys: Sequence[str] = WINDOW_KEYS
) -> StreamingQuery:
    """Windowed aggregates as a table.

    Appended windows are final and go to the native file sink. Complete results replace
    the table; updated windows are upserted by window and key. Read them with
    :func:`read_windows`.
    """
    rows = flat_window(aggregate)
    if run.mode == "append":
        return run.start(rows, lambda w: w.format("parquet").option("path", location))
    if run.mode == "complete":
        return write_versions(rows, location, run)
    return write_upsert(rows, UpsertSpec(location, keys, ("window_end",)), run)


def read_windows(
    spark: SparkSession, location: str, schema: StructType, mode: str, keys: Sequence[str] = WINDOW_KEYS
) -> DataFrame:
    """The table that :func:`write_windows` wrote in the given mode."""
    if mode == "append":
        return spark.read.schema(schema).parquet(location)
    if mode == "complete":
        return read_version(spark, location, schema)
    return read_upserts(spark, location, schema, keys)


def keyed_readings(messages: DataFrame) -> DataFrame:
    """Readings with their document id, and the Kafka offset where there is one."""
    kept = [c for c in ("offset",) if c in messages.columns]
    identity = document_id("region", "grid_id", epoch_ms("timestamp"))
    readings = parse_readings(messages, kept).withColumn(DOCUMENT_ID, identity)
    return readings.where(F.col(DOCUMENT_ID).isNotNull())


def write_documents(messages: DataFrame, spec: UpsertSpec, run: Run) -> StreamingQuery:
    """Upsert messages as flat documents.

    Two versions of an id in one micro-batch are decided by Kafka offset, which
    is the order of arrival since equal ids share a key, else by event time.
    Readings without an id are rejects.
    """
    readings = keyed_readings(messages)
    order = ["offset"] if "offset" in readings.columns else ["timestamp"]

    def shape(rows: DataFrame) -> DataFrame:
        return flatten_readings(with_epoch_ms(rows.drop("offset")))

    shaped = UpsertSpec(spec.location, spec.keys, order, spec.kind, spec.options, shape)
    return write_upsert(readings, shaped, run)


def document_table(spark: SparkSession, location: str) -> MergeTable:
    """The index as a keyed table of flat documents."""
    empty = spark.createDataFrame([], READING_SCHEMA).withColumn(DOCUMENT_ID, F.lit("").cast("string"))
    schema = flatten_readings(with_epoch_ms(empty)).schema
    return latest_table(location, StructType([_nullable(f) for f in schema.fields]))


def _nullable(column: StructField) -> StructField:
    return StructField(column.name, column.dataType, True)


def reject_table(location: str) -> FanOut:
    """Messages without an id, as they came."""
    return FanOut(location, MESSAGE_SCHEMA)


def read_documents(spark: SparkSession, location: str) -> DataFrame:
    return read_merged(spark, document_table(spark, location))


def read_index_rejects(spark: SparkSession, location: str) -> DataFrame:
    return read_target(spark, reject_table(location), REJECTED)


def write_index(messages: DataFrame, spec: UpsertSpec, rejects: str, run: Run) -> StreamingQuery:
    """Upsert messages as flat documents, and keep those without an id, in one pass.

    Of two versions of an id in one batch the later offset wins, or without one the later event
    time, as in :func:`write_documents`.
    """
    spark, writer = messages.sparkSession, run.checkpoint
    offsets = [c for c in ("offset",) if c in messages.columns]
    sent = [name for name in MESSAGE_SCHEMA.names if name in messages.columns]
    identity = document_id("region", "grid_id", epoch_ms("timestamp"))
    decoded = parse_readings(messages, [*(F.col(c).alias(f"_{c}") for c in sent), *offsets])
    decoded = decoded.withColumn(DOCUMENT_ID, identity)
    order = offsets or ["timestamp"]

    def shape(rows: DataFrame) -> DataFrame:
        return flatten_readings(with_epoch_ms(rows.drop(*offsets, *(f"_{c}" for c in sent))))

    shaped = UpsertSpec(spec.location, spec.keys, order, spec.kind, spec.options, shape)

    def commit(batch: DataFrame, batch_id: int) -> None:
        # Decoded once for both targets. Each skips a batch that it has already.
        kept = batch.persist()
        try:
            bad = kept.where(F.col(DOCUMENT_ID).isNull()).select(
                F.lit(REJECTED).alias(TARGET),
                *(F.col(f"_{c}").cast("string").alias(c) for c in sent),
            )
            commit_batch(bad, batch_id, reject_table(rejects), writer)
            good = kept.where(F.col(DOCUMENT_ID).isNotNull())
            if spec.kind == "parquet":
                rows = shape(latest_by_key(good, spec.keys, order))
                add_batch(rows, batch_id, document_table(spark, spec.location), writer)
            else:
                write_batch(good, batch_id, shaped)
        finally:
            kept.unpersist()

    return run.start(decoded, lambda w: w.foreachBatch(commit))
