"""Keyed-message source: a Kafka topic, or files of keyed messages."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from wattspan.schemas import MESSAGE_SCHEMA


@dataclass(frozen=True)
class SourceSpec:
    """Where messages come from.

    ``location`` is a topic for Kafka and a folder otherwise. The rate cap
    ``max_per_trigger`` counts offsets for Kafka and files otherwise; it paces
    the stream and loses nothing. ``min_partitions`` lets Spark cut large
    offset ranges, so a topic partition with a hot key is read by several
    tasks.
    """

    location: str
    kind: str = "kafka"
    servers: str | None = None
    start: str = "latest"
    max_per_trigger: int | None = None
    min_partitions: int | None = None
    session_timeout_ms: int = 30_000
    heartbeat_ms: int = 10_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind == "kafka" and not self.servers:
            raise ValueError("a Kafka source needs its bootstrap servers")

    def from_earliest(self) -> SourceSpec:
        """The same source read from its first message."""
        return replace(self, start="earliest")

    def options(self, streaming: bool = True) -> dict[str, str]:
        """Reader options; batch reads always cover the whole topic."""
        values: dict[str, object] = {}
        if self.kind == "kafka":
            values = {
                "kafka.bootstrap.servers": self.servers,
                "subscribe": self.location,
                "startingOffsets": self.start if streaming else "earliest",
                "kafka.session.timeout.ms": self.session_timeout_ms,
                "kafka.heartbeat.interval.ms": self.heartbeat_ms,
                "minPartitions": self.min_partitions,
            }
        if streaming:
            cap = "maxOffsetsPerTrigger" if self.kind == "kafka" else "maxFilesPerTrigger"
            values[cap] = self.max_per_trigger
        values.update(self.extra)
        return {key: str(value) for key, value in values.items() if value is not None}


def _load(reader, spec: SourceSpec, streaming: bool) -> DataFrame:
    reader = reader.format(spec.kind).options(**spec.options(streaming))
    if spec.kind == "kafka":
        return reader.load()
    return reader.schema(MESSAGE_SCHEMA).load(spec.location)


def read_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Messages as a stream with at least the columns ``key`` and ``value``."""
    return _load(spark.readStream, spec, streaming=True)


def read_messages(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The messages present now, as a batch."""
    return _load(spark.read, spec, streaming=False)
