"""Keyed upsert sink: the last write of each key wins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.operators.documents import DOCUMENT_ID, latest_by_key
from wattspan.streaming.control import Run

BATCH = "batch_id"

# Bulk size and retries of the search-index connector.
INDEX_OPTIONS = {
    "es.mapping.id": DOCUMENT_ID,
    "es.batch.size.entries": "1000",
    "es.batch.size.bytes": "1mb",
    "es.batch.write.retry.count": "3",
    "es.batch.write.retry.wait": "10s",
}


@dataclass(frozen=True)
class UpsertSpec:
    """Target of an upsert.

    ``parquet`` writes each micro-batch to its own ``batch_id=`` folder of
    ``location``; a replayed batch overwrites the same folder. Any other
    ``kind`` is a connector format that itself overwrites by key.
    ``order_by`` decides among versions of a key within one micro-batch, and
    ``prepare`` shapes the rows after that decision.
    """

    location: str
    keys: Sequence[str] = (DOCUMENT_ID,)
    order_by: Sequence[str] = ("timestamp",)
    kind: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] | None = None


def index_spec(index: str, **changes) -> UpsertSpec:
    """An upsert into a search index through its Spark connector."""
    options = {"es.resource": index, **INDEX_OPTIONS, **changes.pop("options", {})}
    return UpsertSpec(
        location=index, kind="org.elasticsearch.spark.sql", options=options, **changes
    )


def write_batch(batch: DataFrame, batch_id: int, spec: UpsertSpec) -> None:
    """Upsert one batch, which is evaluated once; an empty one writes an empty folder."""
    rows = latest_by_key(batch, spec.keys, spec.order_by)
    if spec.prepare:
        rows = spec.prepare(rows)
    if spec.kind == "parquet":
        rows.write.mode("overwrite").parquet(f"{spec.location}/{BATCH}={batch_id}")
    else:
        rows.write.format(spec.kind).options(**spec.options).mode("append").save()


def write_upsert(df: DataFrame, spec: UpsertSpec, run: Run) -> StreamingQuery:
    """Upsert a stream, one micro-batch at a time."""
    return run.start(
        df, lambda w: w.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, spec))
    )


def _versions(
    spark: SparkSession, location: str, schema: StructType, base: str | None, after: int
) -> DataFrame:
    """All versions in batches later than ``after``, and the rows of ``base`` before them."""
    batched = StructType([*schema.fields]).add(BATCH, "long")
    rows = spark.read.schema(batched).parquet(location).where(F.col(BATCH) > after)
    if base is None:
        return rows
    compacted = spark.read.schema(schema).parquet(base)
    return rows.unionByName(compacted.withColumn(BATCH, F.lit(-1).cast("bigint")))


def read_upserts(
    spark: SparkSession,
    location: str,
    schema: StructType,
    keys: Sequence[str] = (DOCUMENT_ID,),
    base: str | None = None,
    after: int = -1,
) -> DataFrame:
    """The current row of every key.

    ``base`` is a folder made by :func:`compact_upserts` and ``after`` the
    batch it was made through; it then stands for the batches up to that one.
    """
    rows = _versions(spark, location, schema, base, after)
    return latest_by_key(rows, keys, [BATCH]).select(*schema.fieldNames())


def compact_upserts(
    spark: SparkSession,
    location: str,
    schema: StructType,
    target: str,
    through: int,
    keys: Sequence[str] = (DOCUMENT_ID,),
    base: str | None = None,
    after: int = -1,
) -> None:
    """Write the state after batch ``through`` to the new folder ``target``.

    It builds on an earlier ``base`` when there is one, so each run reads only
    the batches since. Nothing is deleted here.
    """
    rows = _versions(spark, location, schema, base, after).where(F.col(BATCH) <= through)
    current = latest_by_key(rows, keys, [BATCH]).select(*schema.fieldNames())
    current.write.mode("errorifexists").parquet(target)
