"""Batch read of the partitioned lake table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.operators.filters import instant
from wattspan.schemas import LAKE_SCHEMA, READING_COLUMNS
from wattspan.sinks.commits import is_committed_table
from wattspan.sinks.lake import read_lake_target

# year, month, day, hour as one sortable number: 2024011503
HOUR_NUMBER = "year * 1000000 + month * 10000 + day * 100 + hour"


def _utc(value: datetime | str) -> datetime:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def _limit(moment: datetime, since: bool) -> Column:
    """Limits on the hour partitions and, more coarsely, on the year alone."""
    number = int(moment.strftime("%Y%m%d%H"))
    hours, year = F.expr(HOUR_NUMBER), F.col("year")
    if since:
        return (hours >= number) & (year >= moment.year)
    return (hours <= number) & (year <= moment.year)


def read_lake(
    spark: SparkSession,
    path: str,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Readings with ``since <= timestamp < until`` of the given regions.

    Limits are UTC. Each is applied to ``timestamp``, for row-group skipping,
    and to the calendar partitions, which Spark cannot derive by itself. The
    schema is given, so no file is opened for planning. A lake written in one pass with its
    rejects is read through its newest commit.
    """
    if is_committed_table(spark, path):
        table = read_lake_target(spark, path)
    else:
        table = spark.read.schema(LAKE_SCHEMA).parquet(path)
    if since is not None:
        since = _utc(since)
        table = table.where(_limit(since, True) & (F.col("timestamp") >= instant(since)))
    if until is not None:
        until = _utc(until)
        table = table.where(_limit(until, False) & (F.col("timestamp") < instant(until)))
    if regions is not None:
        table = table.where(F.col("region").isin(list(regions)))
    return table.select(*READING_COLUMNS)
