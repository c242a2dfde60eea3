"""Dashboard filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_anomalies(df: DataFrame) -> DataFrame:
    return df.where("is_anomaly")


def filter_region(df: DataFrame, region: str | None) -> DataFrame:
    """One region, or all when none is selected."""
    return df if region is None else df.where(F.col("region") == region)


def instant(value: datetime | str) -> Column:
    """A timestamp literal; naive values are in the session time zone (UTC)."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp")


def latest_time(df: DataFrame) -> str | None:
    """Newest event time, as the "now" of data at rest; scans that column only."""
    return df.agg(F.max("timestamp").cast("string")).first()[0]


def time_range(df: DataFrame, end: datetime | str, minutes: float = 15) -> DataFrame:
    """Readings of the last ``minutes`` up to and including ``end``.

    Both limits are constants, so Spark pushes them into the file scan.
    """
    until = instant(end)
    since = until - F.make_dt_interval(secs=F.lit(minutes * 60.0))
    return df.where(F.col("timestamp").between(since, until))


def region_options(df: DataFrame, n: int = 10) -> DataFrame:
    """Values for the region selector: the first ``n`` regions by name."""
    return df.select("region").where("region IS NOT NULL").distinct().orderBy("region").limit(n)
