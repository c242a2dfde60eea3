"""Demand spikes: readings far above the hourly average of their region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.operators.windows import hourly_baseline
from wattspan.session import work_path

BASELINE_KEYS = ["region", "hour_start"]


def stage_baseline(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the hourly baseline as a table and read it back.

    It is computed once, survives lost executors, and has a known size.
    """
    spark = df.sparkSession
    path = path or work_path(spark, "baseline")
    baseline = hourly_baseline(df)
    baseline.write.mode("overwrite").parquet(path)
    return spark.read.schema(baseline.schema).parquet(path)


def join_baseline(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Add ``hourly_avg_demand_mw`` to every reading that has a baseline.

    A plain join: Spark broadcasts the baseline while its known size allows, and else
    AQE splits the task of a hot region and hour.
    """
    readings = df.withColumn("hour_start", F.date_trunc("hour", "timestamp"))
    return readings.join(baseline, BASELINE_KEYS).drop("hour_start")


def demand_spikes(
    df: DataFrame,
    multiplier: float | None = None,
    baseline: DataFrame | None = None,
    cfg: EngineConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Readings whose demand exceeds ``multiplier`` times their hourly baseline.

    In batch the baseline defaults to the average of ``df`` itself over the
    same region and clock hour, the reading included, within one lazy plan
    that scans the readings twice. A stream needs a ``baseline`` table,
    as made by :func:`stage_baseline` or
    :func:`~wattspan.operators.windows.hourly_baseline`.
    """
    if baseline is None:
        if df.isStreaming:
            raise ValueError("demand_spikes on a stream needs a baseline table")
        baseline = hourly_baseline(df)
    limit = cfg.demand_spike_multiplier if multiplier is None else multiplier
    joined = join_baseline(df, baseline)
    return joined.where(F.col("demand_mw") > limit * F.col("hourly_avg_demand_mw"))
