"""Alert classification and extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.functions.alerts import CRITICAL, NORMAL, alert_level

# What alert extraction reads of a classified reading.
ALERT_FIELDS = (
    "timestamp",
    "region",
    "grid_frequency_hz",
    "voltage_kv",
    "reserve_margin_percent",
    "alert_level",
)


def classify_alert(
    df: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG, variant: str = "processor"
) -> DataFrame:
    """Set ``alert_level`` and ``is_anomaly`` from frequency, margin and voltage."""
    level = alert_level(
        "grid_frequency_hz", "reserve_margin_percent", "voltage_kv", cfg, variant
    )
    return df.withColumn("alert_level", level).withColumn(
        "is_anomaly", F.col("alert_level") != NORMAL
    )


def critical_alerts(df: DataFrame) -> DataFrame:
    """Critical readings in the shape of an alert; stateless, batch or stream."""
    return df.where(F.col("alert_level") == CRITICAL).select(
        "region",
        "timestamp",
        F.col("grid_frequency_hz").alias("frequency"),
        F.col("reserve_margin_percent").alias("reserve_margin"),
        F.col("voltage_kv").alias("voltage"),
    )


def critical_alert_count(df: DataFrame) -> DataFrame:
    """Number of critical readings, for the alert summary line."""
    return df.where(F.col("alert_level") == CRITICAL).agg(F.count("*").alias("critical_alerts"))


def first_alerts(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` earliest critical alerts, in a repeatable order."""
    ordered = critical_alerts(df).orderBy(
        "timestamp", "region", "frequency", "reserve_margin", "voltage"
    )
    return ordered.limit(n)
