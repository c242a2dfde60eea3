"""Event-time aggregates. Every function works on batch and on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig

# Names of the aggregate columns.
FIVE_MINUTE_METRICS = {
    "avg_demand_mw": "avg(demand_mw)",
    "peak_demand_mw": "max(demand_mw)",
    "min_demand_mw": "min(demand_mw)",
    "avg_frequency_hz": "avg(grid_frequency_hz)",
    "avg_carbon_intensity": "avg(carbon_intensity_gco2_kwh)",
    "avg_renewable_percentage": "avg(renewable_percentage)",
    "anomaly_count": "sum(cast(is_anomaly AS INT))",
    "record_count": "count(*)",
}
HOURLY_METRICS = {
    "hourly_avg_demand": "avg(demand_mw)",
    "hourly_peak_demand": "max(demand_mw)",
    "hourly_renewable_pct": "avg(renewable_percentage)",
    "hourly_carbon_intensity": "avg(carbon_intensity_gco2_kwh)",
    "total_generation_cost": "sum(generation_cost_per_hour)",
}
# What the two regional aggregates read of a reading.
WINDOW_FIELDS = (
    "timestamp",
    "region",
    "demand_mw",
    "grid_frequency_hz",
    "carbon_intensity_gco2_kwh",
    "renewable_percentage",
    "generation_cost_per_hour",
    "is_anomaly",
)


def metric_columns(metrics: Mapping[str, str]) -> list[Column]:
    return [F.expr(formula).alias(name) for name, formula in metrics.items()]


def tumbling(
    df: DataFrame,
    width: str,
    metrics: Mapping[str, str],
    keys: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Metrics per tumbling window and key.

    Only decomposable aggregates are used, so each task ships one row per
    window and key whatever the share of a hot key is.
    """
    if watermark and df.isStreaming:
        df = df.withWatermark("timestamp", watermark)
    return df.groupBy(F.window("timestamp", width), *keys).agg(*metric_columns(metrics))


def regional_window(
    df: DataFrame, width: str = "5 minutes", watermark: str | None = "10 minutes"
) -> DataFrame:
    """Demand, frequency, carbon, renewables and anomalies per region and window."""
    return tumbling(df, width, FIVE_MINUTE_METRICS, ["region"], watermark)


def hourly_trend(df: DataFrame, watermark: str | None = "1 hour") -> DataFrame:
    """Demand, renewables, carbon and cost per region and hour."""
    return tumbling(df, "1 hour", HOURLY_METRICS, ["region"], watermark)


def flat_window(df: DataFrame) -> DataFrame:
    """``window_start`` and ``window_end`` in place of the window struct."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def demand_vs_generation(
    df: DataFrame, width: str = "1 hour", watermark: str | None = None
) -> DataFrame:
    """Average demand and generation over time; windows without rows are absent."""
    metrics = {"demand": "avg(demand_mw)", "generation": "avg(total_generation_mw)"}
    return tumbling(df, width, metrics, watermark=watermark)


def frequency_trend(
    df: DataFrame,
    width: str = "1 hour",
    cfg: EngineConfig = DEFAULT_CONFIG,
    watermark: str | None = None,
) -> DataFrame:
    """Average frequency over time against the nominal line."""
    trend = tumbling(df, width, {"frequency_hz": "avg(grid_frequency_hz)"}, watermark=watermark)
    nominal = F.lit(cfg.nominal_frequency_hz)
    return trend.withColumns(
        {"nominal_hz": nominal, "deviation_hz": F.col("frequency_hz") - nominal}
    )


def carbon_heatmap(
    df: DataFrame,
    width: str = "1 hour",
    regions: Sequence[str] | None = None,
    n: int = 10,
    wide: bool = False,
) -> DataFrame:
    """Average carbon intensity per region and window.

    With ``regions`` the cells are those of all these regions, otherwise the first ``n``
    in name order are looked up. The lookup is at most ``n`` rows, so it is
    broadcast to the aggregated cells. The wide form has one column per region
    and needs ``regions``, so no extra pass is made to find the columns.
    """
    metrics = {"carbon_intensity": "avg(carbon_intensity_gco2_kwh)"}
    if regions is not None:
        chosen = sorted(regions)
        df = df.where(F.col("region").isin(chosen))
        if wide:
            # One aggregation, where pivot() would make two.
            carbon = F.col("carbon_intensity_gco2_kwh")
            cells = (F.avg(F.when(F.col("region") == r, carbon)).alias(r) for r in chosen)
            return df.groupBy(F.window("timestamp", width)).agg(*cells)
        return tumbling(df, width, metrics, ["region"])
    if wide:
        raise ValueError("the wide form needs the list of regions")
    first = df.select("region").where("region IS NOT NULL").distinct().orderBy("region").limit(n)
    return tumbling(df, width, metrics, ["region"]).join(F.broadcast(first), "region", "left_semi")


def hourly_baseline(df: DataFrame) -> DataFrame:
    """Average demand per region and clock hour."""
    return df.groupBy("region", F.date_trunc("hour", "timestamp").alias("hour_start")).agg(
        F.avg("demand_mw").alias("hourly_avg_demand_mw")
    )
