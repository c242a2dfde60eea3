"""Headline figures and rankings of the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspan.config import SOURCES
from wattspan.functions.bands import (
    ANOMALY_EDGES,
    COST_EDGES,
    RENEWABLE_EDGES,
    RESERVE_EDGES,
    band,
)
from wattspan.functions.metrics import source_value, total_of
from wattspan.operators.filters import filter_anomalies, filter_region


def _figure(df: DataFrame, name: str, value: Column, edges: Sequence[float]) -> DataFrame:
    return df.agg(value.alias(name)).withColumn("band", band(name, edges))


def kpi_anomaly_count(df: DataFrame) -> DataFrame:
    """Number of anomalies."""
    return _figure(filter_anomalies(df), "anomalies", F.count("*"), ANOMALY_EDGES)


def kpi_avg_cost(df: DataFrame) -> DataFrame:
    """Average generation cost per hour."""
    return _figure(df, "avg_cost", F.avg("generation_cost_per_hour"), COST_EDGES)


def kpi_renewable(df: DataFrame) -> DataFrame:
    """Average renewable percentage."""
    return _figure(df, "avg_renewable", F.avg("renewable_percentage"), RENEWABLE_EDGES)


def kpi_reserve_margin(df: DataFrame) -> DataFrame:
    """Average reserve margin."""
    return _figure(df, "avg_reserve_margin", F.avg("reserve_margin_percent"), RESERVE_EDGES)


def kpi_summary(df: DataFrame) -> DataFrame:
    """All four figures and their bands from one pass over the readings."""
    figures = {
        "anomalies": (F.count_if("is_anomaly"), ANOMALY_EDGES),
        "avg_cost": (F.avg("generation_cost_per_hour"), COST_EDGES),
        "avg_renewable": (F.avg("renewable_percentage"), RENEWABLE_EDGES),
        "avg_reserve_margin": (F.avg("reserve_margin_percent"), RESERVE_EDGES),
    }
    row = df.agg(*(value.alias(name) for name, (value, _) in figures.items()))
    return row.withColumns(
        {f"{name}_band": band(name, edges) for name, (_, edges) in figures.items()}
    )


def generation_by_source(df: DataFrame, region: str | None = None) -> DataFrame:
    """Total MW and share of each source, of one region or of all."""
    sums = filter_region(df, region).agg(
        *(F.sum(source_value("generation_mw", s)).alias(s) for s in SOURCES)
    )
    total = total_of(F.col(s) for s in SOURCES)
    long = sums.withColumn("total", total).unpivot("total", list(SOURCES), "source", "sum_mw")
    return long.select(
        "source",
        "sum_mw",
        F.when(F.col("total") > 0, F.col("sum_mw") / F.col("total") * 100.0).alias("share_percent"),
    )


def demand_by_region(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` regions with the highest average demand; ties go by name."""
    averages = df.groupBy("region").agg(F.avg("demand_mw").alias("avg_demand_mw"))
    return averages.orderBy(F.desc("avg_demand_mw"), "region").limit(n)
