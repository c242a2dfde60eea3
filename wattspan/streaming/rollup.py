"""Five-minute and hourly aggregates from one read of a stream, as mergeable partial aggregates.

A micro-batch is aggregated to five-minute partials, which are added to one table; the hourly
partials are made of them and added to a second. The tables are the state: a late row is merged
into its window, however old, and nothing is held in executors between batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattspan.schemas import struct_of
from wattspan.sinks.merge_table import MergeTable, add_batch, read_merged
from wattspan.streaming.control import Run

KEYS = ("window_start", "window_end", "region")
NARROW, WIDE = "5 minutes", "1 hour"

# Partial aggregates of a reading column: how they are made, and how two are added.
MADE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
ADDED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}

# What the published columns are made of.
FIVE_MINUTE_RESULTS = {
    "avg_demand_mw": "demand_mw_sum / demand_mw_count",
    "peak_demand_mw": "demand_mw_max",
    "min_demand_mw": "demand_mw_min",
    "avg_frequency_hz": "grid_frequency_hz_sum / grid_frequency_hz_count",
    "avg_carbon_intensity": "carbon_intensity_gco2_kwh_sum / carbon_intensity_gco2_kwh_count",
    "avg_renewable_percentage": "renewable_percentage_sum / renewable_percentage_count",
    "anomaly_count": "anomalies_sum",
    "record_count": "record_count",
}
HOURLY_RESULTS = {
    "hourly_avg_demand": "demand_mw_sum / demand_mw_count",
    "hourly_peak_demand": "demand_mw_max",
    "hourly_renewable_pct": "renewable_percentage_sum / renewable_percentage_count",
    "hourly_carbon_intensity": "carbon_intensity_gco2_kwh_sum / carbon_intensity_gco2_kwh_count",
    "total_generation_cost": "generation_cost_per_hour_sum",
}
# Which partials each reading column needs.
PARTIALS: dict[str, Sequence[str]] = {
    "demand_mw": ("sum", "count", "min", "max"),
    "grid_frequency_hz": ("sum", "count"),
    "carbon_intensity_gco2_kwh": ("sum", "count"),
    "renewable_percentage": ("sum", "count"),
    "generation_cost_per_hour": ("sum",),
    "anomalies": ("sum",),
}
RECORDS = "record_count"


def _partial_names() -> dict[str, str]:
    """Every partial with the function that adds two of it."""
    named = {f"{column}_{kind}": kind for column, kinds in PARTIALS.items() for kind in kinds}
    return {**named, RECORDS: "count"}


def partial_schema() -> StructType:
    whole = {name: "long" for name, kind in _partial_names().items() if kind == "count"}
    fields = {name: whole.get(name, "double") for name in _partial_names()}
    fields["anomalies_sum"] = "long"
    return struct_of({"window_start": "timestamp", "window_end": "timestamp", "region": "string", **fields})


def _windowed(time: str | Column, width: str) -> list[Column]:
    window = F.window(time, width)
    return [window.start.alias("window_start"), window.end.alias("window_end"), F.col("region")]


def partials(readings: DataFrame, width: str = NARROW) -> DataFrame:
    """Partial aggregates of readings per window and region; rows without a time have none."""
    timed = readings.where("timestamp IS NOT NULL").withColumn("anomalies", F.col("is_anomaly").cast("int"))
    made = [
        MADE[kind](column).alias(f"{column}_{kind}") for column, kinds in PARTIALS.items() for kind in kinds
    ]
    return timed.groupBy(*_windowed("timestamp", width)).agg(*made, F.count("*").alias(RECORDS))


def _added() -> list[Column]:
    return [ADDED[kind](name).alias(name) for name, kind in _partial_names().items()]


def merged(rows: DataFrame) -> DataFrame:
    """Partials of one window and region added up."""
    return rows.groupBy(*KEYS).agg(*_added())


def widened(rows: DataFrame, width: str = WIDE) -> DataFrame:
    """Partials of narrow windows added up to wider ones that they divide."""
    return rows.groupBy(*_windowed(F.col("window_start"), width)).agg(*_added())


def results(rows: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    return rows.select(*KEYS, *(F.expr(formula).alias(name) for name, formula in formulas.items()))


@dataclass(frozen=True)
class Rollup:
    """The two tables below ``location``."""

    location: str

    def table(self, name: str) -> MergeTable:
        return MergeTable(f"{self.location}/{name}", partial_schema(), KEYS, merged)

    @property
    def narrow(self) -> MergeTable:
        return self.table("windows_5min")

    @property
    def wide(self) -> MergeTable:
        return self.table("windows_hourly")

    def add(self, batch: DataFrame, batch_id: int, writer: str = "") -> None:
        """Add a batch of readings, which are read once, to both tables.

        Each table skips a batch that it has. After a stop between the two, the second is
        made of what the first has on file.
        """
        narrow = add_batch(partials(batch), batch_id, self.narrow, writer)
        add_batch(widened(narrow), batch_id, self.wide, writer)

    def five_minutes(self, spark: SparkSession) -> DataFrame:
        return results(read_merged(spark, self.narrow), FIVE_MINUTE_RESULTS)

    def hourly(self, spark: SparkSession) -> DataFrame:
        return results(read_merged(spark, self.wide), HOURLY_RESULTS)


def write_rollup(readings: DataFrame, location: str, run: Run) -> StreamingQuery:
    """Stream readings into both tables with one query."""
    rollup, writer = Rollup(location), run.checkpoint
    return run.start(
        readings, lambda w: w.foreachBatch(lambda batch, number: rollup.add(batch, number, writer))
    )
