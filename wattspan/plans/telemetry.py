"""Readings derived from an ``events`` table, for checks and benchmarks.

The formulas are those of FIXTURES.md: megawatts, frequency and voltage are
dyadic, so every engine computes them without rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.config import BASE_CAPACITY_MW, DEFAULT_CONFIG, REGIONS, SOURCES, EngineConfig
from wattspan.functions.metrics import (
    carbon_intensity,
    generation_cost,
    generation_mix,
    renewable_pct,
    reserve_margin,
    total_generation,
)
from wattspan.operators.alerts import classify_alert
from wattspan.operators.parse import expand_once, to_messages
from wattspan.schemas import READING_COLUMNS
from wattspan.session import prepare

# `ts` holds UTC wall time, which is what TIMESTAMP reads it as. With the
# schema given, planning opens no file and limits on `ts` reach the scan.
EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a batch."""
    return prepare(spark).read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def stream_events(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The ``events`` table as a stream, one file or a folder of files.

    The bracket makes the path a glob; a file source rejects the plain path
    of a single file.
    """
    reader = prepare(spark).readStream.schema(EVENTS_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/events[.]parquet")


def _by_region(values: Sequence[str]) -> str:
    cases = " ".join(f"WHEN {position} THEN {value}" for position, value in enumerate(values))
    return f"CASE pmod(user_id, {len(values)}) {cases} END"


REGION = _by_region([f"'{region}'" for region in REGIONS])
BASE = _by_region([f"{BASE_CAPACITY_MW[region]!r}D" for region in REGIONS])

# The raw measurements of a reading: every query needs some of them.
RAW = {
    "demand_mw": "dem0 * CASE WHEN event_id % 37 = 0 THEN 1.75D ELSE 1D END",
    "Solar": "Solar",
    "Wind": "Wind",
    "Natural_Gas": "rem * 0.75D + (event_id % 4) * (base / 32)",
    "Coal": "rem * 0.25D",
    "Nuclear": "Nuclear",
    "Hydro": "Hydro",
    "grid_frequency_hz": """CASE WHEN event_id % 20 = 0 THEN 60D + (k - 50) / 1024D
        ELSE 60D + (k % 10 - 5) / 1024D END""",
    "voltage_kv": "CASE WHEN event_id % 23 = 0 THEN 320D + k / 2D ELSE 340D + (k % 20) / 2D END",
    "temperature_celsius": "15D + (k % 41) / 2D",
}


def identities(events: DataFrame) -> DataFrame:
    """When and where of each reading; reads no measurement."""
    return events.selectExpr("event_id", "ts AS timestamp", f"{REGION} AS region")


def readings_from_events(
    events: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG, keep_id: bool = False
) -> DataFrame:
    """Typed readings, one per event; a pure projection for batch and streams."""
    rest = (
        events.selectExpr(
            "event_id",
            "ts AS timestamp",
            f"{REGION} AS region",
            f"{BASE} AS base",
            "cast(get_json_object(props, '$.k') AS INT) AS k",
            "hour(ts) AS hour_of_day",
        )
        .selectExpr(
            "*",
            "base * 0.5D + k * 16 + (event_id % 7) * 8 AS dem0",
            "CASE WHEN hour_of_day < 6 OR hour_of_day > 20 THEN 0D ELSE base / 16 END AS Solar",
            "base / 8 + k AS Wind",
            "base / 8 AS Nuclear",
            "base / 16 AS Hydro",
        )
        .selectExpr("*", "greatest(0D, dem0 - (Solar + Wind + Nuclear + Hydro)) AS rem")
    )
    fields = ", ".join(f"{value} AS {name}" for name, value in RAW.items())
    once = expand_once(
        rest, F.expr(f"struct({fields})"), "event_id", "timestamp", "region", "hour_of_day"
    )
    measured = once.selectExpr(
        "*",
        "upper(region) || '-GRID-' || (event_id % 5 + 1) AS grid_id",
        f"struct({', '.join(SOURCES)}) AS generation_mw",
    )
    total = F.col("total_generation_mw")
    derived = (
        measured.withColumn("total_generation_mw", total_generation("generation_mw", cfg))
        .withColumns(
            {
                "generation_mix_percent": generation_mix(
                    "generation_mw", cfg, digits=None, total=total
                ),
                "generation_cost_per_hour": generation_cost("generation_mw", cfg, digits=None),
                "renewable_percentage": renewable_pct(
                    "generation_mw", cfg, digits=None, total=total
                ),
                "reserve_margin_percent": reserve_margin(total, "demand_mw", digits=None),
            }
        )
        .withColumn(
            "carbon_intensity_gco2_kwh",
            carbon_intensity("generation_mix_percent", cfg, digits=None),
        )
    )
    kept = ["event_id"] if keep_id else []
    return classify_alert(derived, cfg).select(*kept, *READING_COLUMNS)


def readings(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    """Batch readings of one data folder."""
    return readings_from_events(read_events(spark, sf_dir), keep_id=keep_id)


def stream_readings(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same readings as a stream."""
    return readings_from_events(stream_events(spark, sf_dir, max_files_per_trigger))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as keyed JSON messages."""
    return to_messages(readings(spark, sf_dir))
