"""Wire and table schemas. Every field is nullable."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import DataType, StructType

from wattspan.config import SOURCES


def struct_of(fields: Mapping[str, str | DataType]) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


SOURCE_STRUCT = struct_of({source: "double" for source in SOURCES})

# Field names and order of a reading on the wire.
WIRE_FIELDS: dict[str, str | DataType] = {
    "timestamp": "string",
    "region": "string",
    "grid_id": "string",
    "demand_mw": "double",
    "total_generation_mw": "double",
    "generation_mix_percent": SOURCE_STRUCT,
    "generation_mw": SOURCE_STRUCT,
    "grid_frequency_hz": "double",
    "voltage_kv": "double",
    "carbon_intensity_gco2_kwh": "double",
    "reserve_margin_percent": "double",
    "temperature_celsius": "double",
    "hour_of_day": "integer",
    "renewable_percentage": "double",
    "generation_cost_per_hour": "double",
    "is_anomaly": "boolean",
    "alert_level": "string",
}
WIRE_SCHEMA = struct_of(WIRE_FIELDS)

# A reading after its event time has been typed.
READING_SCHEMA = struct_of({**WIRE_FIELDS, "timestamp": "timestamp"})
READING_COLUMNS: tuple[str, ...] = tuple(WIRE_FIELDS)

# Keyed messages as files; the Kafka source has these two plus its own metadata.
MESSAGE_SCHEMA = struct_of({"key": "string", "value": "string"})

# The lake table as read back: data columns first, partition columns last.
PARTITION_FIELDS = {
    "year": "integer",
    "month": "integer",
    "day": "integer",
    "hour": "integer",
    "region": "string",
}
PARTITION_COLUMNS: tuple[str, ...] = tuple(PARTITION_FIELDS)
LAKE_SCHEMA = StructType(
    [f for f in READING_SCHEMA.fields if f.name not in PARTITION_FIELDS]
    + struct_of(PARTITION_FIELDS).fields
)
