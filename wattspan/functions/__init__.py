"""Column expressions: metrics, alert rules, display bands."""

from wattspan.functions.alerts import alert_level
from wattspan.functions.bands import band
from wattspan.functions.metrics import (
    carbon_intensity,
    demand_band,
    generation_cost,
    generation_mix,
    renewable_pct,
    reserve_margin,
    temperature_factor,
    total_generation,
    weather_adjusted_demand,
)

__all__ = [
    "alert_level",
    "band",
    "carbon_intensity",
    "demand_band",
    "generation_cost",
    "generation_mix",
    "renewable_pct",
    "reserve_margin",
    "temperature_factor",
    "total_generation",
    "weather_adjusted_demand",
]
