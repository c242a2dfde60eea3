"""Engine parameters: plain literals that enter queries as column constants."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# Region and source names, limits, coefficients and capacities.
REGIONS = ("Northeast", "Southeast", "Midwest", "Southwest", "West")
SOURCES = ("Solar", "Wind", "Natural_Gas", "Coal", "Nuclear", "Hydro")
RENEWABLE_SOURCES = ("Solar", "Wind", "Hydro")
CARBON_GCO2_PER_KWH = {
    "Solar": 50.0,
    "Wind": 10.0,
    "Natural_Gas": 450.0,
    "Coal": 920.0,
    "Nuclear": 10.0,
    "Hydro": 20.0,
}
COST_PER_MWH = {
    "Solar": 30.0,
    "Wind": 25.0,
    "Natural_Gas": 70.0,
    "Coal": 60.0,
    "Nuclear": 30.0,
    "Hydro": 40.0,
}
BASE_CAPACITY_MW = {
    "Northeast": 8000.0,
    "Southeast": 12000.0,
    "Midwest": 10000.0,
    "Southwest": 7000.0,
    "West": 9000.0,
}


@dataclass(frozen=True)
class EngineConfig:
    """All limits and coefficients of the engine.

    ``critical_frequency_deviation_hz`` and ``warn_reserve_margin_percent``
    are settings here, so a deployment can tune them like the other limits.
    """

    regions: tuple[str, ...] = REGIONS
    sources: tuple[str, ...] = SOURCES
    renewable_sources: tuple[str, ...] = RENEWABLE_SOURCES
    nominal_frequency_hz: float = 60.0
    frequency_deviation_hz: float = 0.015
    critical_frequency_deviation_hz: float = 0.025
    min_reserve_margin_percent: float = 5.0
    warn_reserve_margin_percent: float = 10.0
    voltage_min_kv: float = 335.0
    voltage_max_kv: float = 355.0
    demand_spike_multiplier: float = 1.5
    frequency_floor_hz: float = 50.0
    frequency_ceiling_hz: float = 70.0
    carbon_coefficients: Mapping[str, float] = field(
        default_factory=lambda: dict(CARBON_GCO2_PER_KWH)
    )
    generation_costs: Mapping[str, float] = field(default_factory=lambda: dict(COST_PER_MWH))
    regional_base_capacity: Mapping[str, float] = field(
        default_factory=lambda: dict(BASE_CAPACITY_MW)
    )

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> EngineConfig:
        """Build from a nested mapping; absent keys keep their defaults.

        Understands the sections ``regions``, ``generation_types``,
        ``thresholds``, ``carbon_coefficients``, ``generation_costs`` and
        ``regional_base_capacity``; other sections are left to the caller.
        """
        known = {f.name for f in fields(cls) if f.type == "float"}
        limits = raw.get("thresholds") or {}
        if unknown := sorted(set(limits) - known):
            raise ValueError(f"unknown thresholds: {', '.join(unknown)}")
        values: dict[str, Any] = {name: float(limit) for name, limit in limits.items()}
        if raw.get("regions"):
            values["regions"] = tuple(raw["regions"])
        if raw.get("generation_types"):
            values["sources"] = tuple(raw["generation_types"])
        for name in ("carbon_coefficients", "generation_costs", "regional_base_capacity"):
            if raw.get(name):
                values[name] = {key: float(number) for key, number in raw[name].items()}
        return cls(**values)

    @classmethod
    def from_yaml(cls, path: str) -> EngineConfig:
        """Read :meth:`from_mapping` input from a YAML file on the driver."""
        import yaml

        with open(path, encoding="utf-8") as handle:
            return cls.from_mapping(yaml.safe_load(handle) or {})


DEFAULT_CONFIG = EngineConfig()
