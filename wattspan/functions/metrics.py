"""Derived metrics as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total_of(terms: Iterable[Column]) -> Column:
    return reduce(add, terms)


def source_value(sources: ColumnOrName, name: str) -> Column:
    """One source of a generation struct; a missing source counts as zero."""
    return F.coalesce(as_column(sources).getField(name), F.lit(0.0))


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def _unless_null(sources: Column, value: Column) -> Column:
    """NULL for a reading without the struct, rather than a made-up zero."""
    return F.when(sources.isNotNull(), value)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100.0).when(whole <= 0, F.lit(0.0))


def total_generation(mw: ColumnOrName, cfg: EngineConfig = DEFAULT_CONFIG) -> Column:
    """Sum of all sources in MW."""
    mw = as_column(mw)
    return _unless_null(mw, total_of(source_value(mw, s) for s in cfg.sources))


def generation_mix(
    mw: ColumnOrName,
    cfg: EngineConfig = DEFAULT_CONFIG,
    digits: int | None = 2,
    total: ColumnOrName | None = None,
) -> Column:
    """Struct with the percentage of each source; zeros when nothing is generated.

    Pass ``total`` when the sum is already a column, so it is not built again.
    """
    mw = as_column(mw)
    whole = total_generation(mw, cfg) if total is None else as_column(total)
    return _unless_null(
        mw,
        F.struct(
            *(
                _rounded(_share(source_value(mw, s), whole), digits).alias(s)
                for s in cfg.sources
            )
        ),
    )


def carbon_intensity(
    mix: ColumnOrName, cfg: EngineConfig = DEFAULT_CONFIG, digits: int | None = 2
) -> Column:
    """Grams of CO2 per kWh, weighted by the percentage of each source."""
    mix = as_column(mix)
    weighted = total_of(
        source_value(mix, s) * F.lit(cfg.carbon_coefficients[s]) / 100.0 for s in cfg.sources
    )
    return _rounded(_unless_null(mix, weighted), digits)


def generation_cost(
    mw: ColumnOrName, cfg: EngineConfig = DEFAULT_CONFIG, digits: int | None = 2
) -> Column:
    """Cost of one hour of generation."""
    mw = as_column(mw)
    cost = total_of(source_value(mw, s) * F.lit(cfg.generation_costs[s]) for s in cfg.sources)
    return _rounded(_unless_null(mw, cost), digits)


def renewable_pct(
    sources: ColumnOrName,
    cfg: EngineConfig = DEFAULT_CONFIG,
    digits: int | None = 2,
    total: ColumnOrName | None = None,
) -> Column:
    """Share of solar, wind and hydro; accepts the MW or the percentage struct."""
    sources = as_column(sources)
    whole = total_generation(sources, cfg) if total is None else as_column(total)
    green = total_of(source_value(sources, s) for s in cfg.renewable_sources)
    return _rounded(_unless_null(sources, _share(green, whole)), digits)


def reserve_margin(
    generation: ColumnOrName, demand: ColumnOrName, digits: int | None = 2
) -> Column:
    """Spare generation as a percentage of demand; zero without demand."""
    generation, demand = as_column(generation), as_column(demand)
    return _rounded(_share(generation - demand, demand), digits)


def demand_band(hour: ColumnOrName) -> Column:
    """Time-of-day demand band; the tests are made in this order. Hours are fixed values."""
    hour = as_column(hour)
    return (
        F.when(hour.between(8, 10) | hour.between(18, 21), "peak")
        .when(hour.between(11, 17), "moderate")
        .when((hour >= 23) | (hour <= 6), "low")
        .when(hour.isNotNull(), "normal")
    )


def temperature_factor(celsius: ColumnOrName) -> Column:
    """Demand factor for heat above 30 and cold below 5 degrees. Limits are fixed values."""
    celsius = as_column(celsius)
    return (
        F.when(celsius > 30, 1.0 + (celsius - 30.0) * 0.02)
        .when(celsius < 5, 1.0 + (5.0 - celsius) * 0.015)
        .when(celsius.isNotNull(), F.lit(1.0))
    )


def weather_adjusted_demand(demand: ColumnOrName, celsius: ColumnOrName) -> Column:
    """Demand with the effect of temperature taken out."""
    return as_column(demand) / temperature_factor(celsius)
