"""Alert rules as a single CASE expression per rule set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.functions.metrics import ColumnOrName, as_column

NORMAL, WARNING, CRITICAL = "NORMAL", "WARNING", "CRITICAL"
VARIANTS = ("processor", "producer")


def alert_level(
    frequency: ColumnOrName,
    margin: ColumnOrName,
    voltage: ColumnOrName,
    cfg: EngineConfig = DEFAULT_CONFIG,
    variant: str = "processor",
) -> Column:
    """Severity of a reading.

    The ``processor`` rules also warn on a thin reserve margin; the
    ``producer`` rules instead escalate a voltage fault that comes with a
    frequency deviation. An unknown (NULL) metric violates nothing.
    """
    if variant not in VARIANTS:
        raise ValueError(f"unknown rule set {variant!r}, expected one of {VARIANTS}")
    voltage, margin = as_column(voltage), as_column(margin)
    deviation = F.abs(as_column(frequency) - F.lit(cfg.nominal_frequency_hz))

    unstable = deviation > cfg.frequency_deviation_hz
    bad_voltage = (voltage < cfg.voltage_min_kv) | (voltage > cfg.voltage_max_kv)
    critical = (deviation > cfg.critical_frequency_deviation_hz) | (
        margin < cfg.min_reserve_margin_percent
    )
    warning = unstable | bad_voltage
    if variant == "processor":
        warning = warning | (margin < cfg.warn_reserve_margin_percent)
    else:
        critical = critical | (bad_voltage & unstable)
    return F.when(critical, CRITICAL).when(warning, WARNING).otherwise(NORMAL)
