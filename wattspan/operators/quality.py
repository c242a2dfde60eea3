"""Row quality: rejects, recomputed metrics, source liveness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.functions.metrics import (
    carbon_intensity,
    generation_cost,
    generation_mix,
    renewable_pct,
    reserve_margin,
    total_generation,
)
from wattspan.operators.parse import BAD_JSON, parse_readings
from wattspan.schemas import READING_COLUMNS

REASON = "reject_reason"
# The two targets of the messages of a lake.
LAKE, REJECTS = "lake", "rejects"


def soft_faults(cfg: EngineConfig = DEFAULT_CONFIG) -> dict[str, Column]:
    """Named faults of a reading that still has its keys and time. No test is NULL."""
    night = (F.hour("timestamp") < 6) | (F.hour("timestamp") > 20)
    frequency = F.col("grid_frequency_hz")
    faults = {
        "unknown_region": ~F.col("region").isin(*cfg.regions),
        "frequency_out_of_bounds": ~frequency.between(
            cfg.frequency_floor_hz, cfg.frequency_ceiling_hz
        ),
        "solar_at_night": night & (F.col("generation_mw.Solar") > 0),
    }
    return {name: F.coalesce(fault, F.lit(False)) for name, fault in faults.items()}


def _first_fault(faults: dict[str, Column]) -> Column:
    return F.coalesce(*(F.when(fault, name) for name, fault in faults.items()))


def with_soft_fault(readings: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Readings, as from the lake, with their first soft fault; NULL without one."""
    return readings.withColumn(REASON, _first_fault(soft_faults(cfg)))


def quality_rules(cfg: EngineConfig = DEFAULT_CONFIG) -> dict[str, Column]:
    """Named faults of a decoded message, most basic first. No test is NULL.

    Needs the columns of ``parse_readings(messages, ["value"], keep_bad=True)``.
    """
    blank = F.col("region").isNull() & F.col("grid_id").isNull() & F.col("demand_mw").isNull()
    faults = {
        "empty_message": F.col("value").isNull(),
        "unparsable_json": F.col(BAD_JSON).isNotNull() & blank,
        "bad_field_type": F.col(BAD_JSON).isNotNull(),
        "missing_key": F.col("region").isNull() | F.col("grid_id").isNull(),
        "missing_time": F.col("timestamp").isNull(),
    }
    hard = {name: F.coalesce(fault, F.lit(False)) for name, fault in faults.items()}
    return {**hard, **soft_faults(cfg)}


def tag_quality(messages: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Decoded messages with the first fault of each, NULL when it has none."""
    decoded = parse_readings(messages, ["value"], keep_bad=True)
    return decoded.withColumn(REASON, _first_fault(quality_rules(cfg)))


def split_rejects(
    messages: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG
) -> tuple[DataFrame, DataFrame]:
    """Good readings, and rejected messages as ``(value, reject_reason)``.

    To write both from one pass, write :func:`tag_quality` partitioned by the
    reason instead.
    """
    tagged = tag_quality(messages, cfg)
    good = tagged.where(F.col(REASON).isNull()).select(*READING_COLUMNS)
    rejects = tagged.where(F.col(REASON).isNotNull()).select("value", REASON)
    return good, rejects


def split_for_lake(
    messages: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG
) -> tuple[DataFrame, DataFrame]:
    """As :func:`split_rejects`, but readings with no more than a soft fault are kept.

    :func:`with_soft_fault` names their fault again.
    """
    tagged = tag_quality(messages, cfg)
    kept = F.col(REASON).isNull() | F.col(REASON).isin(*soft_faults(cfg))
    return tagged.where(kept).select(*READING_COLUMNS), tagged.where(~kept).select("value", REASON)


def tag_for_lake(messages: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """As :func:`split_for_lake` in one frame: ``target`` is ``lake`` or ``rejects``.

    Rows for the lake have the columns of a reading, rejects their message and its fault.
    """
    tagged = tag_quality(messages, cfg)
    kept = F.col(REASON).isNull() | F.col(REASON).isin(*soft_faults(cfg))
    return tagged.select(
        F.when(kept, LAKE).otherwise(REJECTS).alias("target"),
        *(F.when(kept, F.col(name)).alias(name) for name in READING_COLUMNS),
        F.when(~kept, F.col("value")).alias("value"),
        F.when(~kept, F.col(REASON)).alias(REASON),
    )


def quality_report(messages: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Number of messages by first fault, plus all and accepted, in one row."""
    tagged = tag_quality(messages, cfg)
    return tagged.agg(
        F.count("*").alias("messages"),
        F.count_if(F.col(REASON).isNull()).alias("accepted"),
        *(F.count_if(F.col(REASON) == name).alias(name) for name in quality_rules(cfg)),
    )


def revalidate(
    df: DataFrame, tolerance: float = 0.05, cfg: EngineConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Recompute every derived metric from raw MW and compare with the received one.

    Adds ``<metric>_expected`` and ``<metric>_ok`` per metric and
    ``is_consistent``. ``tolerance`` is absolute, and wide enough by default
    for inputs rounded to two digits; a missing value is not consistent.
    """
    with_total = df.withColumn(
        "total_generation_mw_expected", total_generation("generation_mw", cfg)
    )
    total = F.col("total_generation_mw_expected")
    with_mix = with_total.withColumn(
        "_mix", generation_mix("generation_mw", cfg, digits=None, total=total)
    )
    expected = {
        "carbon_intensity_gco2_kwh": carbon_intensity("_mix", cfg, digits=None),
        "generation_cost_per_hour": generation_cost("generation_mw", cfg, digits=None),
        "renewable_percentage": renewable_pct("generation_mw", cfg, digits=None, total=total),
        "reserve_margin_percent": reserve_margin(total, "demand_mw", digits=None),
    }
    checked = with_mix.withColumns({f"{m}_expected": value for m, value in expected.items()})
    metrics = ["total_generation_mw", *expected]
    checked = checked.withColumns(
        {
            f"{m}_ok": F.coalesce(F.abs(F.col(m) - F.col(f"{m}_expected")) <= tolerance, F.lit(False))
            for m in metrics
        }
    )
    every = F.lit(True)
    for metric in metrics:
        every = every & F.col(f"{metric}_ok")
    return checked.withColumn("is_consistent", every).drop("_mix")


def validate_source(messages: DataFrame, minimum: int = 1, sample: int = 5) -> DataFrame:
    """Whether at least ``minimum`` messages exist, as one row.

    Only that many (or ``sample``) rows are taken: Spark stops at the first
    partitions that hold them, where a limit inside a plan would start a task
    for every partition of the source.
    """
    seen = len(messages.select(F.lit(1)).take(max(sample, minimum)))
    return messages.sparkSession.range(1).select(
        F.lit(seen).cast("bigint").alias("messages_seen"),
        F.lit(seen >= minimum).alias("is_live"),
    )
