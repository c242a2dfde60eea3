"""Alert rules, metrics and bands on small hand-made rows."""

import itertools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.functions import (
    alert_level,
    band,
    carbon_intensity,
    demand_band,
    generation_cost,
    generation_mix,
    renewable_pct,
    reserve_margin,
    temperature_factor,
    total_generation,
)
from wattspan.functions.bands import RENEWABLE_EDGES
from wattspan.operators import classify_alert
from wattspan.schemas import SOURCE_STRUCT, struct_of

FREQUENCIES = (60.0, 60.02, 60.03, 59.98, None)
MARGINS = (2.0, 7.0, 12.0, None)
VOLTAGES = (330.0, 345.0, 360.0, None)
RANK = ("NORMAL", "WARNING", "CRITICAL")


def severity(frequency, margin, voltage, variant):
    """The highest level any single violated limit asks for."""
    deviation = 0.0 if frequency is None else abs(frequency - 60.0)
    thin = 100.0 if margin is None else margin
    fault = voltage is not None and not 335.0 <= voltage <= 355.0
    asked = [0]
    asked.append(2 if deviation > 0.025 else 1 if deviation > 0.015 else 0)
    asked.append(2 if thin < 5 else 1 if thin < 10 and variant == "processor" else 0)
    if fault:
        asked.append(2 if variant == "producer" and max(asked) > 0 else 1)
    return RANK[max(asked)]


@pytest.mark.parametrize("variant", ["processor", "producer"])
def test_alert_grid(spark, variant):
    grid = list(itertools.product(FREQUENCIES, MARGINS, VOLTAGES))
    df = spark.createDataFrame(
        grid,
        "grid_frequency_hz double, reserve_margin_percent double, voltage_kv double",
    )
    for row in classify_alert(df, variant=variant).collect():
        wanted = severity(
            row.grid_frequency_hz, row.reserve_margin_percent, row.voltage_kv, variant
        )
        assert row.alert_level == wanted, row
        assert row.is_anomaly == (wanted != "NORMAL")


def test_variants_differ_where_stated(spark):
    cases = [(60.0, 7.0, 345.0), (60.02, 12.0, 330.0)]
    df = spark.createDataFrame(cases, "f double, m double, v double")
    levels = df.select(
        alert_level("f", "m", "v", variant="processor"),
        alert_level("f", "m", "v", variant="producer"),
    )
    assert rows(levels) == [("WARNING", "CRITICAL"), ("WARNING", "NORMAL")]


def test_unknown_variant_is_refused():
    with pytest.raises(ValueError):
        alert_level(F.lit(60.0), F.lit(1.0), F.lit(340.0), variant="other")


def test_limits_come_from_the_configuration(spark):
    cfg = EngineConfig.from_mapping({"thresholds": {"voltage_max_kv": 400}})
    df = spark.createDataFrame([(60.0, 50.0, 360.0)], "f double, m double, v double")
    assert df.select(alert_level("f", "m", "v", cfg)).first()[0] == "NORMAL"
    assert df.select(alert_level("f", "m", "v", DEFAULT_CONFIG)).first()[0] == "WARNING"


def sources(spark, *values):
    schema = struct_of({"s": SOURCE_STRUCT})
    return spark.createDataFrame([(v,) for v in values], schema)


def test_metrics_of_a_known_mix(spark):
    df = sources(spark, (100.0, 200.0, 300.0, 250.0, 100.0, 50.0))
    row = df.select(
        total_generation("s").alias("total"),
        carbon_intensity("s").alias("carbon"),
        generation_cost("s").alias("cost"),
        renewable_pct("s").alias("renewable"),
        generation_mix("s").alias("mix"),
    ).first()
    assert row.total == 1000.0
    assert row.carbon == 50 + 20 + 1350 + 2300 + 10 + 10
    assert row.cost == 3000 + 5000 + 21000 + 15000 + 3000 + 2000
    assert row.renewable == 35.0
    assert tuple(row.mix) == (10.0, 20.0, 30.0, 25.0, 10.0, 5.0)


def test_missing_source_is_zero_and_missing_struct_is_null(spark):
    df = sources(spark, (None, None, 100.0, None, None, None), None)
    got = df.select(carbon_intensity("s"), generation_cost("s"), renewable_pct("s")).collect()
    assert tuple(got[0]) == (450.0, 7000.0, 0.0)
    assert tuple(got[1]) == (None, None, None)


def test_nothing_generated_gives_zero_shares(spark):
    df = sources(spark, (0.0,) * 6)
    row = df.select(renewable_pct("s").alias("r"), generation_mix("s").alias("m")).first()
    assert row.r == 0.0 and set(row.m) == {0.0}


def test_reserve_margin(spark):
    df = spark.createDataFrame(
        [(110.0, 100.0), (90.0, 100.0), (90.0, 0.0), (90.0, -1.0), (90.0, None)], "g double, d double"
    )
    got = [r[0] for r in df.select(reserve_margin("g", "d")).collect()]
    assert got == [10.0, -10.0, 0.0, 0.0, None]


def test_temperature_factor(spark):
    df = spark.createDataFrame(
        [(-5.0,), (0.0,), (5.0,), (20.0,), (30.0,), (34.0,), (None,)], "t double"
    )
    got = [r[0] for r in df.select(F.round(temperature_factor("t"), 9)).collect()]
    assert got == [1.15, 1.075, 1.0, 1.0, 1.0, 1.08, None]


def test_demand_band_of_every_hour(spark):
    got = {r.id: r.b for r in spark.range(24).select("id", demand_band("id").alias("b")).collect()}
    peak, moderate, low = {8, 9, 10, 18, 19, 20, 21}, set(range(11, 18)), {23, *range(7)}
    for hour, name in got.items():
        wanted = (
            "peak" if hour in peak else "moderate" if hour in moderate else "low" if hour in low else "normal"
        )
        assert name == wanted, hour


def test_bands_are_half_open_and_open_at_both_ends(spark):
    df = spark.createDataFrame(
        [(-1.0,), (0.0,), (14.9,), (15.0,), (60.0,), (100.0,), (100.1,), (None,)], "v double"
    )
    got = [r[0] for r in df.select(band("v", RENEWABLE_EDGES)).collect()]
    assert got == ["0-15", "0-15", "0-15", "15-35", "60-100", "60-100", "60-100", None]
    with pytest.raises(ValueError):
        band("v", (0, 1, 2), ["only one"])


def test_configuration_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "limits.yaml"
    path.write_text(
        "regions: [North, South]\nthresholds:\n  demand_spike_multiplier: 2\n"
        "generation_costs: {Coal: 1}\nstreaming: {topic: ignored}\n"
    )
    cfg = EngineConfig.from_yaml(str(path))
    assert cfg.regions == ("North", "South")
    assert cfg.demand_spike_multiplier == 2.0
    assert cfg.generation_costs == {"Coal": 1.0}
    assert cfg.carbon_coefficients == DEFAULT_CONFIG.carbon_coefficients
