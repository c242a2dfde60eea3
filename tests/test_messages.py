"""JSON decoding, quality rules, source and sink options."""

import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattspan.operators import (
    parse_readings,
    quality_report,
    split_rejects,
    tag_quality,
    to_messages,
    validate_source,
)
from wattspan.schemas import READING_SCHEMA
from wattspan.sinks import SinkSpec, index_spec
from wattspan.sources import SourceSpec

GOOD = {
    "timestamp": "2024-12-15T12:36:30.123456+00:00",
    "region": "West",
    "grid_id": "WEST-GRID-1",
    "demand_mw": 100,
    "grid_frequency_hz": 60.0,
    "generation_mw": {"Solar": 5.0, "Coal": 1.5},
    "is_anomaly": False,
}


def messages(spark, *bodies):
    texts = [b if b is None or isinstance(b, str) else json.dumps(b) for b in bodies]
    return spark.createDataFrame([(None, t) for t in texts], "key string, value string")


def test_round_trip_keeps_every_value(telemetry):
    assert rows(parse_readings(to_messages(telemetry))) == rows(telemetry)
    assert parse_readings(to_messages(telemetry)).schema.simpleString() == READING_SCHEMA.simpleString()


def test_binary_values_are_decoded(spark):
    df = messages(spark, GOOD).withColumn("value", F.encode("value", "utf-8"))
    row = parse_readings(df).first()
    assert row.timestamp == datetime(2024, 12, 15, 12, 36, 30, 123456)
    assert row.demand_mw == 100.0
    assert row.generation_mw.Coal == 1.5 and row.generation_mw.Wind is None


def test_permissive_decoding(spark):
    wrong = {**GOOD, "demand_mw": "high"}
    bad_time = {**GOOD, "timestamp": "yesterday"}
    df = parse_readings(messages(spark, "{bad", None, wrong, bad_time))
    assert rows(df, "region", "demand_mw", "timestamp") == sorted(
        [
            (None, None, None),
            (None, None, None),
            ("West", None, datetime(2024, 12, 15, 12, 36, 30, 123456)),
            ("West", 100.0, None),
        ],
        key=repr,
    )


def test_offsets_other_than_utc(spark):
    row = parse_readings(messages(spark, {**GOOD, "timestamp": "2024-12-15T14:00:00+02:00"})).first()
    assert row.timestamp == datetime(2024, 12, 15, 12)


def test_only_the_wanted_fields(spark):
    df = parse_readings(messages(spark, GOOD), fields=["region"])
    assert df.columns == ["timestamp", "region"]
    assert df.first().region == "West"


def test_quality_reasons(spark):
    night = {**GOOD, "timestamp": "2024-12-15T22:00:00+00:00"}
    cases = {
        "unparsable_json": "{bad",
        "empty_message": None,
        "bad_field_type": {**GOOD, "demand_mw": "high"},
        "missing_key": {**GOOD, "region": None},
        "missing_time": {**GOOD, "timestamp": "yesterday"},
        "unknown_region": {**GOOD, "region": "Atlantis"},
        "frequency_out_of_bounds": {**GOOD, "grid_frequency_hz": 71.0},
        "solar_at_night": night,
        None: GOOD,
    }
    df = messages(spark, *cases.values())
    tagged = [r.reject_reason for r in tag_quality(df).collect()]
    assert tagged == list(cases)

    report = quality_report(df).first().asDict()
    assert report.pop("messages") == 9
    assert set(report.values()) == {1}

    good, bad = split_rejects(df)
    assert good.columns == list(READING_SCHEMA.fieldNames()) and good.count() == 1
    assert bad.count() == 8


def test_validate_source(spark):
    five = messages(spark, *[GOOD] * 9)
    assert rows(validate_source(five)) == [(5, True)]
    assert rows(validate_source(five, minimum=10)) == [(9, False)]
    assert rows(validate_source(five.limit(0))) == [(0, False)]


def test_kafka_source_options():
    spec = SourceSpec("readings", servers="broker:9092", max_per_trigger=1000, min_partitions=64)
    options = spec.from_earliest().options()
    assert options["subscribe"] == "readings"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert options["minPartitions"] == "64"
    assert options["kafka.session.timeout.ms"] == "30000"
    assert "maxOffsetsPerTrigger" not in spec.options(streaming=False)
    assert SourceSpec("folder", kind="parquet", max_per_trigger=2).options() == {
        "maxFilesPerTrigger": "2"
    }
    with pytest.raises(ValueError):
        SourceSpec("readings")


def test_sink_options():
    spec = SinkSpec("processed", servers="broker:9092", extra={"kafka.acks": "all"})
    assert spec.options() == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "processed",
        "kafka.acks": "all",
    }
    index = index_spec("metrics", options={"es.nodes": "search"})
    assert index.options["es.resource"] == "metrics"
    assert index.options["es.mapping.id"] == "es_id"
    assert index.options["es.nodes"] == "search"
