"""Streams: equal to batch, late data, restart, upserts, standing jobs."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattspan.operators import (
    demand_spikes,
    flat_window,
    hourly_trend,
    parse_readings,
    regional_window,
    stage_baseline,
    to_documents,
    to_messages,
)
from wattspan.plans.telemetry import EVENTS_DDL, read_events, readings_from_events
from wattspan.schemas import MESSAGE_SCHEMA, READING_COLUMNS, READING_SCHEMA
from wattspan.sinks import (
    SinkSpec,
    UpsertSpec,
    compact_upserts,
    read_upserts,
    write_console,
    write_lake,
    write_messages,
)
from wattspan.sources import SourceSpec, read_lake, read_stream
from wattspan.streaming import Run, await_all, checkpoint_for
from wattspan.streaming.jobs import start
from wattspan.streaming.pipelines import read_windows, write_documents, write_windows


def reading(when, region="West", demand=100.0, grid=1):
    values = dict.fromkeys(READING_COLUMNS)
    values.update(
        timestamp=when, region=region, grid_id=f"{region.upper()}-GRID-{grid}", demand_mw=demand
    )
    return tuple(values.values())


def add_file(spark, folder, *readings):
    """One more file of messages, as one more micro-batch."""
    df = spark.createDataFrame(list(readings), READING_SCHEMA)
    to_messages(df).coalesce(1).write.mode("append").parquet(str(folder))


def message_stream(spark, folder, cap=1):
    return read_stream(spark, SourceSpec(str(folder), kind="parquet", max_per_trigger=cap))


@pytest.fixture
def late_files(spark, tmp_path):
    folder = tmp_path / "late"
    day = datetime(2024, 1, 1)
    for minutes in (120, 180, 3, 240):
        add_file(spark, folder, reading(day + timedelta(minutes=minutes)))
    return folder


def run_windows(spark, folder, tmp_path, mode):
    aggregate = regional_window(parse_readings(message_stream(spark, folder)))
    out = str(tmp_path / f"out-{mode}")
    query = write_windows(aggregate, out, Run(f"late-{mode}", str(tmp_path / "cp"), mode, None, 4))
    query.awaitTermination()
    schema = flat_window(aggregate).schema
    table = read_windows(spark, out, schema, mode)
    dropped = sum(
        int(state["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
    return [t[0].strftime("%H:%M") for t in rows(table, "window_start")], dropped


@pytest.mark.parametrize(
    "mode, windows, dropped",
    [
        ("append", ["02:00", "03:00"], 1),
        ("update", ["02:00", "03:00", "04:00"], 1),
        ("complete", ["00:00", "02:00", "03:00", "04:00"], 0),
    ],
)
def test_late_rows(spark, late_files, tmp_path, mode, windows, dropped):
    assert run_windows(spark, late_files, tmp_path, mode) == (windows, dropped)


def test_many_micro_batches_equal_one_batch(spark, sf_dir, tmp_path):
    events = read_events(spark, sf_dir)
    folder = str(tmp_path / "events")
    events.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(EVENTS_DDL).option("maxFilesPerTrigger", 1).parquet(folder)
    batch = readings_from_events(events)
    names = ("window_start", "region", "hourly_avg_demand", "hourly_peak_demand")
    for mode in ("complete",):
        aggregate = hourly_trend(readings_from_events(stream))
        out = str(tmp_path / mode)
        run = Run(f"multi-{mode}", str(tmp_path / "cp"), mode, None, 4)
        query = write_windows(aggregate, out, run)
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 5
        table = read_windows(spark, out, flat_window(aggregate).schema, mode)
        assert rows(table, *names) == rows(flat_window(hourly_trend(batch)), *names)


def test_lake_restart_neither_loses_nor_repeats(spark, tmp_path):
    topic, lake, day = tmp_path / "topic", str(tmp_path / "lake"), datetime(2024, 1, 1, 10)
    for round_ in range(3):
        add_file(
            spark, topic, *(reading(day + timedelta(minutes=round_), grid=g) for g in range(5))
        )
        run = Run("restart", str(tmp_path / "cp"))
        for _ in range(2):
            good = parse_readings(message_stream(spark, topic))
            write_lake(good, lake, run).awaitTermination()
        assert read_lake(spark, lake).count() == 5 * (round_ + 1)


def test_documents_keep_the_last_write(spark, tmp_path):
    topic, index, when = tmp_path / "topic", str(tmp_path / "index"), datetime(2024, 1, 1, 10)
    run = Run("docs", str(tmp_path / "cp"))

    def send(*readings):
        add_file(spark, topic, *readings)
        write_documents(message_stream(spark, topic), UpsertSpec(index), run).awaitTermination()

    # Two readings of one second in one batch, and one with no id.
    send(
        reading(when, demand=1.0),
        reading(when + timedelta(milliseconds=500), demand=2.0),
        reading(when, grid=2, demand=3.0),
        reading(None, demand=9.0),
    )
    schema = to_documents(spark.createDataFrame([], READING_SCHEMA)).schema
    assert rows(read_upserts(spark, index, schema), "demand_mw") == [(2.0,), (3.0,)]

    # A later batch wins although its event time is older.
    send(reading(when, demand=4.0))
    assert rows(read_upserts(spark, index, schema), "demand_mw") == [(3.0,), (4.0,)]

    compact_upserts(spark, index, schema, str(tmp_path / "base"), through=1)
    send(reading(when, grid=2, demand=5.0))
    got = read_upserts(spark, index, schema, base=str(tmp_path / "base"), after=1)
    assert rows(got, "demand_mw") == rows(read_upserts(spark, index, schema), "demand_mw")
    assert rows(got, "demand_mw") == [(4.0,), (5.0,)]


def test_arrival_order_decides_where_there_are_offsets(spark, tmp_path):
    when = datetime(2024, 1, 1, 10)
    newer = reading(when + timedelta(milliseconds=900), demand=1.0)
    sent = spark.createDataFrame([newer, reading(when, demand=2.0)], READING_SCHEMA).coalesce(1)
    with_offset = to_messages(sent).withColumn("offset", F.monotonically_increasing_id())
    with_offset.write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(with_offset.schema).parquet(str(tmp_path / "topic"))
    run = Run("offsets", str(tmp_path / "cp"))
    write_documents(stream, UpsertSpec(str(tmp_path / "index")), run).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "index"))
    assert rows(table, "demand_mw") == [(2.0,)]
    assert "offset" not in table.columns


def test_spikes_on_a_stream_need_a_baseline(spark, tmp_path, telemetry):
    to_messages(telemetry).write.parquet(str(tmp_path / "topic"))
    stream = parse_readings(message_stream(spark, tmp_path / "topic"))
    with pytest.raises(ValueError):
        demand_spikes(stream)
    baseline = stage_baseline(telemetry, str(tmp_path / "baseline"))
    spikes = demand_spikes(stream, multiplier=1.2, baseline=baseline)
    run = Run("spikes", str(tmp_path / "cp"))
    out = str(tmp_path / "spikes")
    run.start(spikes, lambda w: w.format("parquet").option("path", out)).awaitTermination()
    names = ("region", "timestamp", "demand_mw", "hourly_avg_demand_mw")
    batch = demand_spikes(telemetry, multiplier=1.2)
    assert rows(spark.read.parquet(out), *names) == rows(batch, *names)


def test_console_sink(spark, tmp_path):
    add_file(spark, tmp_path / "topic", reading(datetime(2024, 1, 1)))
    aggregate = regional_window(parse_readings(message_stream(spark, tmp_path / "topic")))
    query = write_console(aggregate, Run("console", str(tmp_path / "cp"), "complete", None, 2))
    query.awaitTermination()
    assert query.exception() is None


def test_standing_jobs_on_files(spark, tmp_path, telemetry):
    topic = str(tmp_path / "readings")
    write_messages(telemetry, SinkSpec(topic, kind="parquet"))
    base = ["--files", "--checkpoints", str(tmp_path / "cp"), "--topic"]

    processed = str(tmp_path / "processed")
    windows = ["--output", processed, "--windows", str(tmp_path / "w")]
    await_all(spark, start(spark, ["processor", *base, topic, *windows]))
    republished = spark.read.schema(MESSAGE_SCHEMA).parquet(processed)
    assert rows(parse_readings(republished)) == rows(telemetry)
    assert republished.where(F.col("value").contains("processed_at")).count() == telemetry.count()
    assert spark.read.parquet(str(tmp_path / "w/windows_hourly")).count() > 0

    outputs = {name: str(tmp_path / name) for name in ("indexer", "lake", "alerts")}
    for job, out in outputs.items():
        await_all(spark, start(spark, [job, *base, processed, "--output", out]))
    assert rows(read_lake(spark, outputs["lake"])) == rows(telemetry)
    critical = telemetry.where("alert_level = 'CRITICAL'").count()
    assert spark.read.json(outputs["alerts"]).count() == critical
    assert spark.read.parquet(outputs["indexer"]).count() == telemetry.count()


def test_failed_query_stops_the_others(spark, tmp_path):
    add_file(spark, tmp_path / "topic", reading(datetime(2024, 1, 1)))
    stream = parse_readings(message_stream(spark, tmp_path / "topic"))

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    cp = str(tmp_path / "cp")
    healthy = Run("healthy", cp, interval="1 second").start(
        stream, lambda w: w.format("noop")
    )
    failing = Run("failing", cp, interval="1 second").start(
        stream, lambda w: w.foreachBatch(broken)
    )
    with pytest.raises(Exception, match="sink is down"):
        await_all(spark, [healthy, failing])
    assert not healthy.isActive


def test_checkpoint_names():
    assert checkpoint_for("/shared/cp/", "raw") == "/shared/cp/raw"
    with pytest.raises(ValueError):
        checkpoint_for("/shared/cp", "../raw")
