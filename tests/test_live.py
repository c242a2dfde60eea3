"""Spikes by keyed state, late readings, and liveness of queries."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streams import add_file, message_stream, reading

from wattspan.operators import parse_readings
from wattspan.plans import catalog
from wattspan.sinks import read_target
from wattspan.streaming import Run
from wattspan.streaming.live_spikes import LATE, SPIKE, spike_table, write_live_spikes
from wattspan.streaming.liveness import Liveness, offsets_behind

DAY = datetime(2024, 1, 1)


def run_spikes(spark, topic, out, tmp_path):
    stream = parse_readings(message_stream(spark, topic))
    run = Run("live", str(tmp_path / "cp"), "append", None, 3)
    write_live_spikes(stream, out, run).awaitTermination()


def test_an_hour_is_judged_when_it_is_over_whatever_restarts(spark, tmp_path):
    topic, out = tmp_path / "topic", str(tmp_path / "spikes")

    def at(minutes, demand, grid=1, region="West"):
        return reading(DAY + timedelta(minutes=minutes), region=region, demand=demand, grid=grid)

    add_file(spark, topic, at(5, 100.0), at(10, 400.0, 2), at(11, None), at(12, 100.0, region="East"), reading(None))
    run_spikes(spark, topic, out, tmp_path)
    assert read_target(spark, spike_table(out)).count() == 0
    # The rest of the hour comes after a restart and lowers the average; 04:30 closes it.
    add_file(spark, topic, at(50, 100.0, 3), at(55, 200.0, 4))
    add_file(spark, topic, at(270, 100.0))
    run_spikes(spark, topic, out, tmp_path)
    spikes = read_target(spark, spike_table(out), SPIKE)
    assert rows(spikes, "grid_id", "demand_mw", "hourly_avg_demand_mw") == [("WEST-GRID-2", 400.0, 200.0)]
    # A reading of the closed hour, and one of an hour without any so far that is over too.
    add_file(spark, topic, at(20, 900.0, 5), at(80, 900.0, 6, "South"), at(271, 100.0, 7))
    run_spikes(spark, topic, out, tmp_path)
    late = read_target(spark, spike_table(out), LATE)
    assert rows(late, "region", "grid_id", "demand_mw", "hourly_avg_demand_mw") == [
        ("South", "SOUTH-GRID-6", 900.0, None),
        ("West", "WEST-GRID-5", 900.0, None),
    ]
    assert rows(read_target(spark, spike_table(out), SPIKE)) == rows(spikes)


def progress(name="q", rows=0, batch=0, behind=None, dropped=0):
    metrics = {} if behind is None else {"maxOffsetsBehindLatest": str(behind)}
    return {
        "id": "1", "name": name, "batchId": batch, "numInputRows": rows,
        "sources": [{"metrics": metrics}], "stateOperators": [{"numRowsDroppedByWatermark": dropped}],
    }


def test_statuses():
    listener = Liveness(patience=2)
    listener._progress(progress())
    assert listener.status("q") == "empty"
    listener._progress(progress(rows=4, batch=1, dropped=2))
    assert listener.status("q") == "live"
    for _ in range(2):
        listener._progress(progress(batch=1, behind=0, dropped=2))
    assert listener.status("q") == "quiet"
    listener._progress(progress(batch=1, behind=9))
    assert listener.status("q") == "stalled"
    assert listener.pulse("q").dropped == 2
    listener._progress(progress(rows=9, batch=2))
    assert (listener.status("q"), listener.pulse("q").messages) == ("live", 13)
    assert offsets_behind({}) == 0


def test_listener_follows_empty_stopped_and_failed_queries(spark, tmp_path):
    empty = tmp_path / "empty"
    add_file(spark, empty)  # a file without messages
    full = tmp_path / "full"
    add_file(spark, full, reading(DAY), reading(DAY))
    listener = Liveness()
    spark.streams.addListener(listener)
    try:
        for name, folder in (("none", empty), ("some", full)):
            query = Run(name, str(tmp_path / "cp")).start(message_stream(spark, folder), lambda w: w.format("noop"))
            query.awaitTermination()
            assert listener.wait_for_end(name)

        def broken(batch, number):
            raise RuntimeError("sink is down")

        failing = Run("broken", str(tmp_path / "cp")).start(
            message_stream(spark, full), lambda w: w.foreachBatch(broken)
        )
        try:
            failing.awaitTermination()
        except Exception:
            pass
        assert listener.wait_for_end("broken")
    finally:
        spark.streams.removeListener(listener)
    table = listener.table(spark)
    assert rows(table.where(F.col("query") != ""), "query", "messages_seen", "status") == [
        ("broken", 0, "failed"),
        ("none", 0, "stopped"),
        ("some", 2, "stopped"),
    ]


@pytest.mark.parametrize("name", ["stream_liveness", "stream_lake_all"])
def test_topic_files_grow_in_number(spark, sf_dir, tmp_path, monkeypatch, name):
    monkeypatch.setattr(catalog, "work_path", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(catalog, "MESSAGES_A_FILE", 50, raising=False)
    catalog.QUERIES[name](spark, sf_dir).collect()
    files = [spark.read.parquet(str(f)).count() for f in (tmp_path / "topic").glob("*.parquet")]
    sent = catalog.read_events(spark, sf_dir).count()
    assert sum(files) == sent and len(files) >= sent / 50 > 4
    assert max(files) <= 60
    batches = [f.name for f in next((tmp_path / "checkpoints").glob("*")).glob("commits/[0-9]*")]
    assert sorted(batches) == ["0", "1", "2", "3"]
