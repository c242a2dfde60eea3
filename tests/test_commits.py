"""Tables with commits: one pass into several targets, packing, merged runs, versions."""

import math
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streams import add_file, message_stream, reading

from wattspan.operators import latest_by_key, parse_readings, regional_window, tag_for_lake
from wattspan.operators.windows import WINDOW_FIELDS, flat_window
from wattspan.session import session_conf
from wattspan.sinks import (
    FanOut,
    add_batch,
    commit_batch,
    fanout,
    lake_table,
    latest_table,
    merge_table,
    pack,
    read_merged,
    read_rejects,
    read_target,
    read_version,
    runs_of,
    write_lake_and_rejects,
)
from wattspan.sinks.commits import DATA, current, names_in
from wattspan.sinks.upsert import UpsertSpec
from wattspan.sources import read_lake
from wattspan.streaming import Run, await_all
from wattspan.streaming.jobs import start
from wattspan.streaming.pipelines import read_documents, read_index_rejects, write_index, write_windows
from wattspan.streaming.rollup import Rollup, write_rollup

DAY = datetime(2024, 1, 1, 10)


def failing_once(monkeypatch, module, name, after=0):
    """Let a function of a module fail at its call number ``after`` and only then."""
    real, calls = getattr(module, name), []

    def stop(*args, **kwargs):
        calls.append(1)
        if len(calls) == after + 1:
            raise RuntimeError("stopped here")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, stop)


def send(spark, topic, minute, count=5):
    good = [reading(DAY + timedelta(minutes=minute), grid=g, demand=float(minute)) for g in range(count)]
    add_file(spark, topic, *good, reading(None))


def run_lake(spark, topic, lake, tmp_path, **options):
    tagged = tag_for_lake(message_stream(spark, topic))
    query = write_lake_and_rejects(tagged, lake_table(lake, **options), Run("lake", str(tmp_path / "cp")))
    query.awaitTermination()
    return query


def test_a_stop_between_write_and_commit_puts_each_message_in_one_target(spark, tmp_path, monkeypatch):
    topic, lake = tmp_path / "topic", str(tmp_path / "lake")
    for minute in range(3):
        send(spark, topic, minute)
    failing_once(monkeypatch, fanout, "publish", after=1)
    with pytest.raises(Exception, match="stopped here"):
        run_lake(spark, topic, lake, tmp_path)
    # The second batch is on disk but not committed.
    assert len(names_in(spark, f"{lake}/{DATA}")) == 2
    assert read_lake(spark, lake).count() == 5
    query = run_lake(spark, topic, lake, tmp_path)
    assert len(query.lastProgress["sources"]) == 1
    assert rows(read_lake(spark, lake), "grid_id", "demand_mw") == sorted(
        (f"WEST-GRID-{g}", float(m)) for g in range(5) for m in range(3)
    )
    assert rows(read_rejects(spark, lake), "reject_reason") == [("missing_time",)] * 3


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    table = FanOut(str(tmp_path / "t"), spark.range(1).schema)
    batch = spark.range(3).withColumn("target", F.lit("x"))
    commit_batch(batch, 0, table, "one")
    commit_batch(batch, 0, table, "one")
    commit_batch(spark.range(0).withColumn("target", F.lit("x")), 1, table, "one")
    assert read_target(spark, table, "x").count() == 3
    assert read_target(spark, table, "y").count() == 0
    with pytest.raises(RuntimeError, match="older"):
        commit_batch(batch, 0, table, "one")
    with pytest.raises(RuntimeError, match="belongs"):
        commit_batch(batch, 2, table, "other")


def test_no_commit_no_rows(spark, tmp_path):
    table = FanOut(str(tmp_path / "t"), spark.range(1).schema)
    assert read_target(spark, table).count() == 0
    pack(spark, table)
    assert read_merged(spark, latest_table(str(tmp_path / "m"), spark.range(1).schema, ["id"])).count() == 0


def test_packing_bounds_files_and_keeps_readers(spark, telemetry, tmp_path):
    lake = str(tmp_path / "lake")
    table = lake_table(lake, target_bytes=12_000)
    # All readings within one hour.
    second = F.pmod(F.xxhash64("timestamp", "region"), F.lit(3600))
    hour = telemetry.withColumn("timestamp", F.timestamp_seconds(F.lit(1704103200) + second))
    calendar = [F.expr(f"{part}(timestamp)").alias(part) for part in ("year", "month", "day", "hour")]
    texts = [F.lit(None).cast("string").alias(name) for name in ("value", "reject_reason")]
    placed = hour.select(F.lit("lake").alias("target"), "*", *texts, *calendar)
    for number in range(6):
        commit_batch(placed, number, table)
    before = rows(read_lake(spark, lake), "timestamp", "region", "demand_mw")
    open_reader = read_lake(spark, lake)
    size, parts = {}, [table.path(part) for part in current(spark, lake)["parts"]]
    written = spark.read.option("basePath", f"{lake}/{DATA}").parquet(*parts)
    for r in written.select("region", "day", "hour", "_metadata.file_path", "_metadata.file_size").distinct().collect():
        size[r.region, r.day, r.hour] = size.get((r.region, r.day, r.hour), 0) + r.file_size
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        pack(spark, table)
    state = current(spark, lake)
    assert len(state["parts"]) == 1
    assert rows(read_lake(spark, lake), "timestamp", "region", "demand_mw") == before
    assert rows(open_reader, "timestamp", "region", "demand_mw") == before
    files = {}
    for r in spark.read.parquet(table.path(state["parts"][0])).select("region", "day", "hour", "_metadata.file_path").distinct().collect():
        files[r.region, r.day, r.hour] = files.get((r.region, r.day, r.hour), 0) + 1
    assert set(files) == set(size)
    assert all(files[k] <= math.ceil(size[k] / 12_000) for k in files)
    assert max(files.values()) > 1
    # The next generation lets the parts before this one go.
    commit_batch(placed.limit(1), 6, table)
    pack(spark, table)
    assert len(names_in(spark, f"{lake}/{DATA}")) == 3
    assert read_lake(spark, lake).count() == len(before) + 1


def test_merged_runs_stay_few_and_equal_the_latest_of_all(spark, tmp_path):
    schema = "id LONG, value LONG"
    empty = spark.createDataFrame([], schema).schema
    table = latest_table(str(tmp_path / "m"), empty, ["id"], buckets=2)
    every = None
    for number in range(50):
        batch = spark.range(20).select(((F.col("id") * 7 + number) % 40).alias("id"), F.lit(number).cast("long").alias("value"))
        batch = batch.coalesce(1)
        add_batch(batch, number, table)
        add_batch(batch, number, table)
        numbered = batch.withColumn("run", F.lit(number))
        every = numbered if every is None else every.unionByName(numbered)
        assert len(runs_of(spark, table)) <= 7
        assert len(names_in(spark, f"{table.location}/{DATA}")) <= 15
    expected = rows(latest_by_key(every, ["id"], ["run"]), "id", "value")
    assert rows(read_merged(spark, table)) == expected
    assert rows(read_merged(spark, table, {"id": 11})) == [r for r in expected if r[0] == 11]


def test_a_stop_before_the_commit_of_a_merge_changes_nothing(spark, tmp_path, monkeypatch):
    table = latest_table(str(tmp_path / "m"), spark.range(1).withColumn("v", F.lit(1)).schema, ["id"])
    add_batch(spark.range(4).withColumn("v", F.lit(1)), 0, table)
    failing_once(monkeypatch, merge_table, "publish")
    with pytest.raises(RuntimeError):
        add_batch(spark.range(2).withColumn("v", F.lit(2)), 1, table)
    assert rows(read_merged(spark, table)) == [(0, 1), (1, 1), (2, 1), (3, 1)]
    add_batch(spark.range(2).withColumn("v", F.lit(2)), 1, table)
    assert rows(read_merged(spark, table)) == [(0, 2), (1, 2), (2, 1), (3, 1)]


def test_index_and_rejects_in_one_pass(spark, tmp_path, monkeypatch):
    topic, index = tmp_path / "topic", str(tmp_path / "index")
    for minute in range(2):
        send(spark, topic, minute, count=3)
    send(spark, topic, 0, count=1)  # the same id again, later

    def run():
        stream = message_stream(spark, topic)
        spec = UpsertSpec(index)
        query = write_index(stream, spec, f"{index}_rejects", Run("docs", str(tmp_path / "cp")))
        query.awaitTermination()
        return query

    # Stopped between the two commits of the second batch.
    failing_once(monkeypatch, merge_table, "publish", after=1)
    with pytest.raises(Exception, match="stopped here"):
        run()
    assert read_index_rejects(spark, f"{index}_rejects").count() == 2
    assert read_documents(spark, index).count() == 3
    assert len(run().lastProgress["sources"]) == 1
    assert read_index_rejects(spark, f"{index}_rejects").count() == 3
    assert sorted(v for v, in rows(read_documents(spark, index), "demand_mw")) == [0.0] * 3 + [1.0] * 3


def test_two_versions_at_most(spark, tmp_path):
    topic, out = tmp_path / "topic", str(tmp_path / "out")
    aggregate = None
    for number in range(20):
        add_file(spark, topic, reading(DAY + timedelta(minutes=number * 5)))
    aggregate = regional_window(parse_readings(message_stream(spark, topic)))
    schema = flat_window(aggregate).schema
    assert read_version(spark, out, schema).count() == 0
    run = Run("whole", str(tmp_path / "cp"), "complete", None, 2)
    query = write_windows(aggregate, out, run)
    query.awaitTermination()
    assert len(names_in(spark, f"{out}/{DATA}")) == 2
    assert current(spark, out)["batch"] >= 19
    assert read_version(spark, out, schema).count() == 20


def test_rollup_loses_no_late_row_and_survives_a_stop_between_its_tables(spark, tmp_path, monkeypatch):
    topic, out = tmp_path / "topic", str(tmp_path / "out")
    for minutes in (120, 180, 3, 240, 4):
        add_file(spark, topic, reading(DAY + timedelta(minutes=minutes), demand=float(minutes)))

    def run():
        stream = parse_readings(message_stream(spark, topic), fields=WINDOW_FIELDS)
        query = write_rollup(stream, out, Run("rollup", str(tmp_path / "cp")))
        query.awaitTermination()
        return query

    failing_once(monkeypatch, merge_table, "publish", after=5)  # the hourly table of batch 2
    with pytest.raises(Exception, match="stopped here"):
        run()
    assert len(run().lastProgress["sources"]) == 1
    rollup = Rollup(out)
    five = rows(rollup.five_minutes(spark), "window_start", "avg_demand_mw", "record_count")
    assert [(t.strftime("%H:%M"), avg, n) for t, avg, n in five] == [
        ("10:00", 3.5, 2), ("12:00", 120.0, 1), ("13:00", 180.0, 1), ("14:00", 240.0, 1),
    ]
    hourly = rows(rollup.hourly(spark), "window_start", "hourly_peak_demand")
    assert [(t.strftime("%H:%M"), peak) for t, peak in hourly] == [
        ("10:00", 4.0), ("12:00", 120.0), ("13:00", 180.0), ("14:00", 240.0),
    ]


def test_new_jobs_on_files(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for hour in range(3):
        send(spark, topic, 60 * hour)
    base = ["--files", "--checkpoints", str(tmp_path / "cp"), "--topic", topic, "--output"]
    await_all(spark, start(spark, ["processor", *base, str(tmp_path / "p"), "--windows", str(tmp_path / "w"), "--mode", "rollup", "--key", "grid_id"]))
    assert Rollup(str(tmp_path / "w")).hourly(spark).count() == 3
    assert spark.read.parquet(str(tmp_path / "p")).where("key LIKE 'WEST-GRID%'").count() == 18
    await_all(spark, start(spark, ["spikes", *base, str(tmp_path / "s")]))
    await_all(spark, start(spark, ["indexer", *base, str(tmp_path / "i")]))
    assert read_documents(spark, str(tmp_path / "i")).count() == 15
    assert read_index_rejects(spark, str(tmp_path / "i_rejects")).count() == 3


def test_packing_as_the_stream_goes_keeps_few_parts_and_rewrites_little(spark, tmp_path):
    schema = spark.range(1).schema
    table = FanOut(str(tmp_path / "t"), schema, pack_every=2)
    written = 0
    for number in range(24):
        commit_batch(spark.range(number * 50, number * 50 + 50).withColumn("target", F.lit("x")).coalesce(1), number, table)
        parts = current(spark, table.location)["parts"]
        assert len(parts) <= 6
        written += parts[-1].startswith("g")
    assert written >= 6
    assert [r.id for r in read_target(spark, table, "x").orderBy("id").collect()] == list(range(24 * 50))
