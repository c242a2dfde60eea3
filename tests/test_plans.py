"""Physical plans, and results that must not depend on the plan chosen."""

from datetime import datetime

from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattspan.operators import (
    demand_spikes,
    latest_by_key,
    parse_readings,
    regional_window,
    split_rejects,
    time_range,
    to_messages,
)
from wattspan.operators.spikes import join_baseline, stage_baseline
from wattspan.plans import catalog
from wattspan.plans.telemetry import readings
from wattspan.session import session_conf
from wattspan.sinks import write_lake
from wattspan.sources import read_lake


def test_lake_read_prunes_folders_and_columns(spark, telemetry, tmp_path):
    path = str(tmp_path / "lake")
    day = telemetry.where("timestamp < '2024-01-03'")
    write_lake(day, path)
    since, until = "2024-01-01 05:30:00", datetime(2024, 1, 2, 7, 15)
    part = read_lake(spark, path, since, until, ["West"])
    plan = plan_of(part.select("timestamp", "demand_mw"))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "PushedFilters: [IsNotNull(timestamp)" in plan
    assert "ReadSchema: struct<timestamp:timestamp,demand_mw:double>" in plan
    expected = telemetry.where(
        F.col("timestamp").between(since, "2024-01-02 07:14:59.999999") & (F.col("region") == "West")
    )
    assert rows(part) == rows(expected)
    # Files outside the range are not opened: each holds one hour of one region.
    execution = part._jdf.queryExecution()
    execution.toRdd().count()
    scan = execution.executedPlan().collectLeaves().apply(0)
    hours = expected.select(F.date_trunc("hour", "timestamp")).distinct().count()
    assert hours <= scan.metrics().apply("numFiles").value() <= hours + 2
    assert rows(read_lake(spark, path)) == rows(day)


def test_lake_limits_with_an_offset(spark, telemetry, tmp_path):
    path = str(tmp_path / "lake")
    write_lake(telemetry.where("timestamp < '2024-01-02'"), path)
    shifted = read_lake(spark, path, since="2024-01-01T12:00:00+02:00")
    assert shifted.count() == telemetry.where(
        "timestamp >= '2024-01-01 10:00:00' AND timestamp < '2024-01-02'"
    ).count()


def test_no_python_workers_in_any_plan(spark, sf_dir):
    for name, query in catalog.QUERIES.items():
        if name.startswith("stream") or "lake" in name:
            continue
        plan = plan_of(query(spark, sf_dir))
        assert "Python" not in plan and "Arrow" not in plan, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_aggregates_combine_before_the_shuffle(telemetry):
    plan = plan_of(regional_window(telemetry))
    assert plan.count("Exchange") == 1
    assert "partial_avg" in plan


def test_json_is_parsed_once(spark, telemetry, tmp_path):
    path = str(tmp_path / "messages")
    to_messages(telemetry).write.parquet(path)
    messages = spark.read.parquet(path)
    assert plan_of(regional_window(parse_readings(messages))).count("from_json") == 1
    good, bad = split_rejects(messages)
    assert plan_of(good).count("from_json") == 1
    assert plan_of(bad).count("from_json") == 1


def test_time_range_reaches_the_scan(spark, sf_dir):
    recent = time_range(readings(spark, sf_dir), "2024-01-15 12:00:00")
    assert "GreaterThanOrEqual(ts,2024-01-15 11:45:00.0)" in plan_of(recent)


def test_latest_is_chosen_before_the_shuffle(telemetry):
    plan = plan_of(latest_by_key(telemetry, ["grid_id"], ["timestamp"]))
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:]
    newest = rows(latest_by_key(telemetry, ["grid_id"], ["timestamp"]), "grid_id", "timestamp")
    assert newest == rows(telemetry.groupBy("grid_id").agg(F.max("timestamp")))


def brute_force_spikes(df, multiplier):
    hour = Window.partitionBy("region", F.date_trunc("hour", "timestamp"))
    named = df.withColumn("hourly_avg_demand_mw", F.avg("demand_mw").over(hour))
    return named.where(F.col("demand_mw") > multiplier * F.col("hourly_avg_demand_mw"))


def test_spikes_equal_brute_force_on_both_joins(spark, telemetry):
    expected = rows(brute_force_spikes(telemetry, 1.2))
    assert expected
    columns = telemetry.columns + ["hourly_avg_demand_mw"]
    assert rows(demand_spikes(telemetry, 1.2), *columns) == expected
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert rows(demand_spikes(telemetry, 1.2), *columns) == expected


def test_a_staged_baseline_is_broadcast_by_its_size(spark, telemetry, tmp_path):
    baseline = stage_baseline(telemetry, str(tmp_path / "b"))
    joined = join_baseline(telemetry, baseline)
    assert "BroadcastHashJoin" in plan_of(joined)
    assert joined.count() == telemetry.count()
