"""Benchmark of the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` (default sf 0.1) on ``local[BENCH_CPUS]``. Every query is
run to its last row into Spark's no-op sink; the time is the best of
``BENCH_RUNS`` after one warm-up of the session. ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from wattspan.plans import catalog, telemetry
from wattspan.session import build_session, work_path
from wattspan.sinks import write_lake
from wattspan.sources import read_lake
from wattspan.streaming.control import Run
from wattspan.streaming.pipelines import WINDOW_STATE_PARTITIONS, write_windows

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "window_5min",
    "window_hourly",
    "demand_by_region",
    "carbon_heatmap",
    "kpi_summary",
    "gen_by_source",
    "critical_alerts",
    "flatten",
    "upsert_latest",
    "quality_report",
    "demand_spikes",
)


def run_whole(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action: Callable[[], None], runs: int = RUNS) -> float:
    times = []
    for _ in range(runs):
        begin = time.perf_counter()
        action()
        times.append(time.perf_counter() - begin)
    return round(min(times), 3)


def main() -> None:
    spark = build_session(
        "wattspan-bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_whole(catalog.QUERIES["window_5min"](spark, SF_DIR))

    seconds = {
        name: best(lambda name=name: run_whole(catalog.QUERIES[name](spark, SF_DIR)))
        for name in HEADLINE
    }

    # The lake is timed apart: on a local disk it measures the making of files,
    # one per hour and region, more than Spark.
    lake, readings = work_path(spark, "bench-lake"), telemetry.readings(spark, SF_DIR)
    extra = {"lake_write_sec": best(lambda: write_lake(readings, lake), runs=1)}
    week = read_lake(spark, lake, "2024-01-08", "2024-01-15", ["West"])
    extra["lake_read_week_region_sec"] = best(lambda: run_whole(week), runs=1)

    stream = catalog.hourly_trend(telemetry.stream_readings(spark, SF_DIR))
    run = Run(
        "bench", work_path(spark, "checkpoints"), "complete", None, WINDOW_STATE_PARTITIONS
    )
    query = write_windows(stream, work_path(spark, "bench-stream"), run)
    query.awaitTermination()
    rates = [p["processedRowsPerSecond"] for p in query.recentProgress if p["numInputRows"]]

    events = telemetry.read_events(spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": events,
                "events_per_sec": {n: round(events / s) for n, s in seconds.items()},
                "stream_rows_per_sec": round(max(rates)) if rates else None,
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
