"""Demand spikes on a stream without a baseline made beforehand, by keyed state with timers.

The state of a region and hour is its running sum and count of demand and its readings so far,
in the state store. It is dealt out by a hash of the reading, so that a hot hour is many states.
When the watermark has passed the hour, the timers of all its states fire in one micro-batch,
which adds up the totals and compares the readings with the hour's final average. A reading of
an hour that is closed already comes out as late.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.schemas import struct_of
from wattspan.sinks.fanout import TARGET, FanOut, commit_batch
from wattspan.streaming.control import Run

if TYPE_CHECKING:
    import pandas as pd

HOUR_MS = 3_600_000
SPIKE, LATE = "spike", "late"
# What comes out of the state: totals of a share of an hour, its readings, late readings.
TOTAL, HELD = "total", "held"
# States of one region and hour.
SHARES = 16
# Readings that come out of the state at once.
AT_ONCE = 10_000
HELD_SCHEMA = struct_of({"grid_id": "string", "micros": "long", "demand_mw": "double"})
STATE_OUTPUT = struct_of(
    {
        "kind": "string",
        "region": "string",
        "hour_ms": "long",
        "grid_id": "string",
        "micros": "long",
        "demand_mw": "double",
        "n": "long",
    }
)
SPIKE_SCHEMA = struct_of(
    {
        "region": "string",
        "grid_id": "string",
        "timestamp": "timestamp",
        "demand_mw": "double",
        "hourly_avg_demand_mw": "double",
    }
)


class HourReadings(StatefulProcessor):
    """Holds a share of the readings of one region and hour until it is over."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", struct_of({"total": "double", "n": "long"}))
        self.held = handle.getListState("held", HELD_SCHEMA)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        region, hour_ms, _ = key
        if hour_ms + HOUR_MS <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield _output(LATE, region, hour_ms, part.grid_id, part.micros, part.demand_mw)
            return
        known = self.totals.get() if self.totals.exists() else None
        if known is None:
            self.handle.registerTimer(hour_ms + HOUR_MS)
        total, n = known or (0.0, 0)
        for part in rows:
            # A reading without demand is no spike and counts for no average.
            kept = part[part.demand_mw.notna()]
            total, n = total + float(kept.demand_mw.sum()), n + len(kept)
            if len(kept):
                numbers = zip(kept.grid_id, kept.micros, kept.demand_mw)
                self.held.appendList([(grid, int(micros), float(mw)) for grid, micros, mw in numbers])
        self.totals.update((total, n))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        region, hour_ms, _ = key
        total, n = self.totals.get()
        yield _output(TOTAL, region, hour_ms, [None], [None], [total], n)
        found: list[tuple] = []
        for reading in self.held.get() if n else ():
            found.append(tuple(reading))
            if len(found) == AT_ONCE:
                yield _output(HELD, region, hour_ms, *zip(*found))
                found = []
        if found:
            yield _output(HELD, region, hour_ms, *zip(*found))
        self.held.clear()
        self.totals.clear()

    def close(self) -> None:
        pass


def _output(kind, region, hour_ms, grid_ids, micros, demand, n=None) -> pd.DataFrame:
    import pandas as pd

    count = len(list(demand))
    columns = {
        "kind": pd.Series([kind] * count, dtype=object),
        "region": pd.Series([region] * count, dtype=object),
        "hour_ms": pd.Series([hour_ms] * count, dtype="Int64"),
        "grid_id": pd.Series(list(grid_ids), dtype=object),
        "micros": pd.Series(list(micros), dtype="Int64"),
        "demand_mw": pd.Series(list(demand), dtype="float64"),
        "n": pd.Series([n] * count, dtype="Int64"),
    }
    return pd.DataFrame(columns)


def closed_hours(readings: DataFrame, delay: str = "10 minutes", shares: int = SHARES) -> DataFrame:
    """A stream of the readings and totals of hours as they close, and of late readings.

    ``delay`` is how long an hour waits for readings after its end. Readings without a time
    are in no hour.
    """
    timed = readings.where("timestamp IS NOT NULL").withWatermark("timestamp", delay)
    micros = F.unix_micros("timestamp")
    # The event time goes on as a number: by the column itself Spark would drop late rows.
    slim = timed.select(
        "region",
        F.unix_millis(F.date_trunc("hour", "timestamp")).alias("hour_ms"),
        F.pmod(F.xxhash64("grid_id", micros), F.lit(shares)).alias("share"),
        "grid_id",
        micros.alias("micros"),
        "demand_mw",
    )
    return slim.groupBy("region", "hour_ms", "share").transformWithStateInPandas(
        statefulProcessor=HourReadings(),
        outputStructType=STATE_OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    )


def settled(rows: DataFrame, multiplier: float) -> DataFrame:
    """Spikes and late readings, by ``target``, among the rows of one micro-batch.

    All shares of an hour close in the same micro-batch, so its average is final. Late readings
    have no average.
    """
    same_hour = ["region", "hour_ms"]
    totals = rows.where(F.col("kind") == TOTAL).groupBy(*same_hour)
    average = totals.agg((F.sum("demand_mw") / F.sum("n")).alias("hourly_avg_demand_mw"))
    average = average.withColumnsRenamed({"region": "of_region", "hour_ms": "of_hour"})
    held = rows.where(F.col("kind") == HELD)
    mine = F.col("region").eqNullSafe(F.col("of_region")) & (F.col("hour_ms") == F.col("of_hour"))
    above = F.col("demand_mw") > multiplier * F.col("hourly_avg_demand_mw")
    spikes = held.join(average, mine).where(above).withColumn(TARGET, F.lit(SPIKE))
    late = rows.where(F.col("kind") == LATE).withColumns(
        {"hourly_avg_demand_mw": F.lit(None).cast("double"), TARGET: F.lit(LATE)}
    )
    names = ["region", "grid_id", "micros", "demand_mw", "hourly_avg_demand_mw", TARGET]
    both = spikes.select(names).unionByName(late.select(names))
    return both.withColumn("timestamp", F.timestamp_micros("micros")).select(*SPIKE_SCHEMA.names, TARGET)


def spike_table(location: str) -> FanOut:
    """Where :func:`write_live_spikes` puts spikes and late readings."""
    return FanOut(location, SPIKE_SCHEMA)


def write_live_spikes(
    readings: DataFrame,
    location: str,
    run: Run,
    multiplier: float | None = None,
    delay: str = "10 minutes",
    cfg: EngineConfig = DEFAULT_CONFIG,
) -> StreamingQuery:
    """Stream readings into :func:`spike_table`: spikes once their hour is over, late readings."""
    limit = cfg.demand_spike_multiplier if multiplier is None else multiplier
    table, writer = spike_table(location), run.checkpoint

    def commit(batch: DataFrame, batch_id: int) -> None:
        # Used for totals and for readings, but taken out of the state once.
        kept = batch.persist()
        try:
            commit_batch(settled(kept, limit), batch_id, table, writer)
        finally:
            kept.unpersist()

    return run.start(closed_hours(readings, delay), lambda w: w.foreachBatch(commit))
