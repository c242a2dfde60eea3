"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

# One reading per event; the same formulas as plans/telemetry.py.
READINGS = """
WITH ev AS (
  SELECT event_id AS i, ts AS "timestamp", user_id % 5 AS u,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         CAST(hour(ts) AS INTEGER) AS hour_of_day
  FROM events
), placed AS (
  SELECT *,
         CASE u WHEN 0 THEN 'Northeast' WHEN 1 THEN 'Southeast' WHEN 2 THEN 'Midwest'
                WHEN 3 THEN 'Southwest' ELSE 'West' END AS region,
         CASE u WHEN 0 THEN 8000e0 WHEN 1 THEN 12000e0 WHEN 2 THEN 10000e0
                WHEN 3 THEN 7000e0 ELSE 9000e0 END AS base
  FROM ev
), supply AS (
  SELECT *,
         base * 0.5e0 + k * 16 + (i % 7) * 8 AS dem0,
         CASE WHEN hour_of_day < 6 OR hour_of_day > 20 THEN 0e0 ELSE base / 16 END AS solar,
         base / 8 + k AS wind, base / 8 AS nuclear, base / 16 AS hydro
  FROM placed
), rest AS (
  SELECT *, greatest(0e0, dem0 - (solar + wind + nuclear + hydro)) AS rem FROM supply
), measured AS (
  SELECT i, "timestamp", region, hour_of_day,
         upper(region) || '-GRID-' || CAST(i % 5 + 1 AS VARCHAR) AS grid_id,
         dem0 * CASE WHEN i % 37 = 0 THEN 1.75e0 ELSE 1e0 END AS demand_mw,
         solar, wind, rem * 0.75e0 + (i % 4) * (base / 32) AS gas, rem * 0.25e0 AS coal,
         nuclear, hydro,
         CASE WHEN i % 20 = 0 THEN 60e0 + (k - 50) / 1024e0
              ELSE 60e0 + (k % 10 - 5) / 1024e0 END AS frequency,
         CASE WHEN i % 23 = 0 THEN 320e0 + k / 2e0 ELSE 340e0 + (k % 20) / 2e0 END AS voltage,
         15e0 + (k % 41) / 2e0 AS celsius
  FROM rest
), totals AS (
  SELECT *, solar + wind + gas + coal + nuclear + hydro AS total FROM measured
), mixed AS (
  SELECT *,
         CASE WHEN total > 0 THEN solar / total * 100e0 ELSE 0e0 END AS p_solar,
         CASE WHEN total > 0 THEN wind / total * 100e0 ELSE 0e0 END AS p_wind,
         CASE WHEN total > 0 THEN gas / total * 100e0 ELSE 0e0 END AS p_gas,
         CASE WHEN total > 0 THEN coal / total * 100e0 ELSE 0e0 END AS p_coal,
         CASE WHEN total > 0 THEN nuclear / total * 100e0 ELSE 0e0 END AS p_nuclear,
         CASE WHEN total > 0 THEN hydro / total * 100e0 ELSE 0e0 END AS p_hydro,
         CASE WHEN total > 0 THEN (solar + wind + hydro) / total * 100e0 ELSE 0e0 END AS renewable,
         CASE WHEN demand_mw > 0 THEN (total - demand_mw) / demand_mw * 100e0 ELSE 0e0 END
           AS margin,
         solar * 30e0 + wind * 25e0 + gas * 70e0 + coal * 60e0 + nuclear * 30e0 + hydro * 40e0
           AS cost
  FROM totals
), derived AS (
  SELECT *,
         p_solar * 50e0 / 100e0 + p_wind * 10e0 / 100e0 + p_gas * 450e0 / 100e0
           + p_coal * 920e0 / 100e0 + p_nuclear * 10e0 / 100e0 + p_hydro * 20e0 / 100e0
           AS carbon,
         abs(frequency - 60e0) AS dev,
         voltage < 335e0 OR voltage > 355e0 AS vbad
  FROM mixed
), readings AS (
  SELECT *,
         CASE WHEN dev > 0.025e0 OR margin < 5e0 THEN 'CRITICAL'
              WHEN dev > 0.015e0 OR margin < 10e0 OR vbad THEN 'WARNING'
              ELSE 'NORMAL' END AS alert_level
  FROM derived
)
"""

# A flat reading, with `{ts}` as its time.
FLAT = """
  {ts} AS "timestamp", region, grid_id, demand_mw, total AS total_generation_mw,
  p_solar AS solar_percent, p_wind AS wind_percent, p_gas AS natural_gas_percent,
  p_coal AS coal_percent, p_nuclear AS nuclear_percent, p_hydro AS hydro_percent,
  solar AS solar_mw, wind AS wind_mw, gas AS natural_gas_mw, coal AS coal_mw,
  nuclear AS nuclear_mw, hydro AS hydro_mw,
  frequency AS grid_frequency_hz, voltage AS voltage_kv, carbon AS carbon_intensity_gco2_kwh,
  margin AS reserve_margin_percent, celsius AS temperature_celsius, hour_of_day,
  renewable AS renewable_percentage, cost AS generation_cost_per_hour,
  alert_level <> 'NORMAL' AS is_anomaly, alert_level
"""
FLAT_READING = FLAT.format(ts='"timestamp"')
EPOCH_MS = 'CAST(floor(epoch("timestamp")) AS BIGINT) * 1000'
DOC_ID = f"""region || '_' || grid_id || '_' || CAST({EPOCH_MS} AS VARCHAR)"""

WINDOW_5MIN = """
  SELECT time_bucket(INTERVAL 5 minutes, "timestamp") AS window_start,
         time_bucket(INTERVAL 5 minutes, "timestamp") + INTERVAL 5 minutes AS window_end,
         region, avg(demand_mw) AS avg_demand_mw, max(demand_mw) AS peak_demand_mw,
         min(demand_mw) AS min_demand_mw, avg(frequency) AS avg_frequency_hz,
         round(avg(carbon), 6) AS avg_carbon_intensity,
         round(avg(renewable), 6) AS avg_renewable_percentage,
         CAST(sum(CASE WHEN alert_level <> 'NORMAL' THEN 1 ELSE 0 END) AS BIGINT)
           AS anomaly_count,
         count(*) AS record_count
  FROM readings GROUP BY 1, 2, 3
"""
WINDOW_HOURLY = """
  SELECT date_trunc('hour', "timestamp") AS window_start,
         date_trunc('hour', "timestamp") + INTERVAL 1 hour AS window_end,
         region, avg(demand_mw) AS hourly_avg_demand, max(demand_mw) AS hourly_peak_demand,
         round(avg(renewable), 6) AS hourly_renewable_pct,
         round(avg(carbon), 6) AS hourly_carbon_intensity,
         sum(cost) AS total_generation_cost
  FROM readings GROUP BY 1, 2, 3
"""
ANOMALY_BAND = """CASE WHEN {v} < 5 THEN '0-5' WHEN {v} < 15 THEN '5-15'
  WHEN {v} IS NOT NULL THEN '15-999999' END"""
COST_BAND = """CASE WHEN {v} < 150000 THEN '0-150000' WHEN {v} < 200000 THEN '150000-200000'
  WHEN {v} IS NOT NULL THEN '200000-999999' END"""
RENEWABLE_BAND = """CASE WHEN {v} < 15 THEN '0-15' WHEN {v} < 35 THEN '15-35'
  WHEN {v} < 60 THEN '35-60' WHEN {v} IS NOT NULL THEN '60-100' END"""
RESERVE_BAND = """CASE WHEN {v} < 5 THEN '-999-5' WHEN {v} < 15 THEN '5-15'
  WHEN {v} IS NOT NULL THEN '15-999' END"""

BY_SOURCE = """
, sums AS (
  SELECT sum(solar) AS s1, sum(wind) AS s2, sum(gas) AS s3, sum(coal) AS s4,
         sum(nuclear) AS s5, sum(hydro) AS s6 FROM readings {where}
), long AS (
  SELECT s1 + s2 + s3 + s4 + s5 + s6 AS whole,
         unnest(['Solar', 'Wind', 'Natural_Gas', 'Coal', 'Nuclear', 'Hydro']) AS source,
         unnest([s1, s2, s3, s4, s5, s6]) AS sum_mw
  FROM sums
)
SELECT source, sum_mw, sum_mw / whole * 100e0 AS share_percent FROM long
"""

# The eight faults of the quality queries, by event number.
FAULTS = """
, judged AS (
  SELECT *, CASE i % 50 WHEN 1 THEN 'unparsable_json' WHEN 2 THEN 'empty_message'
                        WHEN 3 THEN 'bad_field_type' WHEN 4 THEN 'unknown_region'
                        WHEN 5 THEN 'frequency_out_of_bounds' WHEN 6 THEN 'missing_key'
                        WHEN 7 THEN 'missing_time'
                        WHEN 8 THEN CASE WHEN hour_of_day < 6 OR hour_of_day > 20
                                         THEN 'solar_at_night' END
            END AS reason
  FROM readings
)
"""

ALERT = """
  region, "timestamp", frequency, margin AS reserve_margin, voltage
  FROM readings WHERE alert_level = 'CRITICAL'
"""
SPIKES = """
, based AS (
  SELECT region, grid_id, "timestamp", demand_mw,
         avg(demand_mw) OVER (PARTITION BY region, date_trunc('hour', "timestamp"))
           AS hourly_avg_demand_mw
  FROM readings
)
SELECT * FROM based WHERE demand_mw > 1.5e0 * hourly_avg_demand_mw
"""

FILED = """SELECT CAST(year("timestamp") AS INTEGER) AS "year",
        CAST(month("timestamp") AS INTEGER) AS "month", CAST(day("timestamp") AS INTEGER) AS "day",
        CAST(hour("timestamp") AS INTEGER) AS "hour", region, count(*) AS record_count"""
UPSERTED = f"""SELECT {FLAT.format(ts=EPOCH_MS)}, {DOC_ID} AS es_id
        FROM (SELECT * REPLACE (demand_mw + CASE WHEN i % 10 = 0 THEN 1e0 ELSE 0e0 END
              AS demand_mw) FROM readings)"""
# An hour is closed when ten minutes after its end have been seen.
CLOSED = """date_trunc('hour', "timestamp") + INTERVAL 1 hour
        <= (SELECT max("timestamp") FROM readings {which}) - INTERVAL 10 minutes"""

BODIES = {
    "stream_live_spikes": SPIKES + " AND " + CLOSED.format(which=""),
    "stream_late_readings": f"""SELECT region, grid_id, "timestamp", demand_mw FROM readings
        WHERE i % 10 = 0 AND {CLOSED.format(which="WHERE i % 10 <> 0")}""",
    "stream_lake_packed": f"SELECT {FLAT_READING} FROM readings",
    "lake_packed_files": f"{FILED}, CAST(1 AS BIGINT) AS files FROM readings GROUP BY ALL",
    "stream_index": UPSERTED,
    "stream_index_all": FAULTS
    + f"""SELECT 'index' AS target, count(DISTINCT {DOC_ID}) AS rows FROM judged
        WHERE reason IS NULL OR reason NOT IN
          ('unparsable_json', 'empty_message', 'missing_key', 'missing_time')
        UNION ALL SELECT 'rejects', count(*) FROM judged
        WHERE reason IN ('unparsable_json', 'empty_message', 'missing_key', 'missing_time')""",
    "console_windows": WINDOW_HOURLY,
    "stream_rollup_5min": WINDOW_5MIN,
    "stream_rollup_hourly": WINDOW_HOURLY,
    "stream_liveness": """SELECT 'stream_liveness' AS query, count(*) AS messages_seen,
        CAST(0 AS BIGINT) AS behind, 'stopped' AS status FROM readings""",
    "stream_source": f"SELECT region AS key, {FLAT_READING} FROM readings",
    "lake_roundtrip": f"""SELECT {FLAT_READING} FROM readings
        WHERE "timestamp" >= TIMESTAMP '2024-01-05 06:30:00'
          AND "timestamp" < TIMESTAMP '2024-01-20 18:00:00' AND region IN ('West', 'Midwest')""",
    "stream_lake": f"SELECT {FLAT_READING} FROM readings",
    "lake_partitions": """SELECT CAST(year("timestamp") AS INTEGER) AS "year",
        CAST(month("timestamp") AS INTEGER) AS "month", CAST(day("timestamp") AS INTEGER) AS "day",
        CAST(hour("timestamp") AS INTEGER) AS "hour", region, count(*) AS record_count
        FROM readings GROUP BY ALL""",
    "to_messages": """SELECT region AS key,
        'timestamp,region,grid_id,demand_mw,total_generation_mw,generation_mix_percent,'
        || 'generation_mw,grid_frequency_hz,voltage_kv,carbon_intensity_gco2_kwh,'
        || 'reserve_margin_percent,temperature_celsius,hour_of_day,renewable_percentage,'
        || 'generation_cost_per_hour,is_anomaly,alert_level' AS field_names,
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", region, grid_id,
        CAST(hour_of_day AS VARCHAR) AS hour_of_day,
        CASE WHEN alert_level <> 'NORMAL' THEN 'true' ELSE 'false' END AS is_anomaly, alert_level,
        demand_mw, frequency AS grid_frequency_hz, coal AS "generation_mw_Coal" FROM readings""",
    "upsert_latest": f"""SELECT {DOC_ID} AS es_id, i AS event_id,
        CAST(CASE WHEN i % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS batch_id, "timestamp",
        demand_mw + CASE WHEN i % 10 = 0 THEN 1e0 ELSE 0e0 END AS demand_mw FROM readings""",
    "stream_upsert": f"""SELECT {FLAT.format(ts=EPOCH_MS)}, {DOC_ID} AS es_id
        FROM (SELECT * REPLACE (demand_mw + CASE WHEN i % 10 = 0 THEN 1e0 ELSE 0e0 END
              AS demand_mw) FROM readings)""",
    "stream_dedupe": f"""SELECT {DOC_ID} AS es_id, "timestamp", region, demand_mw FROM readings""",
    "parse_json": f"SELECT {FLAT_READING} FROM readings",
    "event_time": """SELECT i AS event_id,
        CASE WHEN i % 13 = 0 THEN NULL ELSE "timestamp" END AS "timestamp" FROM readings""",
    "processed_at": "SELECT i AS event_id, true AS is_stamped, true AS after_event FROM readings",
    "epoch_ms": f"SELECT i AS event_id, {EPOCH_MS} AS epoch_ms FROM readings",
    "flatten": f"SELECT {FLAT.format(ts=EPOCH_MS)}, {DOC_ID} AS es_id FROM readings",
    "doc_id": f"SELECT i AS event_id, {DOC_ID} AS es_id FROM readings",
    "carbon": """SELECT i AS event_id, carbon AS carbon_intensity,
        round(carbon, 2) AS carbon_intensity_2 FROM readings""",
    "cost": "SELECT i AS event_id, cost, round(cost, 2) AS cost_2 FROM readings",
    "renewable": """SELECT i AS event_id,
        round((p_solar + p_wind + p_hydro)
              / (p_solar + p_wind + p_gas + p_coal + p_nuclear + p_hydro) * 100e0, 2)
          AS from_mix_2,
        renewable AS from_mw FROM readings""",
    "mix_percent": """SELECT i AS event_id, total AS total_mw, p_solar AS "Solar",
        p_wind AS "Wind", p_gas AS "Natural_Gas", p_coal AS "Coal", p_nuclear AS "Nuclear",
        p_hydro AS "Hydro" FROM readings""",
    "reserve_margin": """SELECT i AS event_id,
        CASE WHEN i % 9 = 0 THEN 0e0 ELSE margin END AS margin FROM readings""",
    "alerts_processor": """SELECT i AS event_id, alert_level <> 'NORMAL' AS is_anomaly, alert_level
        FROM readings""",
    "alerts_producer": """SELECT event_id, alert_level <> 'NORMAL' AS is_anomaly, alert_level FROM (
        SELECT i AS event_id, CASE
          WHEN dev > 0.025e0 OR margin < 5e0 OR (vbad AND dev > 0.015e0) THEN 'CRITICAL'
          WHEN dev > 0.015e0 OR vbad THEN 'WARNING' ELSE 'NORMAL' END AS alert_level
        FROM readings)""",
    "demand_band": """SELECT region, CASE
          WHEN hour_of_day BETWEEN 8 AND 10 OR hour_of_day BETWEEN 18 AND 21 THEN 'peak'
          WHEN hour_of_day BETWEEN 11 AND 17 THEN 'moderate'
          WHEN hour_of_day >= 23 OR hour_of_day <= 6 THEN 'low' ELSE 'normal' END AS band,
        count(*) AS record_count, avg(demand_mw) AS avg_demand_mw FROM readings GROUP BY 1, 2""",
    "weather_adjusted": """SELECT event_id, factor, demand_mw / factor AS adjusted_demand_mw FROM (
        SELECT event_id, demand_mw, CASE WHEN t > 30 THEN 1e0 + (t - 30e0) * 0.02e0
          WHEN t < 5 THEN 1e0 + (5e0 - t) * 0.015e0 ELSE 1e0 END AS factor FROM (
        SELECT i AS event_id, demand_mw,
               celsius - CASE WHEN i % 3 = 0 THEN 20e0 ELSE 0e0 END AS t FROM readings))""",
    "kpi_bands": f"""SELECT CASE WHEN margin >= -999 AND margin < 5 THEN 'low'
          WHEN margin >= 5 AND margin < 15 THEN 'fair'
          WHEN margin >= 15 AND margin <= 999 THEN 'good' END AS reserve_band,
        {RENEWABLE_BAND.format(v="renewable")} AS renewable_band, count(*) AS record_count
        FROM readings GROUP BY 1, 2""",
    "revalidate": """SELECT i AS event_id, true AS total_generation_mw_ok,
        i % 31 <> 0 AS carbon_intensity_gco2_kwh_ok, true AS generation_cost_per_hour_ok,
        true AS renewable_percentage_ok, abs(margin - expected) <= 0.05e0
          AS reserve_margin_percent_ok,
        i % 31 <> 0 AND abs(margin - expected) <= 0.05e0 AS is_consistent,
        expected AS expected_margin FROM (
        SELECT *, (total - sent) / sent * 100e0 AS expected FROM (
        SELECT *, demand_mw * CASE WHEN i % 29 = 0 THEN 1.5e0 ELSE 1e0 END AS sent
        FROM readings))""",
    "window_5min": WINDOW_5MIN,
    "window_hourly": WINDOW_HOURLY,
    "stream_window_5min": WINDOW_5MIN,
    "stream_window_hourly": WINDOW_HOURLY,
    "stream_window_update": WINDOW_HOURLY,
    "stream_window_append": f"""SELECT * FROM ({WINDOW_5MIN})
        WHERE window_end <= (SELECT max("timestamp") FROM readings) - INTERVAL 10 minutes""",
    "kpi_anomalies": f"""SELECT anomalies, {ANOMALY_BAND.format(v="anomalies")} AS band FROM (
        SELECT count(*) AS anomalies FROM readings WHERE alert_level <> 'NORMAL')""",
    "kpi_cost": f"""SELECT round(v, 6) AS avg_cost, {COST_BAND.format(v="v")} AS band FROM (
        SELECT avg(cost) AS v FROM readings)""",
    "kpi_renewable": f"""SELECT round(v, 6) AS avg_renewable,
        {RENEWABLE_BAND.format(v="v")} AS band FROM (SELECT avg(renewable) AS v FROM readings)""",
    "kpi_reserve": f"""SELECT round(v, 6) AS avg_reserve_margin,
        {RESERVE_BAND.format(v="v")} AS band FROM (SELECT avg(margin) AS v FROM readings)""",
    "kpi_summary": f"""SELECT a AS anomalies, round(c, 6) AS avg_cost,
        round(r, 6) AS avg_renewable, round(m, 6) AS avg_reserve_margin,
        {ANOMALY_BAND.format(v="a")} AS anomalies_band, {COST_BAND.format(v="c")} AS avg_cost_band,
        {RENEWABLE_BAND.format(v="r")} AS avg_renewable_band,
        {RESERVE_BAND.format(v="m")} AS avg_reserve_margin_band FROM (
        SELECT count(*) FILTER (WHERE alert_level <> 'NORMAL') AS a, avg(cost) AS c,
               avg(renewable) AS r, avg(margin) AS m FROM readings)""",
    "demand_vs_gen": """SELECT time_bucket(INTERVAL 30 minutes, "timestamp") AS window_start,
        time_bucket(INTERVAL 30 minutes, "timestamp") + INTERVAL 30 minutes AS window_end,
        avg(demand_mw) AS demand, avg(total) AS generation FROM readings GROUP BY 1, 2""",
    "frequency_trend": """SELECT date_trunc('hour', "timestamp") AS window_start,
        date_trunc('hour', "timestamp") + INTERVAL 1 hour AS window_end,
        avg(frequency) AS frequency_hz, 60e0 AS nominal_hz,
        avg(frequency) - 60e0 AS deviation_hz FROM readings GROUP BY 1, 2""",
    "gen_by_source": BY_SOURCE.format(where=""),
    "gen_by_source_region": BY_SOURCE.format(where="WHERE region = 'Southeast'"),
    "demand_by_region": """SELECT region, avg(demand_mw) AS avg_demand_mw FROM readings
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "carbon_heatmap": """SELECT time_bucket(INTERVAL 6 hours, "timestamp") AS window_start,
        time_bucket(INTERVAL 6 hours, "timestamp") + INTERVAL 6 hours AS window_end, region,
        round(avg(carbon), 6) AS carbon_intensity FROM readings
        WHERE region IN (SELECT DISTINCT region FROM readings ORDER BY region LIMIT 10)
        GROUP BY 1, 2, 3""",
    "carbon_heatmap_wide": """SELECT date_trunc('day', "timestamp") AS window_start,
        date_trunc('day', "timestamp") + INTERVAL 1 day AS window_end, """
    + ", ".join(
        f"""round(avg(carbon) FILTER (WHERE region = '{r}'), 6) AS "{r}" """
        for r in ("Northeast", "Southeast", "Midwest", "Southwest", "West")
    )
    + " FROM readings GROUP BY 1, 2",
    "hourly_baseline": """SELECT region, date_trunc('hour', "timestamp") AS hour_start,
        avg(demand_mw) AS hourly_avg_demand_mw FROM readings GROUP BY 1, 2""",
    "region_options": "SELECT DISTINCT region FROM readings ORDER BY region LIMIT 10",
    "last_15m": f"""SELECT {FLAT_READING} FROM readings
        WHERE "timestamp" BETWEEN (SELECT max("timestamp") FROM readings) - INTERVAL 15 minutes
                              AND (SELECT max("timestamp") FROM readings)""",
    "critical_alerts": f"SELECT {ALERT}",
    "critical_alert_count": """SELECT count(*) AS critical_alerts FROM readings
        WHERE alert_level = 'CRITICAL'""",
    "first_alerts": f"SELECT {ALERT} ORDER BY 2, 1, 3, 4, 5 LIMIT 5",
    "stream_alerts": f"SELECT {ALERT}",
    "quality_report": FAULTS
    + "SELECT count(*) AS messages, count(*) FILTER (WHERE reason IS NULL) AS accepted, "
    + ", ".join(
        f"count(*) FILTER (WHERE reason = '{r}') AS {r}"
        for r in (
            "empty_message",
            "unparsable_json",
            "bad_field_type",
            "missing_key",
            "missing_time",
            "unknown_region",
            "frequency_out_of_bounds",
            "solar_at_night",
        )
    )
    + " FROM judged",
    "rejects": FAULTS
    + """SELECT reason AS reject_reason, count(*) AS messages,
        count(*) FILTER (WHERE reason <> 'empty_message') AS with_text
        FROM judged WHERE reason IS NOT NULL GROUP BY 1""",
    "stream_lake_all": FAULTS
    + """SELECT CASE WHEN reason IS NULL OR reason IN ('unknown_region',
          'frequency_out_of_bounds', 'solar_at_night') THEN 'lake' ELSE 'rejects' END AS target,
        reason AS reject_reason, count(*) AS messages FROM judged GROUP BY 1, 2""",
    "accepted": FAULTS
    + f"""SELECT {FLAT_READING} FROM (
        SELECT * REPLACE (CASE WHEN i % 50 = 8 THEN 10e0 ELSE solar END AS solar)
        FROM judged WHERE reason IS NULL)""",
    "validate_source": """SELECT CAST(least(count(*), 5) AS BIGINT) AS messages_seen,
        count(*) >= 1 AS is_live FROM readings""",
    "demand_spikes": SPIKES,
    "stream_demand_spikes": SPIKES,
}


def oracle_sql() -> dict[str, str]:
    return {name: READINGS + body for name, body in BODIES.items()}
