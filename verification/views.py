"""The flight and timing views over the given tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

FLIGHTS_RAW = """
SELECT yr, mon, dom, carrier, flight_num, origin_id, dest_id, crs_dep_time, cancelled, diverted, dep_delay, arr_delay,
  CAST(CASE WHEN arr_delay >= 15 AND k <> 0 THEN floor(arr_delay / 2) END AS DOUBLE) AS carrier_delay,
  CAST(CASE WHEN arr_delay >= 15 AND k = 4 THEN -1 WHEN arr_delay >= 15 AND k <> 0 THEN floor(arr_delay / 10) END AS DOUBLE) AS weather_delay,
  CAST(CASE WHEN arr_delay >= 15 AND k <> 0 THEN floor(arr_delay / 5) END AS DOUBLE) AS nas_delay,
  CAST(CASE WHEN arr_delay >= 15 AND k > 1 THEN 0 END AS DOUBLE) AS security_delay,
  CAST(CASE WHEN arr_delay >= 15 AND k <> 0 THEN arr_delay - floor(arr_delay / 2) - floor(arr_delay / 10) - floor(arr_delay / 5)
    + CASE WHEN k = 2 THEN 3 WHEN k = 3 THEN -4 ELSE 0 END END AS DOUBLE) AS late_aircraft_delay
FROM (
  SELECT yr, mon, dom, carrier, flight_num, origin_id, dest_id, crs_dep_time, cancelled, diverted, p % 41 AS k,
    CASE WHEN cancelled = 1 AND p % 3 <> 0 THEN NULL ELSE CAST(p % 200 - 30 AS DOUBLE) END AS dep_delay,
    CASE WHEN cancelled = 1 OR diverted = 1 THEN NULL ELSE CAST((p * 7) % 211 - 60 AS DOUBLE) END AS arr_delay
  FROM (
    SELECT CAST(year(l_shipdate) AS INT) AS yr, CAST(month(l_shipdate) AS INT) AS mon, CAST(day(l_shipdate) AS INT) AS dom,
      CASE WHEN l_partkey % 197 = 1 THEN NULL WHEN l_partkey % 200 = 0 THEN 'ZZ'
           ELSE substr('AAASB6DLF9G4HAMQNKOHOOUAWNYX', CAST(2 * (l_partkey % 14) + 1 AS INT), 2) END AS carrier,
      CAST(l_partkey % 50 AS INT) AS flight_num, CAST(l_suppkey % 5 AS INT) AS origin_id, CAST(l_linenumber % 3 AS INT) AS dest_id,
      CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 211 = 0 THEN -50
           ELSE CAST((l_orderkey % 25) * 100 + (l_linenumber * 9) % 64 AS INT) END AS crs_dep_time,
      CASE WHEN l_orderkey % 37 = 0 THEN 1 ELSE 0 END AS cancelled,
      CASE WHEN l_orderkey % 53 = 0 THEN 1 ELSE 0 END AS diverted,
      CAST(floor(l_extendedprice) AS BIGINT) AS p
    FROM lineitem) a) b
"""

FLIGHTS = """
SELECT yr, mon, dom, carrier, crs_dep_time, dep_delay, arr_delay, cancelled, diverted,
  coalesce(carrier_delay, 0.0E0) AS carrier_delay, coalesce(weather_delay, 0.0E0) AS weather_delay, coalesce(nas_delay, 0.0E0) AS nas_delay,
  coalesce(security_delay, 0.0E0) AS security_delay, coalesce(late_aircraft_delay, 0.0E0) AS late_aircraft_delay
FROM flights_raw WHERE carrier IS NOT NULL
"""

TLOG = """
SELECT CAST(event_id % 4 + 1 AS INT) AS worker_count,
  CASE event_type WHEN 'click' THEN 'Q1' WHEN 'view' THEN 'Q1' WHEN 'signup' THEN 'Q2' WHEN 'error' THEN 'Q2' ELSE 'Q3' END AS query,
  CASE WHEN user_id % 2 = 0 THEN 'df' ELSE 'rdd' END AS impl,
  CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'all_airlines_computation_s' WHEN 1 THEN 'top10_computation_s' ELSE 'end_to_end_s' END AS phase,
  event_id AS run_id, CAST(floor(value * 8) AS DOUBLE) / 8 AS time_s
FROM events
"""

# The same log over every phase name, one unknown phase and an iteration number.
PHASE_LOG = """
SELECT CAST(event_id % 4 + 1 AS INT) AS worker_count,
  CASE event_type WHEN 'click' THEN 'Q1' WHEN 'view' THEN 'Q1' WHEN 'signup' THEN 'Q2' WHEN 'error' THEN 'Q2' ELSE 'Q3' END AS query,
  CASE WHEN user_id % 2 = 0 THEN 'df' ELSE 'rdd' END AS impl,
  CASE CAST(event_id % 15 AS INT) WHEN 0 THEN 'spark_start_s' WHEN 1 THEN 'loading_s' WHEN 2 THEN 'filtering_s'
    WHEN 3 THEN 'computation_s' WHEN 4 THEN 'all_airlines_computation_s' WHEN 5 THEN 'top10_computation_s'
    WHEN 6 THEN 'computation_percentiles_s' WHEN 7 THEN 'computation_minmax_s' WHEN 8 THEN 'output_s'
    WHEN 9 THEN 'total_s' WHEN 10 THEN 'wall_total_s' WHEN 11 THEN 'end_to_end_s' WHEN 12 THEN 'spark_stop_s'
    WHEN 13 THEN 'end_to_end_s' ELSE 'other_s' END AS phase,
  CAST(floor(event_id / 60) AS BIGINT) AS iteration, CAST(floor(value * 8) AS DOUBLE) / 8 AS time_s
FROM events
"""

# Log rows as untyped text, with the blanks and bad values a CSV file may hold.
TEXT_LOG = """
SELECT event_id,
  CASE WHEN event_id % 13 = 0 THEN 'bad' WHEN event_id % 17 = 0 THEN ' ' ELSE concat(' ', CAST(event_id % 4 + 1 AS VARCHAR(20))) END AS worker_count,
  CASE WHEN event_type = 'click' THEN ' q1 ' WHEN event_type = 'view' THEN 'Q1' WHEN event_type = 'signup' THEN 'q2' WHEN event_type = 'error' THEN 'Q2 ' ELSE 'q3' END AS query,
  CASE WHEN user_id % 2 = 0 THEN ' DF' ELSE 'Rdd ' END AS impl,
  CASE CAST(event_id % 4 AS INT) WHEN 0 THEN ' end_to_end_s' WHEN 1 THEN 'computation_s ' WHEN 2 THEN 'computation_percentiles_s' ELSE 'loading_s' END AS phase,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR(20)) END AS iteration,
  CASE WHEN event_id % 3 = 1 THEN CAST(event_id AS VARCHAR(20)) ELSE '' END AS iteration_idx,
  CASE WHEN event_id % 3 = 2 AND event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR(20)) END AS run,
  CASE WHEN event_id % 10 = 0 THEN 'bad' WHEN event_id % 11 = 0 THEN '' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR(20)) END AS time_s
FROM events
"""
