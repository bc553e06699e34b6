"""SQL of the stand-in tables and of the warehouse, for the checks (DuckDB dialect)."""

from __future__ import annotations

from lakestrata.functions.codes import WEATHER_CODES


def settled(expr: str, digits: int = 2) -> str:
    """Round half up in decimal after dropping noise beyond ten digits."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return settled(f"({part}) * 100.0::DOUBLE / nullif({whole}, 0)")


KEY = ("VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, PULocationID, DOLocationID, trip_distance, "
       "total_amount")
MINUTE = "o_orderdate + to_minutes(o_orderkey % 1440)"

_TRIPS = f"""
deliveries AS (
  SELECT l.*, o.o_orderkey, o.o_orderdate, c.c_nationkey, s.s_nationkey,
         unnest(CASE WHEN l_returnflag = 'A' THEN [0, 1, 1] ELSE [0] END) AS delivery,
         {MINUTE} AS pickup
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey
       JOIN supplier s ON l_suppkey = s_suppkey),
timed AS (
  SELECT *, pickup + to_seconds(10 * date_diff('day', o_orderdate, l_shipdate)) AS dropoff,
         l_extendedprice / 400 * CASE WHEN l_discount > 0.095 THEN -1 ELSE 1 END AS fare
  FROM deliveries),
trips AS (
  SELECT l_linenumber AS VendorID, pickup AS lpep_pickup_datetime, dropoff AS lpep_dropoff_datetime,
         CASE WHEN l_linestatus = 'F' THEN ' Y' END AS store_and_fwd_flag,
         CASE WHEN l_linenumber < 7 THEN l_linenumber END::BIGINT AS RatecodeID,
         s_nationkey AS PULocationID, c_nationkey AS DOLocationID,
         CASE WHEN l_tax < 0.075 THEN CASE WHEN l_returnflag = 'N' THEN l_linenumber - 1 ELSE l_linenumber END
                                      + delivery END::BIGINT AS passenger_count,
         l_quantity - 1 AS trip_distance, fare AS fare_amount, l_tax AS extra, 0.5::DOUBLE AS mta_tax,
         l_discount * 10 AS tip_amount, 0.0::DOUBLE AS tolls_amount, NULL::DOUBLE AS ehail_fee,
         0.3::DOUBLE AS improvement_surcharge,
         fare * (1 - l_discount) * (1 + l_tax) AS total_amount,
         CASE WHEN l_linenumber <> 5 THEN l_linenumber END::BIGINT AS payment_type,
         CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 END::BIGINT AS trip_type,
         CASE WHEN l_linestatus = 'F' THEN 2.75 END::DOUBLE AS congestion_surcharge,
         0.75::DOUBLE AS cbd_congestion_fee,
         CASE WHEN l_linenumber = 7 THEN 'trips_latest.parquet'
              ELSE 'trips_' || strftime(dropoff, '%Y-%m') || '.parquet' END AS source_file,
         strftime(pickup, '%Y-%m') AS source_month, delivery
  FROM timed)
"""
TRIPS = f"WITH {_TRIPS}"

VALID = """
  lpep_dropoff_datetime >= lpep_pickup_datetime AND fare_amount >= 0 AND total_amount >= 0
  AND trip_distance > 0 AND passenger_count > 0 AND lpep_pickup_datetime >= TIMESTAMP '1996-01-01'
  AND lpep_pickup_datetime <= TIMESTAMP '2000-12-31'
"""
# Re-deliveries differ only in the load time and the passenger count; equal deliveries are the same row.
_SILVER = f"""
ranked_trips AS (
  SELECT *, row_number() OVER (PARTITION BY {KEY}
           ORDER BY delivery DESC, store_and_fwd_flag NULLS LAST, RatecodeID NULLS LAST, passenger_count NULLS LAST,
                    fare_amount, extra, tip_amount, payment_type NULLS LAST, trip_type NULLS LAST,
                    congestion_surcharge NULLS LAST, source_file) AS rn
  FROM trips WHERE {VALID}),
silver AS (
  SELECT row_number() OVER (ORDER BY lpep_pickup_datetime, lpep_dropoff_datetime, VendorID, PULocationID, DOLocationID,
                            trip_distance, total_amount) AS trip_key,
         * EXCLUDE (rn, store_and_fwd_flag, RatecodeID, payment_type, trip_type, congestion_surcharge),
         trim(coalesce(store_and_fwd_flag, 'Unknown')) AS store_and_fwd_flag, coalesce(RatecodeID, -1) AS RatecodeID,
         coalesce(payment_type, -1) AS payment_type, coalesce(trip_type, -1) AS trip_type,
         coalesce(congestion_surcharge, 0.0::DOUBLE) AS congestion_surcharge
  FROM ranked_trips WHERE rn = 1)
"""
SILVER = f"WITH {_TRIPS}, {_SILVER}"

TITLE = "array_to_string(list_transform(string_split(lower(trim({0})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"

_ZONES = f"""
zones AS (
  SELECT CASE WHEN n_nationkey = 24 THEN 'n/a' ELSE n_nationkey::VARCHAR END AS id_text, '  ' || r_name || ' ' AS b,
         n_name AS z, CASE n_regionkey WHEN 0 THEN 'Boro Zone' WHEN 1 THEN ' Yellow Zone' WHEN 2 THEN 'Airports'
                      WHEN 3 THEN 'EWR' ELSE 'N/A' END AS s
  FROM nation JOIN region ON n_regionkey = r_regionkey),
silver_zones AS (
  SELECT try_cast(id_text AS INTEGER) AS location_id, {TITLE.format('b')} AS borough, {TITLE.format('z')} AS zone,
         trim(s) AS service_zone
  FROM zones WHERE try_cast(id_text AS INTEGER) IS NOT NULL),
location AS (SELECT row_number() OVER (ORDER BY location_id) AS location_key, * FROM silver_zones)
"""
ZONES = f"WITH {_ZONES}"

_CODES = " ".join(f"WHEN {code} THEN '{text}'" for code, text in WEATHER_CODES.items())
_WEATHER = f"""
readings AS (
  SELECT date_trunc('hour', {MINUTE}) AS ts, (o_custkey % 40 - 5)::DOUBLE AS temperature_2m,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE o_orderkey % 11 END::DOUBLE AS precipitation,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 0.7 ELSE 0.0 END::DOUBLE AS snowfall,
         (o_custkey % 30)::DOUBLE AS wind_speed_10m,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 71 WHEN '3-MEDIUM' THEN 3
              WHEN '4-NOT SPECIFIED' THEN 61 ELSE 100 END::BIGINT AS weather_code, o_orderkey % 100000 AS days_late,
         o_orderkey // 100000 AS minutes_late
  FROM orders),
silver_weather AS (
  SELECT ts AS "timestamp", temperature_2m, precipitation, precipitation AS rain, snowfall, wind_speed_10m,
         weather_code
  FROM readings QUALIFY row_number() OVER (PARTITION BY ts ORDER BY days_late DESC, minutes_late DESC) = 1),
weather AS (
  SELECT row_number() OVER (ORDER BY "timestamp") AS weather_key, "timestamp" AS weather_datetime, temperature_2m,
         precipitation, rain, snowfall, wind_speed_10m, weather_code::INTEGER AS weather_code,
         CASE weather_code {_CODES} ELSE 'Unknown' END AS weather_condition
  FROM silver_weather)
"""
WEATHER = f"WITH {_WEATHER}"

_CALENDAR = """
span AS (SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders),
hours AS (SELECT unnest(generate_series(first, last, INTERVAL 1 HOUR)) AS t FROM span),
calendar AS (
  SELECT 0::BIGINT AS datetime_key, TIMESTAMP '1900-01-01' AS full_datetime, DATE '1900-01-01' AS "date", 0 AS "day",
         'Unknown' AS day_name, 0 AS "hour", 'Unknown' AS hour_label, 'Unknown' AS time_period, 0 AS week_of_year,
         0 AS "month", 'Unknown' AS month_name, 0 AS "quarter", 1900 AS "year", false AS is_weekend,
         false AS is_rush_hour, 0 AS day_of_week
  UNION ALL
  SELECT date_diff('hour', TIMESTAMP '1900-01-01', t), t, t::DATE, day(t)::INTEGER, strftime(t, '%A'), hour(t)::INTEGER,
         strftime(t, '%I %p'),
         CASE WHEN hour(t) BETWEEN 5 AND 11 THEN 'Morning' WHEN hour(t) BETWEEN 12 AND 16 THEN 'Afternoon'
              WHEN hour(t) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Night' END,
         week(t)::INTEGER, month(t)::INTEGER, strftime(t, '%B'), quarter(t)::INTEGER, year(t)::INTEGER,
         dayofweek(t) IN (0, 6), dayofweek(t) BETWEEN 1 AND 5 AND hour(t) IN (7, 8, 9, 16, 17, 18, 19),
         dayofweek(t)::INTEGER + 1
  FROM hours)
"""
CALENDAR = f"WITH {_CALENDAR}"

_FACT = """
joined AS (
  SELECT VendorID AS vendor_id, RatecodeID AS ratecode_id, store_and_fwd_flag, trip_type,
         p.datetime_key AS pickup_datetime_key, d.datetime_key AS dropoff_datetime_key,
         lp.location_key AS pickup_location_key, ld.location_key AS dropoff_location_key, w.weather_key,
         lpep_pickup_datetime, lpep_dropoff_datetime, PULocationID, DOLocationID, payment_type, passenger_count,
         trip_distance,
         CAST(round(CAST((epoch(lpep_dropoff_datetime) - epoch(lpep_pickup_datetime)) / 60 AS DECIMAL(18,8)), 2)
              AS DOUBLE) AS trip_duration_minutes,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge,
         congestion_surcharge, cbd_congestion_fee, total_amount
  FROM silver s
  JOIN calendar p ON date_trunc('hour', lpep_pickup_datetime) = p.full_datetime
  JOIN calendar d ON date_trunc('hour', lpep_dropoff_datetime) = d.full_datetime
  JOIN location lp ON PULocationID = lp.location_id JOIN location ld ON DOLocationID = ld.location_id
  LEFT JOIN weather w ON date_trunc('hour', lpep_pickup_datetime) = w.weather_datetime),
fact AS (
  SELECT row_number() OVER (ORDER BY lpep_pickup_datetime, lpep_dropoff_datetime, vendor_id, PULocationID, DOLocationID,
                            trip_distance, total_amount) AS trip_key, *
  FROM joined)
"""
FACT = f"WITH {_TRIPS}, {_SILVER}, {_ZONES}, {_WEATHER}, {_CALENDAR}, {_FACT}"


def check(name: str, kind: str, records: str, failures: str, expected: str = "'0'", actual: str | None = None,
          base: str | None = None, severity: str = "") -> str:
    """One check as a SELECT without FROM."""
    return (f"SELECT '{name}' AS check_name, '{kind}' AS check_type, '{severity}' AS severity, "
            f"({records})::BIGINT AS records_checked, ({failures})::BIGINT AS failures, "
            f"({expected})::VARCHAR AS expected_value, ({actual or failures})::VARCHAR AS actual_value, "
            f"({base or records})::BIGINT AS base")


def rows(table: str, name: str, kind: str, failing: str, expected: str = "'0'", severity: str = "") -> str:
    return check(name, kind, "count(*)", f"count(*) FILTER (WHERE {failing})", expected, severity=severity) \
        + f" FROM {table}"


def suite(checks: list[str], status: str, columns: str, table: str = "") -> str:
    body = "\nUNION ALL ".join(checks)
    return f""", results AS ({body}),
measured AS (SELECT *, {pct('failures', 'base')} AS failure_pct FROM results)
SELECT {columns.replace('{table}', f"'{table}' AS table_name")},
       CASE WHEN failures = 0 THEN 'PASS' {status} ELSE 'FAIL' END AS status
FROM measured"""


SIMPLE = "check_name, failures AS failed_rows"
SOURCE = ("check_name, check_type, records_checked, failures AS affected_rows, "
          "printf('%.2f%%', failure_pct) AS affected_percentage")
TABLE = "{table}, check_name, check_type, records_checked, failures, expected_value, failure_pct"
TABLE_ACTUAL = TABLE.replace("expected_value", "expected_value, actual_value")


def warn(kinds: str, limit: int, column: str = "check_type") -> str:
    return f"WHEN {column} IN ({kinds}) AND failure_pct <= {limit} THEN 'WARN'"


SOURCE_STATUS = ("WHEN severity = 'MONTHLY_COUNT' THEN 'PASS' " + warn("'COMPOSITE_KEY'", 1, "severity") + " "
                 + warn("'OTHER_DQ'", 2, "severity"))
