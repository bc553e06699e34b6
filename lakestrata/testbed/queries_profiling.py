"""Source profiles over the test tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.operators.duplicates import exact_duplicate_summary
from lakestrata.profiling import gaps, profile
from lakestrata.profiling.key_search import minimal_keys
from lakestrata.profiling.sketches import distinct_estimates, error_bound, store_sketches
from lakestrata.session import new_path
from lakestrata.sources.discovery import month_in
from lakestrata.testbed.registry import query
from lakestrata.testbed.sql import TRIPS, WEATHER, pct
from lakestrata.testbed.standins import load, table

MEASURES = ["trip_distance", "fare_amount", "total_amount", "passenger_count"]
GAPS = ["store_and_fwd_flag", "congestion_surcharge", "passenger_count", "RatecodeID", "payment_type", "trip_type"]


def _each(names: list[str], select: str, source: str) -> str:
    """One SELECT per column; {c} stands for the column."""
    return "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS row_count, {select.replace('{c}', c)} "
                               f"FROM {source}" for c in names)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "landed_trips").drop("delivery")


@query("profile_shape", """
SELECT position, column_name, data_type, (SELECT count(*) FROM lineitem) AS row_count, 11 AS column_count
FROM (VALUES (0, 'l_orderkey', 'bigint'), (1, 'l_partkey', 'bigint'), (2, 'l_suppkey', 'bigint'),
  (3, 'l_linenumber', 'int'), (4, 'l_quantity', 'double'), (5, 'l_extendedprice', 'double'), (6, 'l_discount', 'double'),
  (7, 'l_tax', 'double'), (8, 'l_returnflag', 'string'), (9, 'l_linestatus', 'string'),
  (10, 'l_shipdate', 'timestamp_ntz')) v(position, column_name, data_type)
""")
def profile_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(load(spark, sf_dir, "lineitem"))


@query("profile_nulls", "WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))\n" + _each(
    ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"],
    f"count(*) FILTER (WHERE {{c}} IS NULL) AS null_count, "
    f"{pct('count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS null_pct", "d"))
def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their optional label."""
    return profile.null_profile(load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left"))


@query("profile_null_patterns", TRIPS + "SELECT " + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in GAPS) + " AS pattern, count(*) AS row_count "
    "FROM trips GROUP BY 1")
def profile_null_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_patterns(_raw(spark, sf_dir), GAPS)


_KEY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]


@query("profile_column_keys", _each(
    _KEY_COLUMNS, f"count(DISTINCT {{c}}) AS unique_values, {pct('count(DISTINCT {c})', 'count(*)')} AS unique_pct",
    "lineitem"))
def profile_column_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_uniqueness(load(spark, sf_dir, "lineitem"), _KEY_COLUMNS)


def _candidate(key: str) -> str:
    return (f"SELECT '{key}' AS candidate_key, sum(n)::BIGINT AS records, count(*) AS unique_keys, "
            f"coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS rows_in_duplicates "
            f"FROM (SELECT count(*) AS n FROM lineitem GROUP BY {key})")


_CANDIDATES = [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey"], ["l_suppkey", "l_shipdate"]]


@query("profile_keys", "\nUNION ALL ".join(_candidate(",".join(k)) for k in _CANDIDATES))
def profile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    result = None
    for key in _CANDIDATES:
        part = profile.key_profile(lines, key)
        result = part if result is None else result.unionByName(part)
    return result


@query("profile_exact_duplicates", TRIPS + """
, raw AS (SELECT * EXCLUDE (delivery) FROM trips)
SELECT sum(n)::BIGINT AS records, count(*) AS unique_keys, (sum(n) - count(*))::BIGINT AS duplicates,
       coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS rows_in_duplicates
FROM (SELECT r, count(*) AS n FROM raw r GROUP BY r)
""")
def profile_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicate_summary(_raw(spark, sf_dir))


@query("profile_event_order", TRIPS + """
SELECT min(lpep_pickup_datetime) AS earliest_start, max(lpep_pickup_datetime) AS latest_start,
       min(lpep_dropoff_datetime) AS earliest_end, max(lpep_dropoff_datetime) AS latest_end,
       count(*) FILTER (WHERE lpep_dropoff_datetime < lpep_pickup_datetime) AS end_before_start FROM trips
""")
def profile_event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.event_order(_raw(spark, sf_dir), "lpep_pickup_datetime", "lpep_dropoff_datetime")


@query("profile_signs", TRIPS + _each(MEASURES, "count(*) FILTER (WHERE {c} < 0) AS negative, "
                                                "count(*) FILTER (WHERE {c} = 0) AS zero", "trips"))
def profile_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sign_profile(_raw(spark, sf_dir), MEASURES)


@query("profile_ranges", WEATHER + _each(["temperature_2m", "precipitation", "snowfall", "wind_speed_10m"],
                                         "min({c}) AS min_value, max({c}) AS max_value", "readings"))
def profile_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_ranges(table(spark, sf_dir, "bronze_weather"),
                                  ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m"])


_CODES = ["VendorID", "RatecodeID", "payment_type", "trip_type", "store_and_fwd_flag"]


@query("profile_codes", TRIPS + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS row_count FROM trips GROUP BY {c}"
    for c in _CODES))
def profile_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.code_values(_raw(spark, sf_dir), _CODES)


@query("profile_observations", WEATHER + "\nUNION ALL ".join(
    f"SELECT '{n}' AS column_name, (date_diff('day', min(ts)::DATE, max(ts)::DATE) + 1) * 24 AS expected, "
    f"count({c}) AS actual, count({c}) = (date_diff('day', min(ts)::DATE, max(ts)::DATE) + 1) * 24 AS complete "
    f"FROM readings" for n, c in (("timestamp", "ts"), ("temperature_2m", "temperature_2m"), ("code", "nullif(weather_code, 3)"))))
def profile_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours a complete series would have against the readings there are."""
    series = table(spark, sf_dir, "bronze_weather").withColumn("code", F.nullif("weather_code", F.lit(3)))
    return profile.observation_count(series, "timestamp", ["temperature_2m", "code"])


@query("profile_hours_covered", """
WITH h AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1)
SELECT date_diff('hour', min(h), max(h)) + 1 AS expected_hours, count(*) AS hours_with_data, sum(n)::BIGINT AS row_count
FROM h
""")
def profile_hours_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.hours_covered(load(spark, sf_dir, "events"), "ts")


@query("profile_gaps", """
WITH ids AS (SELECT DISTINCT l_orderkey AS id FROM lineitem),
expected AS (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) + 20 FROM orders))) AS id)
SELECT id, 'missing' AS finding FROM expected WHERE id NOT IN (SELECT id FROM ids)
UNION ALL SELECT id, 'unexpected' FROM ids WHERE id NOT IN (SELECT id FROM expected)
""")
def profile_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids without a line, expecting 1 up to twenty past the last order."""
    last = load(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return profile.id_gaps(load(spark, sf_dir, "lineitem"), "l_orderkey", 1, last + 20)


@query("profile_dup_names", """
WITH n AS (SELECT p_name, count(DISTINCT p_partkey) AS ids_with_name FROM part GROUP BY p_name HAVING count(DISTINCT p_partkey) > 1)
SELECT p_partkey, p_name, ids_with_name FROM part JOIN n USING (p_name)
""")
def profile_dup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.repeated_names(load(spark, sf_dir, "part"), "p_partkey", "p_name")


@query("profile_distribution", """
SELECT c_mktsegment AS value, count(*) AS row_count FROM customer GROUP BY 1
UNION ALL SELECT 'Total', count(*) FROM customer
""")
def profile_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(load(spark, sf_dir, "customer"), "c_mktsegment")


@query("profile_time_drift", TRIPS + """
, m AS (SELECT nullif(regexp_extract(source_file, '(\\d{4}-\\d{2})', 1), '') AS file_month,
               strftime(lpep_pickup_datetime, '%Y-%m') AS event_month FROM trips)
SELECT file_month, event_month, count(*) AS row_count FROM m WHERE file_month <> event_month GROUP BY ALL
""")
def profile_time_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose pickup lies in another month than their file says."""
    raw = _raw(spark, sf_dir).withColumn("file_month", month_in(F.col("file_name")))
    return profile.out_of_month(raw, "lpep_pickup_datetime", "file_month")


@query("profile_gap_intervals", """
WITH ids AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_orderkey % 100 BETWEEN 20 AND 90
             UNION ALL SELECT -1000000000000 UNION ALL SELECT max(o_orderkey) + 500000000000 FROM orders),
n AS (SELECT id, lag(id) OVER (ORDER BY id) AS before FROM ids)
SELECT before + 1 AS gap_start, id - 1 AS gap_end, id - before - 1 AS missing FROM n WHERE id - before > 1
""")
def profile_gap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of order ids without a line, in a range of 1.5e12 ids."""
    last = load(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    lines = load(spark, sf_dir, "lineitem").filter("l_orderkey % 100 BETWEEN 20 AND 90")
    return gaps.gap_intervals(lines, "l_orderkey", -999_999_999_999, last + 499_999_999_999)


@query("profile_missing_hours", """
WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events WHERE event_id % 7 = 0),
n AS (SELECT h, lag(h) OVER (ORDER BY h) AS before FROM h)
SELECT before + INTERVAL 1 HOUR AS gap_start, h - INTERVAL 1 HOUR AS gap_end, date_diff('hour', before, h) - 1 AS missing
FROM n WHERE date_diff('hour', before, h) > 1
""")
def profile_missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of hours without an event of one kind."""
    return gaps.missing_hours(load(spark, sf_dir, "events").filter("event_id % 7 = 0"), "ts")


_SEARCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]


def _subset(columns: tuple[str, ...]) -> str:
    names = ", ".join(columns)
    return f"SELECT '{','.join(columns)}' AS key_columns, {len(columns)} AS width, (SELECT count(*) FROM (SELECT DISTINCT {names} FROM lineitem)) AS n"


@query("profile_minimal_keys", "WITH u AS (" + "\nUNION ALL ".join(_subset(c) for k in range(1, 7) for c in combinations(_SEARCHED, k)) + """),
k AS (SELECT key_columns, width FROM u WHERE n = (SELECT count(*) FROM lineitem))
SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM k s WHERE s.width < k.width
  AND list_has_all(string_split(k.key_columns, ','), string_split(s.key_columns, ',')))
""")
def profile_minimal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minimal unique column combinations of six columns."""
    return minimal_keys(load(spark, sf_dir, "lineitem"), _SEARCHED)


_COUNTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag"]


@query("profile_distinct_sketch", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(DISTINCT {c}) AS exact, true AS within_bound FROM lineitem" for c in _COUNTED))
def profile_distinct_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts from sketches of months stored in two steps, held against the exact counts."""
    rows = load(spark, sf_dir, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    path = new_path(spark, "sketches")
    for where in ("l_shipdate < TIMESTAMP_NTZ'1997-03-01'", "l_shipdate >= TIMESTAMP_NTZ'1997-02-01'"):
        store_sketches(rows.filter(where), path, _COUNTED, "ship_month")
    estimates = distinct_estimates(spark.read.parquet(path))
    exact = profile.column_uniqueness(rows, _COUNTED).select("column_name", F.col("unique_values").alias("exact"))
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= error_bound() * F.col("exact")
    return estimates.join(exact, "column_name").select("column_name", "row_count", "exact", near.alias("within_bound"))
