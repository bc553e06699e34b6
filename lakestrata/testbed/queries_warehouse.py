"""Silver, dimensions, fact and reports over the stand-in warehouse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.functions.codes import WEATHER_CODES
from lakestrata.operators.bucketed import upsert_bucketed, write_bucketed
from lakestrata.operators.lineage import stamp
from lakestrata.plans import analytics
from lakestrata.plans.gold import (FACT_ORDER, build_calendar, build_coded_dim, build_reference_dim, build_trip_fact, refresh_calendar,
                                   trip_fact_rows)
from lakestrata.plans.presets import TRIP_KEY, TRIP_UPDATE
from lakestrata.plans.silver import refresh
from lakestrata.session import materialize, new_path
from lakestrata.testbed.registry import query
from lakestrata.testbed.sql import CALENDAR, FACT, SILVER, WEATHER, ZONES, settled
from lakestrata.testbed.standins import AT, calendar, load, table

AUDIT = ["bronze_ingestion_timestamp", "bronze_ingestion_date", "silver_ingestion_timestamp", "silver_ingestion_date",
         "gold_ingestion_timestamp", "gold_ingestion_date", "gold_processed_timestamp", "gold_processed_date"]


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT)


@query("filter_clean", SILVER + """
SELECT * RENAME (source_file AS bronze_source_file, source_month AS bronze_source_month)
FROM (SELECT * EXCLUDE (delivery) FROM silver)
""")
def filter_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips: required fields, event order, ranges, date window, month agreement, latest delivery, defaults."""
    return _without_audit(table(spark, sf_dir, "silver_trips"))


@query("silver_refresh", SILVER + """
SELECT * REPLACE (CASE WHEN VendorID = 3 THEN coalesce(passenger_count, 0) + 1 ELSE passenger_count END AS passenger_count)
         RENAME (source_file AS bronze_source_file, source_month AS bronze_source_month)
FROM (SELECT * EXCLUDE (delivery) FROM silver)
""")
def silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of one vendor loaded again with one passenger more, upserted on the null-safe trip key."""
    silver = table(spark, sf_dir, "silver_trips")
    again = silver.filter("VendorID = 3").withColumn("passenger_count", F.col("passenger_count") + 1)
    merged = refresh(silver, again, TRIP_KEY, TRIP_UPDATE)
    return _without_audit(merged)


@query("silver_zones", ZONES + "SELECT * FROM silver_zones")
def silver_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_audit(table(spark, sf_dir, "silver_zones"))


@query("silver_weather", WEATHER + "SELECT *, 'readings.json' AS bronze_source_file FROM silver_weather")
def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_audit(table(spark, sf_dir, "silver_weather"))


@query("dim_calendar", CALENDAR + """
SELECT *, CASE WHEN "month" IN (12, 1, 2) THEN 'Winter' WHEN "month" IN (3, 4, 5) THEN 'Spring'
               WHEN "month" IN (6, 7, 8) THEN 'Summer' WHEN "month" IN (9, 10, 11) THEN 'Autumn'
               ELSE 'Unknown' END AS season
FROM calendar
""")
def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_audit(calendar(spark, sf_dir, with_season=True))


@query("refresh_calendar", CALENDAR + """
SELECT * FROM calendar
""")
def refresh_calendar_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stale calendar (every key off by ten, hours after 1997 missing, one hour that is no longer wanted)."""
    fresh = table(spark, sf_dir, "calendar")
    stale = fresh.filter("year < 1998").withColumn("datetime_key", F.col("datetime_key") + 10)
    extra = stale.filter("year = 1900").withColumn("full_datetime", F.lit("1901-01-01 00:00:00").cast("timestamp_ntz"))
    merged = refresh_calendar(stale.unionByName(extra), fresh, delete_unmatched=True)
    return _without_audit(merged)


@query("calendar_growth", CALENDAR + """
SELECT full_datetime, datetime_key, CASE WHEN "year" = 1900 OR full_datetime >= (SELECT first + INTERVAL 400 DAY FROM span) THEN true END AS same_key
FROM calendar
""")
def calendar_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar extended to the left: the hours that were there keep their keys."""
    first, last = load(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    late = materialize(build_calendar(spark, first + dt.timedelta(days=400), last, at=AT), "calendar")
    grown = refresh_calendar(late, build_calendar(spark, first, last, at=AT))
    before = late.select("full_datetime", F.col("datetime_key").alias("old_key"))
    return (grown.select("full_datetime", "datetime_key").join(before, "full_datetime", "left")
            .select("full_datetime", "datetime_key", (F.col("datetime_key") == F.col("old_key")).alias("same_key")))


@query("dim_location", ZONES + "SELECT * FROM location")
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_audit(table(spark, sf_dir, "location"))


@query("dim_location_refresh", ZONES + """
, old AS (SELECT location_key + 100 AS location_key, location_id FROM location WHERE borough <> 'Asia')
SELECT coalesce(old.location_key, (SELECT max(location_key) FROM old)
                + row_number() OVER (PARTITION BY old.location_key IS NULL ORDER BY s.location_id)) AS location_key,
       s.location_id, s.borough, s.zone, s.service_zone
FROM silver_zones s LEFT JOIN old USING (location_id)
""")
def dim_location_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known zones keep their keys and get fresh attributes; zones of one borough are new."""
    old = table(spark, sf_dir, "location").filter("borough <> 'Asia'").withColumns(
        {"location_key": F.col("location_key") + 100, "zone": F.lit("old name")})
    dim = build_reference_dim(table(spark, sf_dir, "silver_zones"), "location_id", "location_key",
                              ["borough", "zone", "service_zone"], existing=materialize(old, "old"))
    return _without_audit(dim)


@query("dim_condition", WEATHER + "SELECT * FROM weather")
def dim_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_audit(table(spark, sf_dir, "weather"))


@query("dim_condition_refresh", WEATHER + """
, old AS (SELECT weather_key, weather_datetime FROM weather WHERE weather_condition <> 'Overcast')
SELECT coalesce(old.weather_key, (SELECT max(weather_key) FROM old)
                + row_number() OVER (PARTITION BY old.weather_key IS NULL ORDER BY w.weather_datetime)) AS weather_key,
       w.weather_datetime, w.weather_condition, w.temperature_2m
FROM weather w LEFT JOIN old USING (weather_datetime)
""")
def dim_condition_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "weather").filter("weather_condition <> 'Overcast'").withColumn(
        "temperature_2m", F.lit(-99.0))
    dim = build_coded_dim(table(spark, sf_dir, "silver_weather"), "timestamp", "weather_code", WEATHER_CODES,
                          existing=materialize(old, "old"))
    return dim.select("weather_key", "weather_datetime", "weather_condition", "temperature_2m")


@query("fact_trips", FACT + "SELECT * FROM fact")
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_audit(table(spark, sf_dir, "fact"))


_FACT_REFRESHED = FACT + """
, old AS (SELECT trip_key FROM fact WHERE passenger_count <> 2)
SELECT coalesce(old.trip_key, (SELECT max(trip_key) FROM old)
         + row_number() OVER (PARTITION BY old.trip_key IS NULL ORDER BY lpep_pickup_datetime, lpep_dropoff_datetime,
                              vendor_id, PULocationID, DOLocationID, trip_distance, total_amount)) AS trip_key,
       fact.* EXCLUDE (trip_key)
FROM fact LEFT JOIN old ON fact.trip_key = old.trip_key
"""


@query("fact_refresh", _FACT_REFRESHED)
def fact_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips already in the fact keep their key and get fresh values; the others are numbered after them."""
    old = table(spark, sf_dir, "fact").filter("passenger_count <> 2").withColumn("fare_amount", F.lit(-1.0))
    fact = build_trip_fact(*[table(spark, sf_dir, n) for n in ("silver_trips", "calendar", "location", "weather")],
                           existing=materialize(old, "old"))
    return _without_audit(fact)


@query("fact_refresh_bucketed", _FACT_REFRESHED)
def fact_refresh_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same refresh of a fact stored in buckets of the trip's own values: only the load and the inserted rows are dealt out."""
    old = table(spark, sf_dir, "fact").filter("passenger_count <> 2").withColumn("fare_amount", F.lit(-1.0))
    path = new_path(spark, "fact-bucketed")
    write_bucketed(old, path, FACT_ORDER, 8)
    rows = trip_fact_rows(*[table(spark, sf_dir, n) for n in ("silver_trips", "calendar", "location", "weather")], at=AT)
    return _without_audit(upsert_bucketed(spark, path, rows, FACT_ORDER, check_source=False, key="trip_key", order_by=FACT_ORDER))


@query("audit_stamps", """
SELECT l_returnflag, count(*) AS row_count, 0::BIGINT AS unstamped, 1::BIGINT AS moments,
       DATE '2026-06-01' AS load_date
FROM lineitem GROUP BY l_returnflag
""")
def audit_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load moment for all rows of a load, and its date."""
    rows = stamp(load(spark, sf_dir, "lineitem"), "bronze", AT)
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("bronze_ingestion_date").isNull()).alias("unstamped"),
        F.count_distinct("bronze_ingestion_timestamp").alias("moments"),
        F.max("bronze_ingestion_date").alias("load_date"))


# Reports --------------------------------------------------------------------------------------------------

@query("demand_by_time", FACT + """
SELECT day_name, "hour", count(trip_key) AS trip_count
FROM fact JOIN calendar ON pickup_datetime_key = datetime_key GROUP BY day_name, "hour", day_of_week
""")
def demand_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.demand_by_time(table(spark, sf_dir, "fact"), table(spark, sf_dir, "calendar"))


@query("demand_by_zone", FACT + """
SELECT zone, borough, count(*) AS trip_count FROM fact JOIN location ON pickup_location_key = location_key
GROUP BY zone, borough
""")
def demand_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.demand_by_zone(table(spark, sf_dir, "fact"), table(spark, sf_dir, "location"))


@query("top_zones", FACT + f"""
SELECT location_id, borough, zone, count(trip_key) AS pickup_trips, {settled('avg(trip_distance)')} AS avg_trip_distance,
       {settled('avg(trip_duration_minutes)')} AS avg_trip_duration_minutes,
       {settled('sum(total_amount)')} AS total_revenue
FROM fact JOIN location ON PULocationID = location_id GROUP BY location_id, borough, zone
ORDER BY pickup_trips DESC, location_id LIMIT 5
""")
def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_zones(table(spark, sf_dir, "fact"), table(spark, sf_dir, "location"))


@query("opportunity_zones", FACT + """
, ends AS (SELECT unnest([PULocationID, DOLocationID]) AS place, unnest([1, -1]) AS direction FROM fact)
SELECT location_id, any_value(borough) AS borough, any_value(zone) AS zone, count_if(direction = 1) AS pickup_trips,
       count_if(direction = -1) AS dropoff_trips, count(direction) AS total_mobility_activity,
       coalesce(sum(direction), 0)::BIGINT AS mobility_imbalance
FROM location LEFT JOIN ends ON place = location_id
GROUP BY location_id ORDER BY count(direction), location_id LIMIT 5
""")
def opportunity_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.opportunity_zones(table(spark, sf_dir, "fact"), table(spark, sf_dir, "location"))


KEPT = """
, kept AS (SELECT f.*, w.* EXCLUDE (weather_key), w.weather_key AS member
           FROM fact f LEFT JOIN weather w ON f.weather_key = w.weather_key
           WHERE trip_distance BETWEEN 0 AND 100 AND trip_duration_minutes BETWEEN 0 AND 180
             AND fare_amount BETWEEN 0 AND 250 AND passenger_count BETWEEN 1 AND 8)
"""
SHARE = settled("100.0::DOUBLE * count(*) / sum(count(*)) OVER ()")
FLAG = "CASE WHEN count(*) < 200 THEN 'LOW SAMPLE - interpret with caution' ELSE 'OK' END AS sample_size_flag"
PER_MILE = settled("avg(CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END)") + " AS avg_fare_per_mile"
BASIC = f"""count(*) AS trip_count, {SHARE} AS pct_of_total_trips, {FLAG},
  {settled('avg(trip_duration_minutes)')} AS avg_trip_duration_min, {settled('avg(trip_distance)')} AS avg_trip_distance_mi,
  {settled('avg(fare_amount)')} AS avg_fare_amount, {settled('avg(total_amount)')} AS avg_total_amount, {PER_MILE}"""


@query("behavior_by_condition", FACT + KEPT + f"""
SELECT coalesce(weather_condition, 'No Weather Data') AS weather_condition, {BASIC},
       {settled('avg(tip_amount)')} AS avg_tip_amount, {settled('avg(passenger_count)')} AS avg_passenger_count,
       {settled('avg(temperature_2m)', 1)} AS avg_temperature_c, {settled('avg(wind_speed_10m)', 1)} AS avg_wind_speed
FROM kept GROUP BY 1
""")
def behavior_by_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.behaviour_by_condition(table(spark, sf_dir, "fact"), table(spark, sf_dir, "weather"))


@query("behavior_by_intensity", FACT + KEPT + f"""
SELECT CASE WHEN member IS NULL THEN 'No Weather Data' WHEN coalesce(precipitation, 0) = 0 THEN 'No Precipitation'
            WHEN precipitation <= 2.5 THEN 'Light (0-2.5mm)' WHEN precipitation <= 7.5 THEN 'Moderate (2.5-7.5mm)'
            ELSE 'Heavy (7.5mm+)' END AS precipitation_bucket, {BASIC}
FROM kept GROUP BY 1
""")
def behavior_by_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.behaviour_by_intensity(table(spark, sf_dir, "fact"), table(spark, sf_dir, "weather"))


@query("condition_flag", FACT + KEPT + f"""
SELECT CASE WHEN coalesce(snowfall, 0) > 0 THEN 'Snow' ELSE 'No Snow' END AS snow_flag, {BASIC}
FROM kept WHERE member IS NOT NULL GROUP BY 1
""")
def condition_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.snow_comparison(table(spark, sf_dir, "fact"), table(spark, sf_dir, "weather"))


@query("rate_per_hour", FACT + KEPT + f"""
, events AS (
  SELECT coalesce(weather_condition, 'No Weather Data') AS label, 1 AS trip, NULL AS covered FROM kept
  UNION ALL
  SELECT weather_condition, NULL, weather_datetime FROM weather
  WHERE EXISTS (SELECT 1 FROM fact WHERE lpep_pickup_datetime < weather_datetime + INTERVAL 1 HOUR)
    AND EXISTS (SELECT 1 FROM fact WHERE lpep_pickup_datetime >= weather_datetime))
SELECT label AS weather_condition, count(trip) AS trip_count,
       nullif(count(DISTINCT covered), 0) AS weather_hours,
       {settled('count(trip) * 1.0::DOUBLE / nullif(count(DISTINCT covered), 0)')} AS trips_per_weather_hour
FROM events GROUP BY label HAVING count(trip) > 0
""")
def rate_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.trips_per_weather_hour(table(spark, sf_dir, "fact"), table(spark, sf_dir, "weather"))


@query("monthly_condition", FACT + KEPT + f"""
SELECT strftime(lpep_pickup_datetime, '%Y-%m') AS trip_month,
       coalesce(weather_condition, 'No Weather Data') AS weather_condition, count(*) AS trip_count, {FLAG},
       {settled('avg(trip_duration_minutes)')} AS avg_trip_duration_min,
       {settled('avg(trip_distance)')} AS avg_trip_distance_mi, {settled('avg(fare_amount)')} AS avg_fare_amount,
       {PER_MILE}
FROM kept GROUP BY 1, 2
""")
def monthly_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.monthly_conditions(table(spark, sf_dir, "fact"), table(spark, sf_dir, "weather"))
